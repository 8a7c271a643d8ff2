"""Events joined with track features, rolled up to one row per day."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sonora.fixed_values import MOOD_LABELS, PROFILE_MOODS, TIME_OF_DAY_LABELS
from sonora.functions.mood import largest
from sonora.operators.skew import split_join

AVERAGED = [("energy", 3), ("valence", 3), ("tempo", 1), ("danceability", 3)]


def events_with_features(stg: DataFrame, features: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Plays left-joined to features on the track name only, rows without a
    mood label dropped, which makes it an inner join.

    Features are stored per (track, artist), so a name with several artists
    repeats the play once per feature row -- this fan-out is intended.  A
    name with many plays (the empty title, say) is divided over tasks.
    """
    e = stg.select(*keys, "play_id", "track_name", "artist_clean", "played_date",
                   "played_hour", "time_of_day", "played_day_of_week")
    f = features.select("track_name", "energy", "valence", "tempo", "danceability", "mood_label")
    return split_join(e, f.filter(F.col("mood_label").isNotNull()), "track_name", [*keys, "play_id"])


def track_feature_summary(features: DataFrame) -> DataFrame:
    """Per track name: how many labelled feature rows it has (the join's
    fan-out), the sums and non-null counts of each averaged feature, and
    the count of each mood label -- everything the roll-up needs, so the
    fan-out never has to be materialised."""
    aggs = [F.count(F.lit(1)).alias("n_feat")]
    for c, _ in AVERAGED:
        aggs += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"cnt_{c}")]
    aggs += [F.count_if(F.col("mood_label") == m).alias(f"n_{m}") for m in MOOD_LABELS]
    return features.filter(F.col("mood_label").isNotNull()).groupBy("track_name").agg(*aggs)


def dominant_mood(prefix: str = "", suffix: str = "_count") -> Column:
    """The mood with the most plays; ties: energetic > melancholic > peaceful > intense > neutral."""
    return largest({m: F.col(f"{prefix}{m}{suffix}") for m in MOOD_LABELS})


SUMS = (["total_plays"] + [f"{kind}_{c}" for c, _ in AVERAGED for kind in ("s", "c")]
        + [f"{m}_count" for m in MOOD_LABELS] + [f"tod_{b}" for b in TIME_OF_DAY_LABELS])


def daily_sums(stg: DataFrame, features: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per (keys, day): the sums and counts (``SUMS``) of the feature-joined plays.  They add up: those of two
    disjoint sets of plays give those of their union.

    Plan: plays are first counted per (keys, day, track, time of day) --
    map-side combined, so a hot track or listener is reduced before any
    shuffle -- and joined to a per-track summary of the features.  Each
    joined row stands for n plays x n_feat feature rows, so sums and counts
    weighted by those multiplicities equal the fanned-out join's aggregates
    exactly (float sums are exact in double far beyond any day's plays).
    """
    plays = (stg.filter(F.col("track_name").isNotNull())
             .groupBy(*keys, "played_date", "track_name", "time_of_day")
             .agg(F.count(F.lit(1)).alias("n")))
    j = plays.join(track_feature_summary(features), "track_name")
    n, w = F.col("n"), F.col("n") * F.col("n_feat")
    aggs = [F.sum(w).alias("total_plays")]
    for c, _ in AVERAGED:
        aggs += [F.sum(n * F.col(f"sum_{c}")).alias(f"s_{c}"),
                 F.sum(n * F.col(f"cnt_{c}")).alias(f"c_{c}")]
    aggs += [F.sum(n * F.col(f"n_{m}")).alias(f"{m}_count") for m in MOOD_LABELS]
    aggs += [F.sum(F.when(F.col("time_of_day") == b, w).otherwise(0)).alias(f"tod_{b}")
             for b in TIME_OF_DAY_LABELS]
    return j.groupBy(*keys, "played_date").agg(*aggs)


def stg_daily_mood(stg: DataFrame, features: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, day) over feature-joined plays: see ``daily_mood``."""
    return daily_mood(daily_sums(stg, features, keys), keys)


def daily_mood(sums: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """From the sums of each (keys, day): total_plays, rounded averages of
    energy / valence / tempo / danceability, one count per mood label, the
    most frequent time of day, the dominant mood and the share of four moods.
    """
    total = F.col("total_plays")
    return sums.select(
        *keys,
        "played_date",
        "total_plays",
        *[F.round(F.try_divide(F.col(f"s_{c}"), F.col(f"c_{c}")), s).alias(f"avg_{c}")
          for c, s in AVERAGED],
        *[F.col(f"{m}_count") for m in MOOD_LABELS],
        largest({b: F.col(f"tod_{b}") for b in sorted(TIME_OF_DAY_LABELS)}).alias("dominant_time_of_day"),
        dominant_mood().alias("dominant_mood"),
        *[F.round(F.lit(100.0) * F.col(f"{m}_count") / total, 1).alias(f"pct_{m}")
          for m in PROFILE_MOODS],
    )
