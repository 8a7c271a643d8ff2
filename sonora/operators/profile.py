"""Listener fingerprint: a 20-dimension behavioural vector and its profile row.

Inputs per key: the daily mood rows (feature-joined days), the time-of-day
shares and the top-artist concentration (both over *all* staged plays).
Windows run only over the per-day rows of one key, never over raw plays.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sonora.fixed_values import (
    CONCENTRATION_WHEN_NO_ARTIST,
    DAYS_ACTIVE_SCALE,
    FINGERPRINT_DIM,
    PLAYS_PER_DAY_SCALE,
    PROFILE_MOODS,
    TIME_OF_DAY_LABELS,
    WEEKEND_PLACEHOLDER,
)
from sonora.functions.mood import largest
from sonora.operators.artists import top10_concentration
from sonora.operators.timeofday import time_of_day_pivot


def _or_half(c: Column) -> Column:
    """``x or 0.5``: null and 0.0 both count as missing."""
    return F.when(c.isNull() | (c == 0), F.lit(0.5)).otherwise(c)


SNAP_DECIMALS = 10


def snap(name: str) -> Column:
    """An aggregated double rounded to 10 decimals.

    Floating sums depend on the order rows arrive in, which depends on the
    partitioning; the last bits of a mean can therefore differ between runs
    and land on either side of a rounding tie.  Snapping well below the
    published precision makes the 4-decimal results layout-independent.
    """
    return F.round(F.col(name), SNAP_DECIMALS).alias(name)


def day_signals(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per (key, day): cleaned signals plus the day's position in date order."""
    w = Window.partitionBy(*keys).orderBy("played_date")
    return daily.select(
        *keys, "played_date", "dominant_mood",
        F.coalesce("total_plays", F.lit(0)).alias("plays"),
        _or_half(F.col("avg_energy")).alias("e"),
        _or_half(F.col("avg_valence")).alias("v"),
        *[F.coalesce(f"pct_{m}", F.lit(0.0)).alias(f"p_{m}") for m in PROFILE_MOODS],
        F.row_number().over(w).alias("pos"),
        F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("n_days"),
    )


def profile_stats(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Means, population std-devs, half-split trends and activity per key."""
    s = day_signals(daily, keys)
    half = F.floor(F.col("n_days") / 2)
    early, late = F.col("pos") <= half, F.col("pos") > half
    aggs = [F.avg(f"p_{m}").alias(f"mean_{m}") for m in PROFILE_MOODS]
    aggs += [
        F.avg("e").alias("mean_e"), F.avg("v").alias("mean_v"),
        F.stddev_pop("e").alias("std_e"), F.stddev_pop("v").alias("std_v"),
        F.avg("plays").alias("mean_plays"),
        F.count(F.lit(1)).alias("days_active"),
        F.sum("plays").alias("total_plays"),
        F.avg(F.when(early, F.col("e"))).alias("early_e"),
        F.avg(F.when(late, F.col("e"))).alias("late_e"),
        F.avg(F.when(early, F.col("v"))).alias("early_v"),
        F.avg(F.when(late, F.col("v"))).alias("late_v"),
    ]
    aggs += [F.count_if(F.col("dominant_mood") == m).alias(f"days_{m}") for m in PROFILE_MOODS]
    g = s.groupBy(*keys).agg(*aggs)
    has_split = F.floor(F.col("days_active") / 2) > 0
    return g.select(
        *keys, *[snap(f"mean_{m}") for m in PROFILE_MOODS],
        *[snap(c) for c in ("mean_e", "mean_v", "std_e", "std_v", "mean_plays")],
        "days_active", "total_plays",
        F.when(has_split, snap("late_v") - snap("early_v")).otherwise(F.lit(0.0)).alias("trend_v"),
        F.when(has_split, snap("late_e") - snap("early_e")).otherwise(F.lit(0.0)).alias("trend_e"),
        largest({m: F.col(f"days_{m}") for m in PROFILE_MOODS}).alias("top_mood"),
    )


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add a per-key table's columns.  With keys: a left join on them (both
    sides come out of aggregations on the same keys, so they are already
    co-partitioned).  Without keys the right side is one row and is
    attached as a scalar subquery, not joined."""
    if keys:
        return left.join(right, list(keys), "left")
    row = right.select(F.struct(*right.columns).alias("_r")).scalar()
    return left.withColumn("_r", row).select(*left.columns, *[F.col("_r")[c].alias(c) for c in right.columns])


def fingerprint_vector(stats: DataFrame, shares: DataFrame, concentration: DataFrame,
                       keys: Sequence[str] = ()) -> DataFrame:
    """The 20 dimensions (each rounded to 4) next to the profile columns.

    0-3 mean mood shares / 100; 4-5 mean energy, valence; 6-7 their
    population std-dev capped at 1; 8-11 time-of-day shares / 100;
    12 concentration / 100; 13 plays per day / 50 capped; 14 days / 30
    capped; 15 constant 0.5; 16-17 (trend + 1) / 2 for valence, energy;
    18 energy x valence; 19 1 - melancholic share / 100.  Without any day
    every dimension is 0.5.
    """
    j = attach(attach(stats, shares, keys), concentration, keys)
    share = {b: F.coalesce(F.col(b), F.lit(0.0)) for b in TIME_OF_DAY_LABELS}
    conc = F.coalesce(F.col("concentration"), F.lit(CONCENTRATION_WHEN_NO_ARTIST))
    dims = [
        *[F.col(f"mean_{m}") / 100.0 for m in PROFILE_MOODS],
        F.col("mean_e"), F.col("mean_v"),
        F.least(F.col("std_e"), F.lit(1.0)), F.least(F.col("std_v"), F.lit(1.0)),
        *[share[b] / 100.0 for b in TIME_OF_DAY_LABELS],
        conc / 100.0,
        F.least(F.col("mean_plays") / PLAYS_PER_DAY_SCALE, F.lit(1.0)),
        F.least(F.col("days_active") / DAYS_ACTIVE_SCALE, F.lit(1.0)),
        F.lit(WEEKEND_PLACEHOLDER),
        (F.col("trend_v") + 1) / 2, (F.col("trend_e") + 1) / 2,
        F.col("mean_e") * F.col("mean_v"),
        1 - F.col("mean_melancholic") / 100.0,
    ]
    assert len(dims) == FINGERPRINT_DIM
    vector = F.array(*[F.round(d.cast("double"), 4) for d in dims])
    no_days = F.array_repeat(F.lit(0.5), FINGERPRINT_DIM)
    return j.withColumn("embedding", F.when(F.col("days_active") > 0, vector).otherwise(no_days))


def user_fingerprint(daily: DataFrame, stg: DataFrame, keys: Sequence[str] = (),
                     username: Column | None = None, stamp: Column | None = None) -> DataFrame:
    """Profile rows: username, embedding, embedding_dim, top_mood, avg_energy,
    avg_valence (32-bit), total_plays, days_active, created_at,
    updated_at.  A key without any feature-joined day gets no row, nor does
    the single listener without one."""
    stats = profile_stats(daily, keys)
    vec = fingerprint_vector(stats, time_of_day_pivot(stg, keys), top10_concentration(stg, keys), keys)
    if username is None:
        username = (F.concat(F.lit("user_"), F.col(keys[0]).cast("string")) if keys
                    else F.lit("listener"))
    ts = stamp if stamp is not None else F.current_timestamp().cast("timestamp_ntz")
    return vec.filter(F.col("days_active") > 0).select(
        *keys,
        username.alias("username"),
        "embedding",
        F.lit(FINGERPRINT_DIM).alias("embedding_dim"),
        "top_mood",
        F.round("mean_e", 4).cast("float").alias("avg_energy"),
        F.round("mean_v", 4).cast("float").alias("avg_valence"),
        "total_plays",
        "days_active",
        ts.alias("created_at"),
        ts.alias("updated_at"),
    )


def embedding_json(profiles: DataFrame) -> DataFrame:
    """Vector <-> JSON text round trip (the stored text form)."""
    text = F.to_json(F.col("embedding"))
    return profiles.select("username", text.alias("embedding_json"),
                           F.from_json(text, "array<double>").alias("embedding"))
