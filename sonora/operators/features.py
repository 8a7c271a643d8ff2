"""Per-track audio features: candidate pairs, estimation, mood labels."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sonora.fixed_values import FEATURE_SOURCE
from sonora.functions.mood import classify_mood, estimate_features
from sonora.functions.text import is_known_artist

FEATURE_COLUMNS = ["track_name", "artist", "energy", "valence", "tempo",
                   "danceability", "acousticness", "mood_label", "source", "fetched_at"]


def new_tracks(stg: DataFrame, existing: DataFrame | None = None, by: str = "track_name",
               limit: int | None = None) -> DataFrame:
    """Distinct (track, known artist) pairs that still need features.

    ``by='track_name'`` reproduces ``track_name NOT IN (SELECT track_name
    FROM track_features)``: a name already featured is skipped even for a
    new artist, a null name never qualifies, and a null name in the table
    empties the result.  It is planned as a hash anti-join plus a one-value
    existence check, never as a nested-loop join.  ``by='pair'`` skips only
    pairs already present.  ``limit`` caps a batch (ordered, so repeatable);
    the default processes every pair.
    """
    pairs = (stg.filter(is_known_artist("artist_clean"))
             .select("track_name", F.col("artist_clean").alias("artist"))
             .dropDuplicates(["track_name", "artist"]))
    if existing is not None:
        if by == "track_name":
            names = existing.select("track_name")
            pairs = (pairs.filter(F.col("track_name").isNotNull())
                     .join(names.filter(F.col("track_name").isNotNull()), "track_name", "left_anti")
                     .filter(~names.filter(F.col("track_name").isNull()).exists()))
        elif by == "pair":
            pairs = pairs.join(existing.select("track_name", "artist"),
                               ["track_name", "artist"], "left_anti")
        else:
            raise ValueError(f"unknown by={by!r}")
    if limit is not None:
        pairs = pairs.orderBy("track_name", "artist").limit(limit)
    return pairs


def build_track_features(pairs: DataFrame, fetched_at: Column | None = None) -> DataFrame:
    """Estimated features for each pair, labelled, stored as 32-bit floats.

    The label is decided on the double values, before narrowing.
    """
    est = estimate_features("track_name", "artist")
    stamp = fetched_at if fetched_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return (pairs
            .withColumn("_f", est)
            .select(
                "track_name", "artist",
                *[F.col("_f")[c].cast("float").alias(c)
                  for c in ("energy", "valence", "tempo", "danceability", "acousticness")],
                classify_mood(F.col("_f.energy"), F.col("_f.valence")).alias("mood_label"),
                F.lit(FEATURE_SOURCE).alias("source"),
                stamp.alias("fetched_at"),
            ))


def mood_distribution(features: DataFrame) -> DataFrame:
    """Tracks per mood label, most common first."""
    return (features.groupBy("mood_label").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("mood_label")))
