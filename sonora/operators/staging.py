"""Staging layer: the cleaned, calendar-annotated play events."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sonora.functions import playtime as pt
from sonora.functions.text import clean_artist


def stg_listening_events(raw: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per stored play.

    play_id, track_name, artist_clean, artist_raw, album, played_at_str,
    played_at, played_date, played_hour, played_day_of_week (Sunday = 0),
    time_of_day, loaded_at.  The play instant is derived once and reused.
    """
    return (raw
            .withColumn("_at", pt.played_at("unix_timestamp"))
            .select(
                *keys,
                F.col("unix_timestamp").alias("play_id"),
                F.trim("track_name").alias("track_name"),
                clean_artist("artist").alias("artist_clean"),
                F.trim("artist").alias("artist_raw"),
                F.trim("album").alias("album"),
                F.col("timestamp").alias("played_at_str"),
                F.col("_at").alias("played_at"),
                pt.day_start(F.col("_at")).alias("played_date"),
                pt.hour_of_day(F.col("_at")).alias("played_hour"),
                pt.day_of_week(F.col("_at")).alias("played_day_of_week"),
                pt.time_of_day(pt.hour_of_day(F.col("_at"))).alias("time_of_day"),
                F.col("loaded_at"),
            ))


def calendar_profile(stg: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Plays per (hour, weekday, bucket) -- checks the calendar derivation."""
    return (stg.groupBy(*keys, "played_hour", "played_day_of_week", "time_of_day")
            .agg(F.count(F.lit(1)).alias("plays")))


def artist_cleaning(stg: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Plays per (raw artist, cleaned artist) -- the masking decisions."""
    return (stg.groupBy(*keys, "artist_raw", "artist_clean")
            .agg(F.count(F.lit(1)).alias("plays")))
