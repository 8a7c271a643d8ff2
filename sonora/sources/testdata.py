"""Adapter from the generic test tables to the raw play-event shape.

``events`` supplies time, listener and a small integer ``k`` (in its JSON
``props``); ``part`` supplies text.  Suffixes and artist names are chosen so
that every estimator rule fires and both masked and kept artists occur.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sonora.session import prepare

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# Fixture vocabulary: track-name suffix by k % 12, artist by k % 10 (else brand).
TRACK_SUFFIXES = ["Dance", "Farewell", "Lullaby", "Wedding", "Plain", "Heartbeat",
                  "Goodbye", "Calm Rain", "Love Failure", "Theme", "Smile", "Tune"]
ARTIST_NAMES = ["Top 10 Hit Songs", "Jukebox Mix", " The Weeknd ", "Anirudh R",
                "Aditya Music"]
LOADED_AT = _dt.datetime(2024, 2, 1, 0, 0, 0)
SCROBBLE_TIME_FORMAT = "d MMM yyyy, HH:mm"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, values: list[str], default: Column | None = None) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v))
    return expr.otherwise(default) if default is not None else expr


def loaded_at_literal() -> Column:
    return F.lit(LOADED_AT).cast("timestamp_ntz")


def adapted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw play events (one per ``events`` row) with ``event_id``/``user_id``.

    Columns: event_id, user_id, track_name, artist, album, timestamp,
    unix_timestamp, loaded_at.  ``event_id`` stands for landing order
    (file name, then position in the file).
    """
    prepare(spark)
    ev = read_table(spark, sf_dir, "events")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    e = ev.select("event_id", "user_id", "ts", k.alias("k"))
    # ``part`` is a dimension table: the planner broadcasts it while its
    # measured size is under the broadcast threshold, else shuffles (AQE).
    j = e.join(part, e["k"] == part["p_partkey"])
    track = F.concat(F.col("p_type"), F.lit(" "), _pick(F.col("k") % 12, TRACK_SUFFIXES))
    artist = _pick(F.col("k") % 10, ARTIST_NAMES, F.col("p_brand"))
    return j.select(
        "event_id", "user_id",
        track.alias("track_name"),
        artist.alias("artist"),
        F.col("p_type").alias("album"),
        F.date_format("ts", SCROBBLE_TIME_FORMAT).alias("timestamp"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("unix_timestamp"),
        loaded_at_literal().alias("loaded_at"),
    )
