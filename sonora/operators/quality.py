"""Declared column checks on the staged events, as failure reports."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sonora.fixed_values import MOOD_LABELS, TIME_OF_DAY_LABELS


def duplicate_ids(df: DataFrame, id_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """``unique`` test: every id (within a key) seen more than once, with its
    count.  Empty means the test passes.  Counted with a combining aggregate,
    so a single hot id is reduced map-side."""
    return (df.groupBy(*keys, id_col).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def null_report(stg: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """``not_null`` tests plus the expected-value checks, as one row of
    failure counts (all zero = pass), computed in a single pass."""
    row = stg.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(F.col("play_id").isNull()).alias("null_play_id"),
        F.count_if(F.col("track_name").isNull()).alias("null_track_name"),
        F.count_if(F.col("played_at").isNull()).alias("null_played_at"),
        F.count_if(~F.coalesce(F.col("time_of_day").isin(*TIME_OF_DAY_LABELS), F.lit(False)))
        .alias("bad_time_of_day"),
    )
    if features is None:
        return row
    bad = features.agg(F.count_if(~F.coalesce(F.col("mood_label").isin(*MOOD_LABELS), F.lit(False)))
                       .alias("bad_mood_label"))
    return row.withColumn("bad_mood_label", bad.scalar())
