"""Plays by time of day: counts, shares, and the four-bucket pivot."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sonora.fixed_values import TIME_OF_DAY_LABELS


def time_of_day_counts(stg: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return (stg.groupBy(*keys, "time_of_day").agg(F.count(F.lit(1)).alias("plays"))
            .orderBy(*keys, F.col("plays").desc(), "time_of_day"))


def time_of_day_share(stg: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per bucket: plays x 100 / all plays of the key, rounded to 2.

    ``SUM(COUNT(*)) OVER ()``: the window runs over at most four
    aggregated rows per key.
    """
    counts = stg.groupBy(*keys, "time_of_day").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys))
    return counts.select(*keys, "time_of_day",
                         F.round(F.col("n") * 100.0 / total, 2).alias("pct"))


def time_of_day_pivot(stg: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per key with the four shares; a bucket never played is 0.0."""
    share = time_of_day_share(stg, keys)
    return share.groupBy(*keys).agg(*[
        F.coalesce(F.max(F.when(F.col("time_of_day") == b, F.col("pct"))), F.lit(0.0)).alias(b)
        for b in TIME_OF_DAY_LABELS])
