"""Artist rankings: top-k, trailing-window top-k, concentration, bar shares."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sonora.fixed_values import (
    CONCENTRATION_WHEN_NO_ARTIST,
    RELATIVE_SHARE_ROWS,
    TOP_ARTISTS,
    TOP_ARTISTS_FOR_CONCENTRATION,
    TRAILING_WINDOW_DAYS,
    WEEKLY_TOP_ARTISTS,
)
from sonora.functions.text import is_known_artist

# Rank order: most plays first; equal counts by artist name (deterministic).
def rank_order():
    return [F.col("plays").desc(), F.col("artist_clean").asc()]


def artist_plays(stg: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Plays per known artist (map-side combined count)."""
    return (stg.filter(is_known_artist("artist_clean"))
            .groupBy(*keys, "artist_clean").agg(F.count(F.lit(1)).alias("plays")))


def top_k(ranked: DataFrame, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows in rank_order(), per key.

    Without keys this is ``orderBy().limit()`` -- a TakeOrderedAndProject
    that keeps n rows per partition before merging.  With keys a rank over
    the already aggregated rows of each key.
    """
    if not keys:
        return ranked.orderBy(*rank_order()).limit(n)
    w = Window.partitionBy(*keys).orderBy(*rank_order())
    return ranked.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def top_artists(stg: DataFrame, keys: Sequence[str] = (), n: int = TOP_ARTISTS) -> DataFrame:
    return top_k(artist_plays(stg, keys), n, keys)


def top_artists_trailing(stg: DataFrame, keys: Sequence[str] = (), n: int = WEEKLY_TOP_ARTISTS,
                         days: int = TRAILING_WINDOW_DAYS) -> DataFrame:
    """Top artists over days >= (latest day of *all* plays) - ``days`` days.

    The window therefore spans days + 1 calendar dates.  Plays are first
    counted per (keys, day, artist); the latest day is a combining aggregate
    (a scalar subquery without keys, joined back by key otherwise), so a
    listener with many artists is never gathered in one task.
    """
    per_day = (stg.groupBy(*keys, "played_date", "artist_clean")
               .agg(F.count(F.lit(1)).alias("plays")))
    back = F.expr(f"INTERVAL {days} DAYS")
    if keys:
        latest = stg.groupBy(*keys).agg((F.max("played_date") - back).alias("_since"))
        window = per_day.join(latest, list(keys))
    else:
        window = per_day.withColumn("_since", stg.agg(F.max("played_date")).scalar() - back)
    window = window.filter(F.col("played_date") >= F.col("_since")).drop("_since")
    ranked = (window.filter(is_known_artist("artist_clean"))
              .groupBy(*keys, "artist_clean").agg(F.sum("plays").alias("plays")))
    return top_k(ranked, n, keys)


def top10_concentration(stg: DataFrame, keys: Sequence[str] = (),
                        k: int = TOP_ARTISTS_FOR_CONCENTRATION) -> DataFrame:
    """Share (%) of known-artist plays that go to the top ``k`` artists,
    rounded to 2; 50.0 when there is no known artist at all.  Ties at the
    cut do not change the value."""
    plays = artist_plays(stg, keys)
    if keys:
        ranked = plays.withColumn(
            "_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*rank_order())))
        agg = ranked.groupBy(*keys).agg(
            F.sum(F.when(F.col("_r") <= k, F.col("plays"))).alias("top_plays"),
            F.sum("plays").alias("all_plays"))
        return agg.select(*keys, F.round(F.col("top_plays") * 100.0 / F.col("all_plays"), 2)
                          .alias("concentration"))
    top = plays.orderBy(*rank_order()).limit(k).agg(F.sum("plays")).scalar()
    total = plays.agg(F.sum("plays").alias("all_plays"))
    return total.select(F.coalesce(F.round(top * 100.0 / F.col("all_plays"), 2),
                                   F.lit(CONCENTRATION_WHEN_NO_ARTIST)).alias("concentration"))


def artist_relative_share(top: DataFrame, keys: Sequence[str] = (),
                          rows: int = RELATIVE_SHARE_ROWS) -> DataFrame:
    """Bar widths of the top artists: plays relative to the first (x100),
    with the 1-based display position, first ``rows`` rows only."""
    w = Window.partitionBy(*keys).orderBy(*rank_order())
    return (top.withColumn("position", F.row_number().over(w).cast("bigint"))
            .withColumn("top_plays", F.max("plays").over(Window.partitionBy(*keys)))
            .filter(F.col("position") <= rows)
            .select(*keys, "position", "artist_clean", "plays",
                    (F.col("plays") / F.col("top_plays") * 100.0).alias("relative_share")))
