"""Equi-joins in which the plan itself divides frequent keys."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: A key with more than this share of the left rows is divided; each of its parts holds about this share.
HOT_SHARE = 1 / 1000


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """The keys that hold more than ``share`` of all rows, and in how many parts each is to be divided.

    Fewer than 1/share rows whatever the input, with fewer than 2/share parts in all, so the result may be
    broadcast.  Counting combines map-side; only the key column is read.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    part = df.agg(F.count(F.lit(1))).scalar() * share
    return counts.filter(F.col("_n") > part).select(key, F.ceil(F.col("_n") / part).cast("int").alias("_parts"))


def split_join(left: DataFrame, right: DataFrame, key: str, by: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Inner join on ``key`` in which no key of ``left`` lands whole in one task.

    Rows of a hot key are dealt to the key's parts by a hash of the columns ``by``; the other side's rows of
    that key are repeated once for each part.  Keys that are not hot have one part and are not repeated.  The
    result is the plain join's.  Null keys join nothing; an empty side gives an empty result.
    """
    hot = F.broadcast(hot_keys(left, key, share))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    dealt = left.join(hot, key, "left").withColumn("_part", F.pmod(F.xxhash64(*by), parts).cast("int")).drop("_parts")
    repeated = (right.join(hot, key, "left")
                .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts"))
    return dealt.join(repeated, [key, "_part"]).drop("_part")
