"""Growth by track: plays of the last days against those of the days before."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

GROWTH_DAYS = 7


def track_growth(stg: DataFrame, keys: Sequence[str] = (), days: int = GROWTH_DAYS) -> DataFrame:
    """For each track and day: its plays, the plays of the ``days`` days up to it, those of the ``days`` days before
    them, the difference, and their ratio to 4 places (null when there were none before).

    A track has a row for every day from its first play until both frames are empty again after its last one or the
    landed days end.  Plays are counted map-side, and a window sees one row for each day with plays of one track (and
    listener), never plays; with the row go the counts of the fewer than ``2 * days`` days before it and the next day
    with plays.  The days up to that one have no plays: they are filled in, and framed from these counts, after the
    window, so that only days with plays are shuffled and sorted, and there is no join.  Untitled plays are a track of
    their own, plays with a null name are none.  An empty table gives an empty result.
    """
    ident = [*keys, "track_name"]
    named = stg.filter(F.col("track_name").isNotNull() & F.col("played_date").isNotNull())
    counted = named.groupBy(*ident, F.col("played_date").cast("date").alias("played")).agg(F.count(F.lit(1)).alias("n"))
    last_day = named.agg(F.max("played_date").cast("date")).scalar()
    by_day = Window.partitionBy(*ident).orderBy(F.unix_date("played"))
    near = F.collect_list(F.struct("played", "n")).over(by_day.rangeBetween(1 - 2 * days, 0))
    near_days = counted.select(*ident, "played", "n", near.alias("near"), F.lead("played").over(by_day).alias("next"))
    until = F.coalesce(F.date_sub("next", 1), F.least(F.date_add("played", 2 * days - 1), last_day))
    filled = near_days.select(*ident, "played", "n", "near", F.explode(F.sequence("played", until)).alias("day"))

    def plays_ago(first: int, last: int) -> Column:
        """The plays of ``first`` to ``last`` days ago."""
        def add(total: Column, one: Column) -> Column:
            return total + F.when(F.date_diff("day", one["played"]).between(first, last), one["n"]).otherwise(0)
        return F.aggregate("near", F.lit(0).cast("bigint"), add)

    plays = F.when(F.col("day") == F.col("played"), F.col("n")).otherwise(F.lit(0).cast("bigint"))
    framed = filled.select(*ident, "day", plays.alias("plays"), plays_ago(0, days - 1).alias("recent"),
                           plays_ago(days, 2 * days - 1).alias("before"))
    return framed.select(*ident, "day", "plays", "recent", "before", (F.col("recent") - F.col("before")).alias("growth"),
                         F.round(F.try_divide(F.col("recent"), F.col("before")), 4).alias("ratio"))
