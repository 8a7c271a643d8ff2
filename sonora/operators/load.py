"""Landing -> warehouse: epoch coercion, first-seen dedup, idempotent append."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from sonora.functions.playtime import coerce_unix
from sonora.functions.text import normalize_text

RAW_COLUMNS = ["track_name", "artist", "album", "timestamp", "unix_timestamp"]


def with_epoch(incoming: DataFrame) -> DataFrame:
    """Resolve every row's epoch second (null when it cannot be derived)."""
    numeric = isinstance(incoming.schema["unix_timestamp"].dataType, NumericType)
    return incoming.withColumn(
        "unix_timestamp", coerce_unix(F.col("unix_timestamp"), F.col("timestamp"), numeric))


def clean_incoming(incoming: DataFrame) -> DataFrame:
    """Coerce the epoch, drop rows without one, normalise the three texts.

    The drop is an explode of no or one epoch: a filter would be pushed below the coercion and coerce every row twice.
    """
    numeric = isinstance(incoming.schema["unix_timestamp"].dataType, NumericType)
    epoch = coerce_unix(F.col("unix_timestamp"), F.col("timestamp"), numeric)
    known = F.explode(F.array_compact(F.array(epoch))).alias("unix_timestamp")
    texts = {c: normalize_text(c) for c in ("track_name", "artist", "album")}
    return incoming.select(*[known if c == "unix_timestamp" else texts.get(c, F.col(c)).alias(c) for c in incoming.columns])


def dedup_events(df: DataFrame, order_by: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Keep the first-landed row per play identity ``keys + [unix_timestamp]``.

    "First" is the smallest ``order_by`` tuple (file name, position).  This is
    an aggregation, not a window: ``min_by`` combines map-side, so a single
    hot second (or listener) never lands whole in one task.
    """
    ident = [*keys, "unix_timestamp"]
    payload = [c for c in df.columns if c not in ident]
    order = F.struct(*order_by)
    picked = (df.groupBy(*ident)
              .agg(F.min_by(F.struct(*payload), order).alias("_first")))
    return picked.select(*ident, *[F.col("_first")[c].alias(c) for c in payload])


def new_events(incoming: DataFrame, existing: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Incoming plays whose identity is not in the table yet (NOT EXISTS)."""
    ident = [*keys, "unix_timestamp"]
    return incoming.join(existing.select(*ident), on=ident, how="left_anti")


def load_events(existing: DataFrame, incoming: DataFrame, order_by: Sequence[str],
                keys: Sequence[str] = (), loaded_at=None) -> DataFrame:
    """The rows an idempotent load appends: clean -> dedup -> anti-join.

    Appending the result to ``existing`` gives the new table; loading the
    same files again appends nothing.
    """
    staged = dedup_events(clean_incoming(incoming), order_by, keys)
    fresh = new_events(staged, existing, keys)
    stamp = loaded_at if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return fresh.select(*keys, *RAW_COLUMNS, stamp.alias("loaded_at"))


def play_date(epoch: str = "unix_timestamp") -> Column:
    """The (UTC) day of a play, by which the appended table is partitioned."""
    return F.timestamp_seconds(epoch).cast("date")


def on_days_of(table: DataFrame, staged: DataFrame) -> DataFrame:
    """The rows of ``table`` (partitioned by ``play_date``) on the days of ``staged``.

    Dynamic partition pruning by the set of days: only their partitions are scanned, so a stray date costs its own
    partition and not the history up to it.  The broadcast side has one row for each day.
    """
    days = staged.groupBy("play_date").agg(F.count("*").alias("n")).where("n > 0").select("play_date")
    return table.join(F.broadcast(days), "play_date", "left_semi")


def fresh_events(existing: DataFrame, incoming: DataFrame, order_by: Sequence[str],
                 keys: Sequence[str] = ()) -> DataFrame:
    """Rows of a load, with their ``play_date``, that the table (partitioned by it) lacks; only the load's days are read."""
    staged = dedup_events(clean_incoming(incoming), order_by, keys).withColumn("play_date", play_date())
    return new_events(staged, on_days_of(existing, staged), keys)


def append_events(existing: DataFrame, table_dir: str, incoming: DataFrame, order_by: Sequence[str],
                  keys: Sequence[str] = (), loaded_at: Column | None = None) -> None:
    """Append a load to the table at ``table_dir``; loading the same rows again appends nothing.

    The load's first landings are written beside the table once; the days, the look-up and the append read that.
    """
    stamp = loaded_at if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    staged = dedup_events(clean_incoming(incoming), order_by, keys).withColumn("play_date", play_date())
    staged_dir = f"{table_dir.rstrip('/')}-staged"
    staged.write.mode("overwrite").parquet(staged_dir)
    staged = existing.sparkSession.read.schema(staged.schema).parquet(staged_dir)
    rows = new_events(staged, on_days_of(existing, staged), keys)
    rows = rows.select(*keys, *RAW_COLUMNS, stamp.alias("loaded_at"), "play_date")
    rows.write.mode("append").partitionBy("play_date").parquet(table_dir)


def load_audit(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row: rows before, after, inserted, already present, skipped.

    The load is read once and reduced to its identities (with how often each
    arrived; plays without a time share the null second), which are looked
    up in the table; the counts are sums of flags.
    """
    ident = [*keys, "unix_timestamp"]
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    seconds = with_epoch(incoming).groupBy(*ident).agg(F.count("*").alias("n"))
    present = existing.select(*ident).distinct().withColumn("_present", F.lit(True))
    timed, known = F.col("unix_timestamp").isNotNull(), F.col("_present").isNotNull()
    flagged = seconds.join(present, on=ident, how="left").select(
        zero.alias("b"), F.when(timed & known, one).otherwise(zero).alias("p"),
        F.when(timed & ~known, one).otherwise(zero).alias("i"), F.when(timed, zero).otherwise(F.col("n")).alias("s"))
    table = existing.select(one.alias("b"), zero.alias("p"), zero.alias("i"), zero.alias("s"))
    totals = table.unionByName(flagged).agg(*[F.coalesce(F.sum(c), zero).alias(c) for c in ("b", "p", "i", "s")])
    return totals.select(
        F.col("b").alias("before"),
        (F.col("b") + F.col("i")).alias("after"),
        F.col("i").alias("inserted"),
        F.col("p").alias("already_present"),
        F.col("s").alias("skipped"),
    )
