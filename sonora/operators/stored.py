"""Stored tables that loads change in place: day-partitioned plays, keyed profiles, backfilled features.

All three live under one folder of shared storage and survive a run that breaks off: what a run has not committed
is not read, and running the same step again completes it.  Each table has one writer at a time.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from sonora.functions.text import normalize_text
from sonora.operators.daily import SUMS, daily_mood, daily_sums
from sonora.operators.features import build_track_features, new_tracks
from sonora.operators.load import RAW_COLUMNS, dedup_events, new_events, on_days_of, play_date, with_epoch
from sonora.operators.upsert import upsert
from sonora.session import missing_path

#: A day's rows of one load go to so many files, so that a hot day is not one task's.
FILES_OF_A_DAY = 8
NO_TIME, BAD_TIME = "no time given", "time not understood"


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The parquet table at ``path``; empty where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if not missing_path(error):
            raise
        return spark.createDataFrame([], schema)


class PlayTable:
    """``raw_listening_events`` under ``path``, partitioned by play date, with the rejects and a log of its loads.

    A load reads its input once: every row is resolved and written to ``landed/load=n``, accepted and rejected rows
    apart, while ``observe`` counts them.  The accepted rows are reduced to their first landings, looked up in the
    partitions of *their own days* (dynamic partition pruning by the set of days, so one stray date costs one
    partition, not the history between), and what is new is appended.  The log holds ``begun`` and ``done`` rows; it
    carries the table's size from load to load, so no load counts the table.  A load that broke off before its append
    was committed has left nothing; one that broke off after it is found again by its number in the table, and the
    table is counted once.
    """

    LOG = "load bigint, state string, before bigint, inserted bigint, already_present bigint, skipped bigint"

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ()) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), tuple(keys)
        self.ident = [*self.keys, "unix_timestamp"]
        self.schema = ("".join(f"{k} bigint, " for k in self.keys) + "track_name string, artist string, album string, "
                       "timestamp string, unix_timestamp bigint, loaded_at timestamp_ntz, load bigint, play_date date")

    def rows(self) -> DataFrame:
        """The table, with ``play_date`` (the partition) and the number of the ``load`` that brought each row."""
        return read_if_there(self.spark, f"{self.path}/plays", self.schema)

    def log(self) -> DataFrame:
        return read_if_there(self.spark, f"{self.path}/log", self.LOG)

    def rejects(self, order: str = "") -> DataFrame:
        """Every row that a finished load refused, as it arrived (texts untouched), with the reason; ``order`` declares
        the columns (name type, ...) of the landing order, where they are wanted too."""
        fields = (f"{order}, " if order else "") + "".join(f"{k} bigint, " for k in self.keys) + "track_name string, artist string, album string, timestamp string, epoch_text string"
        found = read_if_there(self.spark, f"{self.path}/landed", f"{fields}, reason string, load bigint, accepted boolean")
        done = self.log().where("state = 'done'").select("load")
        return found.where("not accepted").drop("accepted").join(F.broadcast(done), "load", "left_semi")  # one row a load

    def _write_log(self, *row) -> None:
        self.spark.createDataFrame([row], self.LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def _size(self) -> tuple[int, int]:
        """The last load's number and the rows of the table, from the log (a few rows for each load)."""
        last = self.log().orderBy(F.col("load").desc(), F.col("state").desc()).first()  # "done" after "begun"
        if last is None:
            return 0, 0
        if last.state == "done":
            return last.load, last.before + last.inserted
        return last.load, self.rows().count()  # the last load broke off: its rows are all there or none is

    def landed(self, incoming: DataFrame, load: int, order_by: Sequence[str]) -> tuple[DataFrame, int]:
        """Read the load once: resolve, split and write it.  Its accepted rows, and how many were rejected."""
        given = F.col("unix_timestamp").cast("string")
        resolved = with_epoch(incoming.withColumn("epoch_text", given))
        blank = F.coalesce(F.trim("timestamp"), F.lit("")) == ""
        blank &= F.coalesce(F.trim("epoch_text"), F.lit("0")).isin("", "0")
        accepted = F.col("unix_timestamp").isNotNull()
        resolved = resolved.select(*self.keys, *RAW_COLUMNS, "epoch_text", *[c for c in order_by if c not in self.ident],
                                   F.when(accepted, None).when(blank, NO_TIME).otherwise(BAD_TIME).alias("reason"), accepted.alias("accepted"))
        seen = Observation()
        counted = resolved.observe(seen, F.count_if(~F.col("accepted")).alias("skipped"))
        path = f"{self.path}/landed/load={load}"
        counted.write.mode("overwrite").partitionBy("accepted").parquet(path)
        rows = self.spark.read.schema(resolved.schema).parquet(path).where("accepted")
        return rows.withColumns({c: normalize_text(c) for c in ("track_name", "artist", "album")}), int(seen.get["skipped"])

    def near(self, staged: DataFrame) -> DataFrame:
        """The identities of the plays on the days of ``staged``."""
        return on_days_of(self.rows(), staged).select(*self.ident)

    def load(self, incoming: DataFrame, order_by: Sequence[str], loaded_at: Column | None = None) -> DataFrame:
        """Append what the table lacks; loading the same rows again appends nothing.  One row: before, after,
        inserted, already_present, skipped.

        ``incoming`` has the keys, the raw columns and ``order_by``, by which the first landing of a play counts.
        """
        number, before = self._size()
        number += 1
        accepted, skipped = self.landed(incoming, number, order_by)
        first = dedup_events(accepted.select(*self.keys, *RAW_COLUMNS, *[c for c in order_by if c not in self.ident]), order_by, self.keys)
        staged = first.select(*self.keys, *RAW_COLUMNS, play_date().alias("play_date"))
        staged_path = f"{self.path}/staged/load={number}"
        staged.write.mode("overwrite").parquet(staged_path)
        staged = self.spark.read.schema(staged.schema).parquet(staged_path)
        self._write_log(number, "begun", before, None, None, skipped)
        stamp = loaded_at if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
        fresh = new_events(staged, self.near(staged), self.keys)
        fresh = fresh.select(*self.keys, *RAW_COLUMNS, stamp.alias("loaded_at"), F.lit(number).cast("bigint").alias("load"), "play_date")
        spread = F.pmod(F.xxhash64(*self.ident), F.lit(FILES_OF_A_DAY))
        fresh.repartition("play_date", spread).write.mode("append").partitionBy("play_date").parquet(f"{self.path}/plays")
        # Counts of written files come from their footers; of the days' files, only this load's have its number.
        inserted = on_days_of(self.rows(), staged).where(F.col("load") == number).count()
        present = staged.count() - inserted
        self._write_log(number, "done", before, inserted, present, skipped)
        return self.spark.createDataFrame([(before, before + inserted, inserted, present, skipped)], "before bigint, after bigint, inserted bigint, already_present bigint, skipped bigint")


class DailyTable:
    """``stg_daily_mood`` under ``path``, kept as additive sums in one partition for each day.

    ``add`` rolls up the plays of one load only, adds the sums to those of the load's days and replaces these days'
    partitions; other days are neither read nor written.  Each row remembers the last load in it, so a load that is
    added again, or whose replacement broke off half way, counts once.  Loads are added in their order.  ``refresh``
    rolls some days up anew, for features that came later than the plays.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ()) -> None:
        self.spark, self.path, self.keys = spark, path.rstrip("/"), tuple(keys)
        sums = [f"{c} {'double' if c.startswith('s_') else 'bigint'}" for c in SUMS]
        self.schema = ", ".join([*(f"{k} bigint" for k in self.keys), "played_date timestamp", *sums, "last_load bigint", "play_date date"])

    def stored(self) -> DataFrame:
        return read_if_there(self.spark, f"{self.path}/days", self.schema)

    def rows(self) -> DataFrame:
        """The daily moods of all loads so far."""
        return daily_mood(self.stored(), self.keys)

    def _written(self, sums: DataFrame, name: str) -> DataFrame:
        columns = self.stored().columns
        sums.select(*columns).write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{name}").select(*columns)

    def _replace(self, days: DataFrame) -> None:
        ready = self._written(days, "next")
        (ready.repartition("play_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("play_date").parquet(f"{self.path}/days"))

    def _sums(self, stg: DataFrame, features: DataFrame, load: int) -> DataFrame:
        return daily_sums(stg, features, self.keys).withColumns({"last_load": F.lit(load).cast("bigint"), "play_date": F.col("played_date").cast("date")})

    def add(self, load: int, stg: DataFrame, features: DataFrame) -> None:
        """Add the staged plays ``stg`` of load number ``load``."""
        new = self._written(self._sums(stg, features, load), "arrived")
        old = on_days_of(self.stored(), new)
        applied = old.groupBy("play_date").agg(F.max("last_load").alias("applied"))
        due = new.join(applied, "play_date", "left").where(F.coalesce("applied", F.lit(-1)) < load).select(*new.columns)
        both = old.unionByName(due).groupBy(*self.keys, "played_date", "play_date")
        self._replace(both.agg(*(F.sum(c).alias(c) for c in SUMS), F.max("last_load").alias("last_load")))

    def refresh(self, days: DataFrame, plays: DataFrame, stage, features: DataFrame, load: int) -> None:
        """Roll the days of ``days`` (a play_date) up again, from the stored ``plays`` of these days alone; ``stage``
        makes staged plays of them.  ``load`` is the last load among them."""
        self._replace(self._sums(stage(on_days_of(plays, days)), features, load))


class KeyedTable:
    """Rows with a key under ``path``, in hash buckets; an upsert rewrites only the buckets of its keys.

    The new state of the touched buckets is written beside the table first and then replaces them by a dynamic
    partition overwrite.  If the replacement breaks off, the same upsert again gives the same table.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], schema: str, buckets: int = 64) -> None:
        self.spark, self.path, self.key, self.schema, self.buckets = spark, path.rstrip("/"), list(key), schema, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame:
        return read_if_there(self.spark, f"{self.path}/rows", f"{self.schema}, bucket int")

    def rows(self) -> DataFrame:
        return self._stored().drop("bucket")

    def upsert(self, updates: DataFrame, order_by: Sequence[str] = ("updated_at",)) -> list[int]:
        """Replace or add one row for each key of ``updates`` (the last by ``order_by``); the buckets rewritten."""
        columns = self.rows().columns
        path = f"{self.path}/updates"
        # Dealt by bucket first: else every task would write a file for each of the buckets.
        dealt = updates.select(*columns, self._bucket().alias("bucket")).repartition("bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)
        arrived = self.spark.read.schema(f"{self.schema}, bucket int").parquet(path)
        touched = sorted(r.bucket for r in arrived.select("bucket").distinct().collect())  # at most ``buckets``
        if not touched:
            return []
        old = self._stored().where(F.col("bucket").isin(touched))
        new = upsert(old, arrived, ["bucket", *self.key], order_by)
        new.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/next")
        ready = self.spark.read.schema(f"{self.schema}, bucket int").parquet(f"{self.path}/next")
        (ready.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(f"{self.path}/rows"))
        return touched


class FeatureTable:
    """``track_features`` under ``path``, filled in batches of at most ``limit`` pairs.

    A backfill first writes its work list: the pairs without features, in order, numbered through and cut into
    batches.  Each batch is one folder, whose ``_SUCCESS`` file is its commit; together they are the ordered log.  A run
    that breaks off leaves the work list and the committed batches; the next run goes on behind them, and starts a
    new work list only when the old one is done.
    """

    SCHEMA = ("track_name string, artist string, energy float, valence float, tempo float, danceability float, "
              "acousticness float, mood_label string, source string, fetched_at timestamp_ntz, batch bigint")

    def __init__(self, spark: SparkSession, path: str, limit: int, by: str = "track_name") -> None:
        self.spark, self.path, self.limit, self.by = spark, path.rstrip("/"), limit, by

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _folders(self, name: str) -> list[int]:
        """The numbers of the committed folders ``name=n``."""
        fs, path = self._fs(f"{self.path}/{name}")
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        found = [int(n.split("=")[1]) for n in names if n.startswith(f"{name}=")]
        return sorted(n for n in found if fs.exists(self._fs(f"{self.path}/{name}/{name}={n}/_SUCCESS")[1]))

    def rows(self) -> DataFrame:
        """The features of all committed batches."""
        done = self._folders("batch")
        if not done:
            return self.spark.createDataFrame([], self.SCHEMA).drop("batch")
        found = self.spark.read.schema(self.SCHEMA).option("basePath", f"{self.path}/batch").parquet(*[f"{self.path}/batch/batch={n}" for n in done])
        return found.drop("batch")

    def _work(self, stg: DataFrame) -> tuple[DataFrame, int, int]:
        """The open work list (a new one where the last is done), its first batch and the one behind its last."""
        lists, done = self._folders("list"), self._folders("batch")
        after = done[-1] + 1 if done else 0
        schema = "track_name string, artist string, batch bigint"
        if lists:
            work = self.spark.read.schema(schema).parquet(f"{self.path}/list/list={lists[-1]}")
            last = work.agg(F.max("batch")).scalar()
            end = self.spark.range(1).select(F.coalesce(last, F.lit(-1))).first()[0] + 1
            if end > after:
                return work, after, end
        pairs = new_tracks(stg, self.rows(), self.by)
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        order = ["track_name", "artist"]
        scratch = f"{self.path}/sorted"
        at = F.monotonically_increasing_id()
        pairs.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", at).write.mode("overwrite").parquet(scratch)
        placed = self.spark.read.schema("track_name string, artist string, at bigint").parquet(scratch).withColumn("part", F.shiftright("at", 33))
        bases, total = [], 0
        for part, rows in sorted(placed.groupBy("part").count().collect()):  # one row for each partition
            bases.append((part, total))
            total += rows
        base = self.spark.createDataFrame(bases, "part bigint, base bigint")
        position = F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1)
        work = placed.join(F.broadcast(base), "part").select(*order, (F.floor(position / self.limit) + after).cast("bigint").alias("batch"))
        path = f"{self.path}/list/list={lists[-1] + 1 if lists else 0}"
        work.write.mode("overwrite").partitionBy("batch").parquet(path)
        return self.spark.read.schema(schema).parquet(path), after, after + -(-total // self.limit)

    def backfill(self, stg: DataFrame, most_batches: int | None = None, fetched_at: Column | None = None) -> int:
        """Run the open batches in order, ``most_batches`` at most; how many are still open.

        Each batch is checked against the table again, so with ``by='track_name'`` a name that an earlier batch featured
        is skipped for its other artists (as in the original); ``by='pair'`` loses no pair.
        """
        work, first, end = self._work(stg)
        last = end if most_batches is None else min(end, first + most_batches)
        for batch in range(first, last):
            pairs = new_tracks(work.where(F.col("batch") == batch).select("track_name", F.col("artist").alias("artist_clean")), self.rows(), self.by)
            build_track_features(pairs, fetched_at).write.mode("overwrite").parquet(f"{self.path}/batch/batch={batch}")
        return end - last
