"""Incremental, idempotent loading of the raw JSON lake with Structured Streaming.

New files in the landing folder are picked up by the file source; each
micro-batch is cleaned, de-duplicated by first landing order and anti-joined
against the table already written, then appended.  The anti-join against the
*table* (not against streaming state) is what makes a replayed batch after a
failure insert nothing twice, and it keeps no unbounded state in the stream.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from sonora.operators.load import append_events
from sonora.session import missing_path
from sonora.sources.raw_json import exploded

TABLE_SCHEMA = ("track_name string, artist string, album string, timestamp string, "
                "unix_timestamp bigint, loaded_at timestamp_ntz, play_date date")


def lake_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None,
                file_col: str = "file_name") -> DataFrame:
    """Streaming rows of the raw JSON lake: file name, position, record fields
    (``file_col`` as in ``scan_raw_json`` for ``file=<name>`` folder layouts)."""
    reader = spark.readStream.option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.text(landing_dir)
    name = F.col(file_col) if file_col in files.columns else F.col("_metadata.file_name")
    return exploded(files.select(name.alias("file_name"), "value"))


def existing_events(spark: SparkSession, table_dir: str, keys: Sequence[str] = ()) -> DataFrame:
    """The appended table, empty when nothing has been written yet."""
    schema = "".join(f"{k} bigint, " for k in keys) + TABLE_SCHEMA
    try:
        return spark.read.schema(schema).parquet(table_dir)
    except AnalysisException as error:
        if not missing_path(error):
            raise
        return spark.createDataFrame([], schema)


def append_new(batch: DataFrame, table_dir: str, keys: Sequence[str] = (), loaded_at=None) -> None:
    """One micro-batch: clean, first-seen dedup, anti-join the table's days, append."""
    existing = existing_events(batch.sparkSession, table_dir, keys)
    append_events(existing, table_dir, batch, ["file_name", "pos"], keys, loaded_at)


def start_incremental_load(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_dir: str,
                           keys: Sequence[str] = (), available_now: bool = True,
                           max_files_per_trigger: int | None = None, file_col: str = "file_name",
                           loaded_at=None):
    """Start the stream; ``available_now`` processes what has landed and stops."""
    writer = (lake_stream(spark, landing_dir, max_files_per_trigger, file_col).writeStream
              .foreachBatch(lambda df, _id: append_new(df, table_dir, keys, loaded_at))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
