"""Round trips through the landing formats.

The adapter rows are rendered into each foreign format (raw JSON files,
API pages, export HTML) under the shared checkpoint folder, parsed back
with the sources, and loaded; the SQL twin derives the same result from
the adapter rows directly.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sonora.operators.load import RAW_COLUMNS, clean_incoming, dedup_events
from sonora.session import staging_path
from sonora.sources import raw_json, scrobble_pages, watch_history
from sonora.sources.testdata import adapted_events, loaded_at_literal, read_table

# Fixture rule: the export's zone name cycles with the event id.
EXPORT_ZONES = ["CDT", "PST", "UTC", "BST"]
ROWS_PER_FILE = 1000
LARGE_ROWS_PER_FILE = 20_000


def _scratch(spark: SparkSession, kind: str) -> str:
    return staging_path(spark, "landing", f"{kind}-{uuid.uuid4().hex}")


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to render as export blocks: 'error' events are non-music
    entries, 'click' events have no channel anchor."""
    a = adapted_events(spark, sf_dir)
    kinds = read_table(spark, sf_dir, "events").select("event_id", "event_type")
    zone = F.element_at(F.array(*[F.lit(z) for z in EXPORT_ZONES]),
                        (F.pmod(F.col("event_id"), F.lit(len(EXPORT_ZONES))) + 1).cast("int"))
    ts = F.timestamp_seconds("unix_timestamp")
    date_text = F.concat(F.date_format(ts, "MMM d, yyyy, h:mm:ss"), F.lit("\u202f"),
                         F.date_format(ts, "a"), F.lit(" "), zone)
    return a.join(kinds, "event_id").select(
        "event_id",
        F.when(F.col("event_type") == "error", "other").otherwise("music").alias("kind"),
        F.col("event_id").alias("video_id"),
        "track_name",
        F.when(F.col("event_type") == "click", F.lit(None))
        .otherwise(F.concat(F.trim("artist"), F.lit(" - Topic"))).alias("channel"),
        date_text.alias("date_text"))


def parsed_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "export")
    # An export lists its plays in order, here that of the events.
    watch_history.write_export(watch_history.render_blocks(export_rows(spark, sf_dir).orderBy("event_id")), path)
    return watch_history.parse_watch_history(watch_history.read_blocks(spark, path))


def q_parse_watch_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed plays with their coerced epoch."""
    from sonora.operators.load import with_epoch
    return with_epoch(parsed_export(spark, sf_dir)).select(
        "track_name", "artist", "album", "timestamp", "unix_timestamp", "source", "url")


def q_scan_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scrobble rows landed as JSON array files, scanned and loaded."""
    lake = _scratch(spark, "lake")
    a = adapted_events(spark, sf_dir).select("event_id", *RAW_FIELDS_OUT)
    raw_json.write_raw_json(a, lake, "tracks_", "event_id", ROWS_PER_FILE)
    scanned = raw_json.scan_raw_json(spark, lake, file_col="file")
    return _load(scanned)


def q_scan_large_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows landed as fewer, larger arrays, which are parsed as streams."""
    lake = _scratch(spark, "arrays")
    a = adapted_events(spark, sf_dir).select("event_id", *RAW_FIELDS_OUT)
    raw_json.write_raw_json(a, lake, "tracks_", "event_id", LARGE_ROWS_PER_FILE)
    return _load(raw_json.scan_large_arrays(spark, lake, file_col="file"))


RAW_FIELDS_OUT = ["track_name", "artist", "album", "timestamp", "unix_timestamp"]


def _load(scanned: DataFrame) -> DataFrame:
    deduped = dedup_events(clean_incoming(scanned), ["file_name", "pos"])
    return deduped.select(*RAW_COLUMNS, loaded_at_literal().alias("loaded_at"))


def q_union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scrobble files and export-derived files in one lake, loaded together:
    ``takeout_music_*`` sorts first, so the export copy of a second wins."""
    lake = _scratch(spark, "lake2")
    a = adapted_events(spark, sf_dir).select(F.lit("tracks").alias("file_name"), F.col("event_id").alias("pos"), *RAW_FIELDS_OUT)
    raw_json.land_json_lines(a, lake)
    at = F.col("position")
    export = parsed_export(spark, sf_dir).select(
        F.format_string("takeout_music_%s_%015d", at["file"], at["split"]).alias("file_name"), at["row"].alias("pos"), *RAW_FIELDS_OUT)
    raw_json.land_json_lines(export, lake)
    return _load(raw_json.scan_json_lines(spark, lake))


def q_flatten_scrobble_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scrobble rows rendered as API pages (with a now-playing item per
    page) and flattened back."""
    path = _scratch(spark, "pages")
    a = adapted_events(spark, sf_dir).select("event_id", *RAW_FIELDS_OUT)
    scrobble_pages.write_pages(a, path, "event_id")
    flat = scrobble_pages.flatten_pages(scrobble_pages.read_pages(spark, path))
    return flat.select(*RAW_FIELDS_OUT)


def q_incremental_load_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scrobble lake loaded by an available-now stream, then read back."""
    from sonora.streaming.incremental_load import start_incremental_load
    lake, table, ckpt = (_scratch(spark, k) for k in ("stream-lake", "stream-table", "stream-ckpt"))
    a = adapted_events(spark, sf_dir).select("event_id", *RAW_FIELDS_OUT)
    raw_json.write_raw_json(a, lake, "tracks_", "event_id", ROWS_PER_FILE)
    q = start_incremental_load(spark, lake, table, ckpt, file_col="file", loaded_at=loaded_at_literal())
    q.awaitTermination()
    return spark.read.parquet(table).drop("play_date")
