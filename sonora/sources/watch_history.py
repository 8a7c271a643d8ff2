"""Watch-history export: one huge single-line HTML file of entry blocks.

The file is read with the block delimiter as Spark's record separator, so
even one enormous line is split into blocks across many tasks (Hadoop's
line reader stitches records that cross split boundaries); each block is
then parsed with JVM regular expressions.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sonora.fixed_values import (
    EXPORT_BLOCK_DELIMITER,
    EXPORT_CHANNEL_PATTERN,
    EXPORT_DATE_PATTERN,
    EXPORT_MUSIC_MARKER,
    EXPORT_SOURCE,
    EXPORT_TITLE_PATTERN,
    UNKNOWN_ARTIST,
)
from sonora.functions.text import strip_topic_suffix, strip_ws

# (?U): \s and \w follow Unicode, as in the patterns' original dialect
# (the date text has a narrow no-break space before AM/PM).
_TITLE = "(?U)" + EXPORT_TITLE_PATTERN
_CHANNEL = "(?U)" + EXPORT_CHANNEL_PATTERN
# The lookahead skips places where no month can start before the alternation is tried.
_DATE = "(?U)(?=[ADFJMNOS])" + EXPORT_DATE_PATTERN


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Entry blocks of the export(s) under ``path``, one row per block, with
    its landing position: (file name, start of the split, row id), in order
    within a file because a split's rows are read in sequence by one task."""
    blocks = spark.read.option("lineSep", EXPORT_BLOCK_DELIMITER).text(path)
    return blocks.select("value", F.struct(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row")).alias("position"))


def parse_watch_history(blocks: DataFrame) -> DataFrame:
    """Music plays in the export: track_name, artist, album, timestamp,
    unix_timestamp (null), source, url (and the block's position, if read
    with one).

    Blocks without the music marker or the title anchor are skipped; the
    first channel anchor is the artist (" - Topic" removed), or the unknown
    artist when there is none; the date text is null when absent.
    """
    b = F.col("value")
    # Each pattern runs once per block: a matched group is never empty, so
    # an empty extract means "no match".
    position = [c for c in ("position",) if c in blocks.columns]
    parts = blocks.filter(b.contains(EXPORT_MUSIC_MARKER)).select(
        *position,
        F.regexp_extract(b, _TITLE, 1).alias("url"),
        F.regexp_extract(b, _TITLE, 2).alias("title"),
        F.regexp_extract(b, _CHANNEL, 1).alias("channel"),
        F.regexp_extract(b, _DATE, 0).alias("date"))
    channel, date = F.col("channel"), F.col("date")
    artist = F.when(channel != "", strip_topic_suffix(strip_ws(channel))).otherwise(F.lit(UNKNOWN_ARTIST))
    return parts.filter(F.col("url") != "").select(
        strip_ws("title").alias("track_name"),
        artist.alias("artist"),
        F.lit("").alias("album"),
        F.when(date != "", strip_ws(date)).alias("timestamp"),
        F.lit(None).cast("string").alias("unix_timestamp"),
        F.lit(EXPORT_SOURCE).alias("source"),
        F.col("url"),
        *position,
    )


def render_blocks(rows: DataFrame) -> DataFrame:
    """Export blocks from rows with (kind, video_id, track_name, channel,
    date_text); kind 'music' has the marker, 'other' does not; a null
    channel leaves the channel anchor out."""
    marker = F.when(F.col("kind") == "music", F.lit("YouTube Music")).otherwise(F.lit("YouTube"))
    chan = F.when(F.col("channel").isNotNull(), F.concat(
        F.lit('<a href="https://www.youtube.com/channel/UC'), F.col("video_id").cast("string"),
        F.lit('">'), F.col("channel"), F.lit("</a><br>"))).otherwise(F.lit(""))
    return rows.select(F.concat(
        F.lit(EXPORT_BLOCK_DELIMITER), F.lit(' mdl-cell"><div class="header-cell"><p>'), marker,
        F.lit("<br></p></div><div class=\"content-cell\">Watched\u00a0"),
        F.lit('<a href="https://music.youtube.com/watch?v='), F.col("video_id").cast("string"),
        F.lit('">'), F.col("track_name"), F.lit("</a><br>"), chan,
        F.coalesce(F.col("date_text"), F.lit("")), F.lit("<br></div></div>")).alias("value"))


def write_export(blocks: DataFrame, path: str) -> None:
    """Write blocks as single-line files (blocks joined by a space)."""
    blocks.write.mode("overwrite").option("lineSep", " ").text(path)
