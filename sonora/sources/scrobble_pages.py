"""Scrobble API response pages, landed one page document per line."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TRACK = ("struct<name:string,artist:struct<`#text`:string>,album:struct<`#text`:string>,"
         "date:struct<`#text`:string,uts:string>,`@attr`:struct<nowplaying:string>>")
PAGE_SCHEMA = (f"recenttracks struct<`@attr`:struct<page:string,totalPages:string,total:string>,"
               f"track:array<{TRACK}>>")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page documents (JSON Lines, splittable), read with a fixed schema."""
    return spark.read.schema(PAGE_SCHEMA).json(path)


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per played track: page number, position, and the raw fields.

    The "now playing" item (truthy ``@attr.nowplaying``) is dropped; when an
    item has no ``date`` both time fields are null.
    """
    items = pages.select(
        F.col("recenttracks.`@attr`.page").try_cast("bigint").alias("page"),
        F.posexplode("recenttracks.track").alias("pos", "t"))
    now = F.col("t.`@attr`.nowplaying")
    playing = F.coalesce((now.isNotNull()) & (now != ""), F.lit(False))
    return items.filter(~playing).select(
        "page", "pos",
        F.col("t.name").alias("track_name"),
        F.col("t.artist.`#text`").alias("artist"),
        F.col("t.album.`#text`").alias("album"),
        F.col("t.date.`#text`").alias("timestamp"),
        F.col("t.date.uts").try_cast("bigint").alias("unix_timestamp"),
    )


def write_pages(records: DataFrame, path: str, order_col: str, page_size: int = 200) -> None:
    """Render play rows as API pages of ``page_size`` items (newest page
    layout), each with one extra "now playing" item that has no date."""
    page = F.floor(F.col(order_col) / page_size) + 1
    item = F.struct(
        F.col("track_name").alias("name"),
        F.struct(F.col("artist").alias("#text")).alias("artist"),
        F.struct(F.col("album").alias("#text")).alias("album"),
        F.struct(F.col("timestamp").alias("#text"),
                 F.col("unix_timestamp").cast("string").alias("uts")).alias("date"),
        F.struct(F.lit(None).cast("string").alias("nowplaying")).alias("@attr"))
    grouped = (records.withColumn("_p", page)
               .groupBy("_p")
               .agg(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("_o"),
                                                         item.alias("i")))).alias("_items")))
    total_pages = records.agg(F.max(page)).scalar()
    total = records.agg(F.count(F.lit(1))).scalar()
    tracks = F.transform("_items", lambda x: x["i"])
    playing = F.struct(
        F.lit("Now Playing").alias("name"),
        F.struct(F.lit("Someone").alias("#text")).alias("artist"),
        F.struct(F.lit("").alias("#text")).alias("album"),
        F.lit(None).cast("struct<`#text`:string,uts:string>").alias("date"),
        F.struct(F.lit("true").alias("nowplaying")).alias("@attr"))
    doc = F.struct(F.struct(
        F.struct(F.col("_p").cast("string").alias("page"),
                 total_pages.cast("string").alias("totalPages"),
                 total.cast("string").alias("total")).alias("@attr"),
        F.concat(F.array(playing), tracks).alias("track")).alias("recenttracks"))
    grouped.select(F.to_json(doc).alias("value")).write.mode("overwrite").text(path)
