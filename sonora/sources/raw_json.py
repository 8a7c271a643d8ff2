"""The raw JSON lake: files that each hold one array of play objects.

Reading keeps each row's landing order -- (file name, position in file) --
which decides which copy of a play second is kept.  Writing groups rows
into files of bounded size, named so that name order is landing order.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Every field is read as text: ``unix_timestamp`` may be a number, a string
# or null in the files, and is coerced later.  Unknown keys are ignored.
RAW_RECORD = ("array<struct<track_name:string,artist:string,album:string,timestamp:string,"
              "unix_timestamp:string,source:string,url:string>>")
RAW_FIELDS = ["track_name", "artist", "album", "timestamp", "unix_timestamp"]


def plays_of(value: Column) -> Column:
    """The play objects of one file's text; null unless it is one whole JSON array."""
    text = F.regexp_replace(value, r"^\s+|\s+$", "")
    whole = text.startswith("[") & text.endswith("]")
    return F.when(whole, F.from_json(value, RAW_RECORD))


def _files(spark: SparkSession, path: str, file_col: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True)
    name = F.col(file_col) if file_col in files.columns else F.col("_metadata.file_name")
    return files.select(name.alias("file_name"), "value")


def exploded(files: DataFrame, on_error: str = "fail") -> DataFrame:
    """Rows of (file_name, value) files.  ``on_error``: "fail" stops at a file that is not one
    JSON array; "skip" leaves it to ``rejected_files``."""
    if on_error not in ("fail", "skip"):
        raise ValueError(f"unknown on_error={on_error!r}")
    plays = plays_of(F.col("value"))
    if on_error == "fail":
        bad = F.raise_error(F.concat(F.lit("not a JSON array of plays: "), F.col("file_name")))
        plays = F.coalesce(plays, bad.cast(RAW_RECORD))
    return files.select("file_name", F.posexplode(plays).alias("pos", "rec")).select("file_name", "pos", "rec.*")


def rejected_files(spark: SparkSession, path: str, file_col: str = "file_name") -> DataFrame:
    """Names and sizes of the files that a scan with ``on_error="skip"`` leaves out."""
    files = _files(spark, path, file_col)
    return files.filter(plays_of(F.col("value")).isNull()).select("file_name", F.char_length("value").alias("n_chars"))


def scan_raw_json(spark: SparkSession, path: str, file_col: str = "file_name", on_error: str = "fail") -> DataFrame:
    """One row per play object: file name, position, and the record fields.

    A file that is not one JSON array of objects stops the scan, or is left
    out and listed by ``rejected_files`` (``on_error="skip"``).  Each file is one task (a JSON array is not splittable); files are
    independent, so the lake is read with as many tasks as it has files.
    ``file_col`` names the column holding the file name (when the lake is
    laid out in ``file=<name>`` folders, that partition value is used).
    """
    return exploded(_files(spark, path, file_col), on_error)


def scan_large_arrays(spark: SparkSession, path: str, file_col: str = "file_name") -> DataFrame:
    """The rows of ``scan_raw_json`` for files too large to be one string (2 GB at most there).

    The parser reads a file's array as a stream, in one pass; no text of the file is kept.  A file is one
    task, which holds the parsed rows of its array.  ``pos`` rises in the order of the array, with gaps
    between files, which is all that first-landed dedup needs.  An array that breaks off and text that is
    no JSON stop the scan; an empty file has no rows, and a file that is one object counts as an array of one.

    ``unix_timestamp`` is read as a variant and made text here: for a number in a text column the parser goes back to
    the file, which reads some kilobytes again for every row.  A number that is no integer may be spelled otherwise
    than in the file (1.50 as 1.5); its value is the same.
    """
    fields = RAW_RECORD.removeprefix("array<struct<").removesuffix(">>").replace(":", " ")
    typed = fields.replace("unix_timestamp string", "unix_timestamp variant")
    rows = spark.read.schema(typed).option("multiLine", True).option("mode", "FAILFAST").json(path)
    names = [field.split(" ")[0] for field in fields.split(",")]
    name = F.col(file_col) if file_col in rows.columns else F.col("_metadata.file_name")
    rows = rows.select(name.alias("file_name"), F.monotonically_increasing_id().alias("pos"), *names)
    return rows.withColumn("unix_timestamp", F.col("unix_timestamp").cast("string"))


def land_json_lines(records: DataFrame, path: str) -> None:
    """Land records as JSON lines that carry their landing order (``file_name``, ``pos``): the files
    split, hold as many rows as their tasks, and need no folder each."""
    records.select("file_name", "pos", *RAW_FIELDS).write.mode("append").json(path)


def scan_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows landed by ``land_json_lines``; a line that is no JSON object stops the scan."""
    fields = ", ".join(f"{c} string" for c in RAW_FIELDS)
    return spark.read.schema(f"file_name string, pos bigint, {fields}").option("mode", "FAILFAST").json(path)


def write_raw_json(records: DataFrame, path: str, prefix: str, order_col: str,
                   rows_per_file: int = 1000) -> None:
    """Land records as JSON array files ``<prefix><n>.json`` of at most
    ``rows_per_file`` rows, in ``order_col`` order (a bounded group per file;
    one folder ``file=<name>`` per file)."""
    bucket = F.floor(F.col(order_col) / rows_per_file)
    fields = [c for c in records.columns if c != order_col]
    grouped = (records.withColumn("_b", bucket)
               .groupBy("_b")
               .agg(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("_o"),
                                                         F.struct(*fields).alias("r")))).alias("_rows")))
    out = grouped.select(
        F.format_string(f"{prefix}%06d.json", F.col("_b")).alias("file"),
        F.to_json(F.transform("_rows", lambda x: x["r"])).alias("value"))
    # The lake is append-only: new files are added next to the old ones.
    out.write.mode("append").partitionBy("file").text(path)
