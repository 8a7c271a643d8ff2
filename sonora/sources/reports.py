"""Brief sink and latest-brief lookup (text files with time-stamped names)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sonora.session import missing_path


def write_reports(briefs: DataFrame, path: str, stamp: Column, keys: Sequence[str] = ()) -> None:
    """Append each brief as a text file under ``<keys>/report=brief_<stamp>``."""
    (briefs.select(*keys, F.col("brief").alias("value"),
                   F.concat(F.lit("brief_"), stamp).alias("report"))
     .write.mode("append").partitionBy(*keys, "report").text(path))


def latest_report(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """The text of the lexicographically last report (of each key); without
    keys, '' when there is none.

    The files are listed once.  Names come from the partition column alone,
    without reading any text; the texts read are those of the last names.
    """
    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if not missing_path(error):
            raise
        empty = spark.range(0 if keys else 1)
        return empty.select(*[F.lit(None).cast("bigint").alias(k) for k in keys], F.lit("").alias("latest_report"))
    # The text sink ends every file with one line separator; drop exactly it.
    text = F.regexp_replace(F.decode("content", "UTF-8"), r"\n\z", "")
    if keys:
        last = files.groupBy(*keys).agg(F.max("report").alias("report"))
        return files.join(last, [*keys, "report"], "left_semi").select(*keys, text.alias("latest_report"))
    last = files.agg(F.max("report")).scalar()
    return files.filter(F.col("report") == last).agg(F.coalesce(F.max(text), F.lit("")).alias("latest_report"))
