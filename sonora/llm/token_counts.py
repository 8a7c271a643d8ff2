"""Token counts kept up to date by signed deltas.

Totals by source, language and tokenizer version are additive: an insert adds a document's count, a delete
takes it away, and a revised count does both. A batch of changes is added up by Spark and written as one
folder of the rollup; a folder counts once Spark's commit marker lies in it. Committing a batch id again
changes nothing, and a batch whose writing broke off is written anew. Readers add the committed batches up.

Defined cases: a null text has 0 tokens; null source, lang or doc_id are groups and rows like others.
Repeated rows count each on its own. An empty batch is a committed batch. Groups whose documents and tokens
have all gone are not shown. Extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonora.llm.shared import fresh_path, prepare, remainder, saved, table
from sonora.llm.tokens import default_tokenizer, token_count

KEYS = ["source", "lang", "tokenizer_version"]
_SCHEMA = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"


class Rollup:
    """A folder of committed batches of deltas. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _hadoop(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def committed(self) -> list[str]:
        """The folders of all committed batches."""
        fs, marks = self._hadoop(f"{self.path}/batch=*/_SUCCESS")
        return sorted(str(s.getPath().getParent()) for s in fs.globStatus(marks) or [])

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch up and write it, unless it is already there. ``changes``: KEYS, n_tokens and sign (1 or -1)."""
        folder = f"{self.path}/batch={batch_id}"
        fs, mark = self._hadoop(f"{folder}/_SUCCESS")
        if fs.exists(mark):
            return False
        deltas = changes.groupBy(*KEYS).agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))
        deltas.write.mode("overwrite").parquet(folder)
        return True

    def totals(self) -> DataFrame:
        folders = self.committed()
        if not folders:
            return self.spark.createDataFrame([], _SCHEMA)
        rows = self.spark.read.schema(_SCHEMA).parquet(*folders)
        rows = rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return rows.where("n_docs != 0 or n_tokens != 0")


def inserts(rows: DataFrame) -> DataFrame:
    """Changes that add rows of KEYS and n_tokens."""
    return rows.select(*KEYS, "n_tokens", F.lit(1).alias("sign"))


def deletes(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, "n_tokens", F.lit(-1).alias("sign"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes that take the old counts away and add the new ones."""
    return deletes(old).unionByName(inserts(new))


def counted(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, source, lang and the number of ids of each document's text."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", "source", "lang", token_count(F.col("text"), tokenizer or default_tokenizer()).alias("n_tokens"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted, a tenth is deleted, another tenth is recounted with an end id, and both come back; each batch is sent twice.

    So the committed rollup ends on the whole table's counts under one tokenizer version.
    """
    rows = saved(counted(table(spark, sf_dir, "documents")), "counted")
    tenth = F.coalesce(remainder(F.col("doc_id"), 10), F.lit(0))
    first = rows.withColumn("tokenizer_version", F.lit("word_bpe_49k"))
    second = rows.withColumns({"tokenizer_version": F.lit("word_bpe_49k+end"), "n_tokens": F.col("n_tokens") + 1})
    batches = {"1-load": inserts(first), "2-deleted": deletes(first.where(tenth == 3)), "3-revised": revisions(first.where(tenth == 7), second.where(tenth == 7))}
    batches |= {"4-restored": inserts(first.where(tenth == 3)), "5-revised-back": revisions(second.where(tenth == 7), first.where(tenth == 7))}
    rollup = Rollup(spark, fresh_path(spark, "rollup"))
    for name, changes in [*batches.items(), *batches.items()]:
        rollup.commit(name, changes)
    return rollup.totals()
