"""A training-data pipeline over the documents table, in five stages.

Each stage takes (spark, docs, sf_dir), where docs is what its predecessor wrote, and returns a DataFrame; all
but the last return the columns of docs. Quality rules drop the documents that they reject; SimHash near-dedup
keeps one document of each component; the secret scan masks every span that it finds; mixing gives the copies
and blocks that the mix takes; packing gives the pieces of the packed sequences.

Null texts and empty texts have too few words and go in the first stage; extra columns pass through until
packing. An empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonora.llm import mixing, packing, quality_rules, secret_scan, simhash_dedup
from sonora.llm.shared import prepare, saved, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "text")
    return quality_rules.quality_rules(rows, model, into="verdict").where("verdict.kept").select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.one_of_each(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.masked(docs, secret_scan.trained(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(docs))


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("secret scans", secrets_stage),
    ("mixing sources", mixing_stage),
    ("packing", packing_stage),
]

#: The stages train classifiers and tokenize, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's result is written and read again as the next one's input."""
    docs = table(prepare(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, f"stage-{k}")
    return docs
