"""Packing: documents' token ids end to end, cut into windows of fixed length.

The first pass tokenizes each partition and writes, with every document's ids, the place where the document
begins within its partition. The partitions' totals, added up in order, give each partition's global offset.
The second pass cuts: the stream's window ``s`` is sequence ``s``, and a document that crosses a window's end
leaves one boundary record (a piece) in each window that it touches. Only the last window can be short.

The order is that of the written partitions, so it does not depend on later scans or lost executors; the
first pass's rows are read back, never made again.

Defined cases: a null text counts as empty; an empty text is the end id alone. Repeated rows are packed
each on its own. A null doc_id is carried. An empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonora.llm import words as W
from sonora.llm.shared import prepare, saved, table
from sonora.llm.tokens import default_tokenizer, tokens

SEQUENCE_TOKENS, END_ID = 4096, 2


def _tokenized(path: str, end_id: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, begun = tokens(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            doc_id = batch.column("doc_id")
            for first, data, offsets in W.slices(batch.column("text")):
                words, ends = W.word_array(data, offsets)
                ids, lengths = known.ids(words)
                cut = np.concatenate([[0], np.cumsum(lengths)])[ends]
                ids = np.insert(ids, cut[1:], np.uint32(end_id)).astype("<u4")
                cut = cut + np.arange(len(cut))  # the end ids before each document
                values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer((cut * 4).astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": doc_id.slice(first, len(cut) - 1), "part": np.full(len(cut) - 1, part, np.int64),
                    "begins": begun + cut[:-1], "doc_tokens": np.diff(cut), "ids": values.cast(pa.binary()),
                })
                begun += int(cut[-1])
        known.forget()  # the worker lives on, for tasks of other kinds

    return task


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset and ids (little-endian unsigned 32-bit)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_tokenized(tokenizer or default_tokenizer(), end_id), "doc_id long, part long, begins long, doc_tokens long, ids binary")
    rows = saved(rows, "tokens")
    # One row for each written partition.
    totals = rows.groupBy("part").agg(F.max(F.col("begins") + F.col("doc_tokens")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = rows.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("begins"))
    # Built within the row, so that a long document's ids are not copied for each of its pieces.
    pieces = F.expr(f"""transform(sequence(at div {length}, (at + doc_tokens - 1) div {length}), s -> named_struct(
        'sequence_id', s,
        'start', greatest(at, s * {length}) - at,
        'length', least(at + doc_tokens, (s + 1) * {length}) - greatest(at, s * {length}),
        'offset', greatest(at, s * {length}) - s * {length},
        'ids', substring(ids, cast((greatest(at, s * {length}) - at) * 4 + 1 as int), cast((least(at + doc_tokens, (s + 1) * {length}) - greatest(at, s * {length})) * 4 as int))))""")
    return placed.select("doc_id", "doc_tokens", F.explode(pieces).alias("piece")).select("doc_id", "doc_tokens", "piece.*")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))
