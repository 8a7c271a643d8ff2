"""Target-distribution importance resampling: draw the documents whose n-grams look like a target's.

Features are the runs of 1 to ``longest`` words, hashed to ``buckets`` buckets. The first pass counts the buckets of all
documents and of all target texts; each task sends one count for each bucket. A bucket's gain is the logarithm of
its share in the target over its share in the documents, in whole thousandths. The second pass scores the
documents by array lookups in the gains, adds Gumbel noise made from the id, and writes the scores.

The best scores are found by numeric threshold bisection: exact count jobs over the written scores halve the
interval that holds the cutoff, three times a job. Documents tied at the cutoff are bisected in the same way by
doc_id, by n_features and at last by the row's own number, so that exactly as many rows are drawn as wanted. The drawn
rows are range-partitioned in that order; a row's rank is its place in its partition after the partitions before.

Only the buckets' gains and one number for each partition reach the driver.

Defined cases: a null or empty text has no features, weight 0 and too few words to be drawn. Very long texts are
worked on in slices of one text. A null doc_id draws its noise as the empty text and comes last among ties.
Repeated rows share a score and may all be drawn. Without target texts every gain follows from the smoothing alone.
An empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonora.llm import words as W
from sonora.llm.shared import prepare, saved, table

LONGEST, BUCKETS, LEAST_WORDS, SEED = 3, 10_000, 20, 42
#: The share of the documents with enough words that is drawn, in hundredths.
PERCENT = 5
_LAST = (1 << 63) - 1
#: Lower-cases A-Z and turns all other ASCII characters but digits and letters into spaces.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def _features(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """For slices of the texts: the first row, the rows' word offsets, and for each length the places of the words
    that end a feature of that length and the features' buckets."""
    for first, data, offsets in W.slices(texts):
        words, ends = W.split_words(np.frombuffer(data.tobytes().translate(_WORDS), np.uint8), offsets)
        spaced = [b" " + w for w in words]
        # A word's place in its text; a feature may not begin before the text.
        place = np.arange(len(words)) - np.repeat(ends[:-1], np.diff(ends))
        codes, found = list(map(crc32, words)), []
        for length in range(1, longest + 1):
            whole = np.flatnonzero(place >= length - 1)
            # codes[k] is the checksum of the ``length`` words up to word k + length - 1.
            found.append((whole, np.array(codes, np.int64)[whole - length + 1] % buckets))
            codes = list(map(crc32, spaced[length:], codes))
        yield first, ends, found


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and ``n``, the features of the column ``text`` that fall into it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for *_, found in _features(batch.column("text"), longest, buckets):
                for _, bucket in found:
                    total += np.bincount(bucket, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": hit, "n": total[hit]})

    return texts.select("text").mapInArrow(task, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Of each bucket, 1000 times the logarithm of its smoothed share in the target over that in the documents, rounded down."""
    s, t = (np.zeros(buckets, np.int64) for _ in range(2))
    for counts, texts in ((s, docs), (t, target)):
        for r in bucket_counts(texts, longest, buckets).collect():  # one row for each bucket
            counts[r.bucket] = r.n
    wide, narrow = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((float(b) + 1) * wide / ((float(a) + 1) * narrow))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def _noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the seeded id's checksum."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    u = (h.cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(u)))


def scored(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight (the sum of the features' gains) and score (with noise) of each document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ends, found in _features(batch.column("text"), longest, len(gain)):
                n = len(ends) - 1
                per_word, per_count = np.zeros(ends[-1], np.int64), np.zeros(ends[-1], np.int64)
                for at, bucket in found:
                    per_word[at] += gain[bucket]
                    per_count[at] += 1
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, n), *(pa.array(x) for x in (np.diff(ends), W.sums(per_count, ends), W.sums(per_word, ends)))], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, "doc_id long, n_words long, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))


def _cut(rows: DataFrame, key: str, wanted: int) -> tuple[int, int]:
    """The ``wanted``-th least value of a whole-numbered column, and how many rows lie below it; by bisection with
    exact counts, three halvings a job."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    below = 0
    while low < high:
        steps = sorted({low + (high - low) * k // 8 for k in range(1, 8)} - {high})
        counts = rows.agg(*(F.count_if(F.col(key) <= s) for s in steps)).first()
        for step, n in zip(steps, counts):
            if n >= wanted:
                high = step
                break
            low, below = step + 1, n
    return low, below


def ranked(rows: DataFrame, may: Column, wanted: int, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``: from 1 for the ``wanted`` rows with ``may`` that come first in the order of some
    whole-numbered columns without nulls (the last of them unique), null for the others. ``rows`` is a written table:
    each job reads it."""
    unranked = F.lit(None).cast("long")
    if wanted <= 0:
        return rows.withColumn("rank", unranked)
    drawn, tied, left = F.lit(False), may, wanted
    for key in order:
        cut, below = _cut(rows.where(tied), key, left)
        drawn, tied, left = drawn | (tied & (F.col(key) < cut)), tied & (F.col(key) == cut), left - below
    drawn = drawn | tied
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.where(drawn).repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = saved(placed.withColumns({"part": F.shiftright("at", 33).cast("int"), "at": F.col("at").bitwiseAND((1 << 33) - 1)}), "ranked")
    before, bases = 0, []
    for part, rows_in in sorted(placed.groupBy("part").count().collect()):  # one row for each partition
        bases.append((part, before))
        before += rows_in
    placed = placed.join(F.broadcast(rows.sparkSession.createDataFrame(bases, "part int, base long")), "part")
    placed = placed.withColumn("rank", F.col("base") + F.col("at") + 1).drop("part", "at", "base")
    return rows.where(~drawn).withColumn("rank", unranked).unionByName(placed)


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of each document; the rank is null where it was not drawn. ``docs``
    has doc_id and text, ``target`` has text."""
    prepare(docs.sparkSession)
    rows = scored(docs, gains(docs, target, longest, buckets), longest, seed)
    rows = saved(rows.withColumns({"down": -F.col("score"), "tie": F.coalesce("doc_id", F.lit(_LAST)), "row": F.monotonically_increasing_id()}), "scores")
    enough = F.col("n_words") >= least_words
    drawn = ranked(rows, enough, rows.where(enough).count() * percent // 100, ["down", "tie", "n_features", "row"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
