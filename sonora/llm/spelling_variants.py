"""Spelling variant grouping: words one edit apart, found by blocked Gram matrices of letter counts.

**Words.** Each task counts the words of its documents and sends one count for each distinct word; the sums are
the corpus counts. So that variants occur, one in ``slip_every`` (document, word) pairs, chosen by a checksum,
loses one letter.

**Blocks.** Two words are near if one inserted, deleted or replaced code point makes them equal; so their lengths
are equal or adjacent, and if the shorter has ``m`` code points, either its first ``m // 2`` or its last
``m - m // 2`` stand unchanged at that end of both. A block holds the words of lengths m and m + 1 with one such end;
each word is in four blocks at most, and every near pair meets in one. A block of more than ``block_limit`` words is
divided again: what its words do not share yet is halved in the same way, until one code point is left, when a block
cannot have more words than the alphabet has runs of two. No block is cut off and no pair is lost.

**Gram matrices.** A task lines its blocks up, counts letters in NumPy tiles and multiplies the tiles: lengths of the
count vectors and their products give squared distances. One edit moves the counts by 1 or 2, so pairs of one
block, of equal or adjacent lengths, at squared distance 1 or 2 are kept, and their edits are verified.

Forms and near counts are combining aggregates over the distinct near pairs; roots are found by jumps along the
forms, which double at each round, and every round is written to the shared folder.

Defined cases: a null or empty text has no words. A null doc_id's checksums are those of the empty id. Very long texts
and words only make longer rows. Repeated rows count again. Ties between forms go to the word that comes first in
code-point order. An empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonora.llm import words as W
from sonora.llm.shared import prepare, saved, table

LEAST_LENGTH, LEAST_COUNT, SLIP_EVERY, FORM_RATIO = 6, 5, 199, 5
BLOCK_LIMIT, TILE = 2048, 512
#: Distinct words that a task counts before it sends them.
WORDS_HELD = 200_000
#: Lower-cases A-Z and turns all other ASCII characters but letters into spaces.
_LETTERS = np.array([c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256)], np.uint8)
#: The row of a letter count for each code point below U+0100 (a word has a to z and U+00C0 to U+00FF only).
_ROW = np.array([c - 97 if 97 <= c <= 122 else 26 + c - 0xC0 if c >= 0xC0 else 0 for c in range(256)])
_ROWS = 26 + 64


def _only_letters(data: np.ndarray) -> np.ndarray:
    """The bytes with a space for each that is no part of a letter."""
    data = _LETTERS[data]
    if (data >= 128).any():
        # U+00C0 to U+00FF are the byte C3 and a byte from 80 to BF.
        lead = data == 0xC3
        other = (data >= 128) & ~lead
        other[1:] &= ~lead[:-1]
        data[other] = 32
    return data


def _slipped(word: bytes, code: int) -> bytes:
    text = word.decode()
    k = code % len(text)
    return (text[:k] + text[k + 1 :]).encode()


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, slip_every: int = SLIP_EVERY) -> DataFrame:
    """``word`` and ``n``, its occurrences, of all words with ``least_length`` code points or more."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = Counter()

        def sent() -> pa.RecordBatch:
            long = [w for w in total if len(w) >= least_length and (w.isascii() or len(w.decode()) >= least_length)]
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in long], pa.string()), pa.array([total[w] for w in long], pa.int64())], names=["word", "n"])

        for batch in batches:
            ids = batch.column("id").to_pylist()
            for first, data, offsets in W.slices(batch.column("text")):
                raw = _only_letters(data).tobytes()
                for doc, a, b in zip(ids[first:], offsets[:-1].tolist(), offsets[1:].tolist()):
                    found = Counter([w for w in raw[a:b].split() if len(w) >= least_length])
                    codes = np.fromiter(map(crc32, found, repeat(crc32(f"{doc}:".encode()))), np.int64, len(found))
                    hit = np.flatnonzero(codes % slip_every == 0)
                    if len(hit):
                        words = list(found)
                        for k in hit.tolist():
                            total[_slipped(words[k], int(codes[k]))] += found.pop(words[k])
                    total.update(found)
                if len(total) > WORDS_HELD:
                    yield sent()
                    total.clear()
        yield sent()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    return rows.mapInArrow(task, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _one_edit(a: bytes, b: bytes) -> bool:
    """Whether one insertion or replacement makes ``a`` the word ``b``, which is as long or one longer."""
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :] and a != b


def near_places(words: list[bytes], block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of near words of one block; the words (one byte a code point) come sorted by block."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    letters = _ROW[np.frombuffer(b"".join(words), np.uint8)]
    # Products of counts are exact in single precision while squared lengths are.
    kind = np.float32 if length.max(initial=0) < 4096 else np.float64
    ends = np.concatenate([[0], np.cumsum(length)])

    def counts(lo: int) -> np.ndarray:
        hi = min(lo + TILE, len(words))
        row = np.repeat(np.arange(hi - lo), length[lo:hi])
        return np.bincount(row * _ROWS + letters[ends[lo] : ends[hi]], minlength=(hi - lo) * _ROWS).reshape(-1, _ROWS).astype(kind)

    out: list[tuple[np.ndarray, np.ndarray]] = []
    for lo in range(0, len(words), TILE):
        left, hi = counts(lo), min(lo + TILE, len(words))
        for other in range(lo, len(words), TILE):
            end = min(other + TILE, len(words))
            if block[other] > block[hi - 1]:
                break
            right = left if other == lo else counts(other)
            square = (left * left).sum(1)[:, None] + (right * right).sum(1)[None, :] - 2 * (left @ right.T)
            kept = (square <= 2) & (square >= 1) & (block[lo:hi, None] == block[None, other:end])
            kept &= np.abs(length[lo:hi, None] - length[None, other:end]) <= 1
            a, b = np.nonzero(kept)
            a, b = a + lo, b + other
            ahead = a < b
            out.append((a[ahead], b[ahead]))
    a, b = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2
    swap = length[a] > length[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    sure = np.fromiter((_one_edit(words[x], words[y]) for x, y in zip(a.tolist(), b.tolist())), bool, len(a))
    return a[sure], b[sure]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block; whole blocks are gathered up to some size."""
    held: list[tuple[np.ndarray, list[str], np.ndarray]] = []

    def pairs(block: np.ndarray, words: list[str], n: np.ndarray) -> pa.RecordBatch:
        a, b = near_places([w.encode("latin-1") for w in words], block)
        names, a, b = pa.array(words, pa.string()), np.concatenate([a, b]), np.concatenate([b, a])
        return pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b)), pa.array(n[b])], names=["word", "near", "n_near"])

    size = 0
    for batch in batches:
        held.append((batch.column("block").to_numpy(), batch.column("word").to_pylist(), batch.column("n").to_numpy()))
        size += len(batch)
        if size >= 1 << 14:
            block, n = (np.concatenate([h[k] for h in held]) for k in (0, 2))
            words = [w for h in held for w in h[1]]
            cut = int(np.searchsorted(block, block[-1]))  # the last block may go on
            if cut:
                yield pairs(block[:cut], words[:cut], n[:cut])
            held, size = [(block[cut:], words[cut:], n[cut:])], len(words) - cut
    if size:
        block, n = (np.concatenate([h[k] for h in held]) for k in (0, 2))
        yield pairs(block, [w for h in held for w in h[1]], n)


def _divided(rows: DataFrame) -> DataFrame:
    """Each word dealt to two blocks, by the first or the last half of the ``m - head - tail`` code points that the
    shorter words of its block do not share yet."""
    half = "(m - head - tail) div 2"
    first = rows.select(F.xxhash64("block", F.lit(0), F.expr(f"substring(word, head + 1, {half})")).alias("block"), "m", F.expr(f"head + {half}").alias("head"), "tail", "word", "n")
    rest = f"m - head - tail - {half}"
    last = rows.select(F.xxhash64("block", F.lit(1), F.expr(f"substring(word, char_length(word) - tail - ({rest}) + 1, {rest})")).alias("block"), "m", "head", F.expr(f"tail + {rest}").alias("tail"), "word", "n")
    return first.unionByName(last)


def near_pairs(words: DataFrame, block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """word, near and n_near (the occurrences of ``near``) of all near words, in both directions. ``words``: word, n, distinct."""
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    length = F.char_length("word")
    least = words.agg(F.coalesce(F.min(length), F.lit(0))).first()[0]
    # A word is among the shorter or the longer ones of a block.
    rows = words.withColumn("m", F.explode(F.array(length, length - 1))).where(F.col("m") >= least)
    rows = rows.select(F.xxhash64("m").alias("block"), "m", F.lit(0).alias("head"), F.lit(0).alias("tail"), "word", "n")
    found = None
    while True:
        rows = saved(_divided(rows), "blocks")
        hot = rows.where("m - head - tail > 1").groupBy("block").agg(F.count("*").alias("rows")).where(F.col("rows") > block_limit).select("block")
        hot = saved(hot, "hot")
        more = not hot.isEmpty()
        ready = rows.join(hot, "block", "left_anti") if more else rows
        near = ready.select("block", "word", "n").repartition(n, "block").sortWithinPartitions("block").mapInArrow(_near, "word string, near string, n_near long")
        found = near if found is None else found.unionByName(near)
        if not more:
            return found.distinct()
        rows = rows.join(hot, "block", "left_semi")


def _rooted(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last of its forms, of each word with a form."""
    roots = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = saved(roots.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return roots


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip_every: int = SLIP_EVERY, form_ratio: int = FORM_RATIO, block_limit: int = BLOCK_LIMIT) -> DataFrame:
    """word, n, n_near, form, form_n and root of each word."""
    prepare(docs.sparkSession)
    words = saved(word_counts(docs, least_length, slip_every).where(F.col("n") >= least_count), "words")
    pairs = near_pairs(words, block_limit)
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_near")).alias("down"), F.col("near").alias("form"))).alias("best"))
    known = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(-F.col("best.down") >= form_ratio * F.col("n"), F.col("best")).alias("best"))
    known = saved(known.select("word", "n", "n_near", "best.form", (-F.col("best.down")).alias("form_n")), "forms")
    roots = _rooted(known.where("form is not null"))
    return known.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
