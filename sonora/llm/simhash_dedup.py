"""SimHash near-dedup: fingerprints linked by a Gray-order hierarchical index.

Fingerprints are 64-bit SimHashes of word shingles. Equal fingerprints are merged first. Two fingerprints
that differ in at most ``max_bits`` bits agree in one of ``max_bits + 1`` blocks of bits, so each is dealt
to one group for each block; a group larger than ``group_limit`` is dealt again by blocks of its remaining
bits, which divides hot groups and loses no pair. After the last division a group has at most
``2 ** (free bits)`` fingerprints whatever the input.

Within a task the rows are sorted by group and Gray rank. Upper nodes hold the bits that all fingerprints
below them share (a mask and a pattern); the differences of two nodes' shared bits accumulate on the way
down, and a pair of nodes that differs in more than ``max_bits`` bits is pruned with all below it. Pairs of
leaves that remain are links; each task reduces them to stars, and star rounds join the tasks' results.

Defined cases: a null or empty text has fingerprint zero, linked like any other; fewer words than a shingle
are one shingle. Repeated rows share a fingerprint and a component. A component's id is its least doc_id;
null ids are passed over unless all are null. An empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonora.llm import words as W
from sonora.llm.components import components
from sonora.llm.shared import prepare, row_keys, saved, table

SHINGLE_WORDS, MAX_BITS, SEED, BITS = 3, 3, 42, 64
GROUP_LIMIT, FANOUT, FRONTIER = 2048, 8, 1 << 19
#: Divisions of a group by blocks of its free bits; with four blocks each, 64 free bits become 48, 36, 27 and 20.
MOST_DIVISIONS = 4
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _fingerprints(texts: pa.Array, shingle_words: int) -> np.ndarray:
    import xxhash

    digest, out = xxhash.xxh64_intdigest, np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    for first, data, offsets in W.slices(texts):
        raw = data.tobytes().translate(_LOWER)
        for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            words = raw[a:b].split()
            if not words:
                continue
            joined = b" ".join(words)
            n = max(1, len(words) - shingle_words + 1)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
            ends = ends[min(shingle_words, len(words)) - 1 :].tolist()
            ones = np.zeros(BITS, np.int64)
            for lo in range(0, n, 1 << 15):  # a long text's shingles, some at a time
                h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[lo : lo + (1 << 15)], ends[lo : lo + (1 << 15)])], "<u8")
                bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(0, dtype=np.int32)
            out[first + k] = weights[2 * ones > n].sum(dtype=np.uint64)
    return out


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The SimHash of each text as a signed 64-bit number."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array(_fingerprints(texts, shingle_words).view(np.int64))

    return simhash(text)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each number in the reflected Gray code."""
    x = x.copy()
    for k in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(k)
    return x


class GrayIndex:
    """A hierarchy over fingerprints sorted by group and Gray rank; each level's node covers FANOUT nodes of the level below."""

    def __init__(self, group: np.ndarray, prints: np.ndarray) -> None:
        self.levels = [(group, group, np.full(len(prints), np.uint64(0xFFFFFFFFFFFFFFFF)), prints)]
        while len(self.levels[-1][0]) > FANOUT:
            low, high, mask, pattern = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            union = np.bitwise_or.reduceat(pattern, at)
            common = np.bitwise_and.reduceat(pattern, at)
            mask = np.bitwise_and.reduceat(mask, at) & ~(union ^ common)
            self.levels.append((low[at], np.maximum.reduceat(high, at), mask, common & mask))

    def links(self, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places, the first before the second, of one group and within ``max_bits`` bits."""
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        a, b = np.triu_indices(n)
        stack = [(top, a, b)]
        while stack:
            level, a, b = stack.pop()
            low, high, mask, pattern = self.levels[level]
            near = (low[b] <= high[a]) & (low[a] <= high[b])
            a, b = a[near], b[near]
            near = np.bitwise_count((pattern[a] ^ pattern[b]) & mask[a] & mask[b]) <= max_bits
            a, b = a[near], b[near]
            if not len(a):
                continue
            if level == 0:
                yield a[a < b], b[a < b]
                continue
            below, step = len(self.levels[level - 1][0]), FRONTIER // (FANOUT * FANOUT)
            i, j = np.divmod(np.arange(FANOUT * FANOUT), FANOUT)
            for lo in range(0, len(a), step):
                x = (a[lo : lo + step, None] * FANOUT + i).ravel()
                y = (b[lo : lo + step, None] * FANOUT + j).ravel()
                fits = (x < below) & (y < below) & (x <= y)
                stack.append((level - 1, x[fits], y[fits]))


class _Forest:
    """Union-find over places, by vectorised hooking of the greater root to the lesser."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while (up := self.root[self.root], (up != self.root).any())[1]:
                self.root = up


def _stars(max_bits: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; whole groups are gathered up to some size, then linked together."""
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def link(groups: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(prints) < 2:
                return
            order = np.lexsort((gray_rank(prints), groups))
            groups, prints = groups[order], prints[order]
            forest = _Forest(len(prints))
            for a, b in GrayIndex(groups, prints).links(max_bits):
                forest.join(a, b)
            far = np.flatnonzero(forest.root != np.arange(len(prints)))
            if len(far):
                yield pa.RecordBatch.from_pydict({"a": prints[far].view(np.int64), "b": prints[forest.root[far]].view(np.int64)})

        size = 0
        for batch in batches:
            held.append((batch.column("group").to_numpy(), batch.column("print").to_numpy().view(np.uint64)))
            size += len(batch)
            if size >= 1 << 16:
                groups, prints = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(groups, groups[-1]))  # the last group may go on
                yield from link(groups[:cut], prints[:cut])
                held, size = [(groups[cut:], prints[cut:])], len(groups) - cut
        if held:
            yield from link(*(np.concatenate(x) for x in zip(*held)))

    return task


def _divide(rows: DataFrame, max_bits: int) -> DataFrame:
    """Each (group, free, print) dealt to a new group for each block of its free bits; ``free`` lists the bits not yet fixed."""
    blocks = max_bits + 1
    rows = rows.select("group", "free", "print", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    edge = f"cast((block + {{}}) * size(free) div {blocks} as int)"
    rows = rows.withColumn("fixed", F.expr(f"slice(free, {edge.format(0)} + 1, {edge.format(1)} - {edge.format(0)})"))
    value = F.aggregate("fixed", F.lit(0).cast("long"), lambda v, k: v.bitwiseOR(F.col("print").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), k))))
    return rows.select(F.xxhash64("group", "block", value).alias("group"), F.array_except("free", "fixed").alias("free"), "print")


def links(prints: DataFrame, max_bits: int = MAX_BITS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column ``print``) within ``max_bits`` bits.

    Two groups whose hashed names collide are searched as one, which can only add pairs that are checked as well.
    """
    spark = prints.sparkSession
    rows = _divide(prints.select(F.lit(0).cast("long").alias("group"), F.sequence(F.lit(0), F.lit(BITS - 1)).alias("free"), "print"), max_bits)
    found = None
    for division in range(1, MOST_DIVISIONS + 1):
        if division < MOST_DIVISIONS:
            rows = saved(rows, "groups")
            hot = saved(rows.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > group_limit).select("group"), "hot")
            more = not hot.isEmpty()
            ready = rows.join(hot, "group", "left_anti") if more else rows
        else:
            ready, more = rows, False
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
        near = ready.select("group", "print").repartition(n, "group").sortWithinPartitions("group").mapInArrow(_stars(max_bits), "a long, b long")
        found = near if found is None else found.unionByName(near)
        if not more:
            return found
        rows = _divide(rows.join(hot, "group", "left_semi"), max_bits)
    return found


def linked(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``prints`` (any columns, a ``print``) with ``root``: one fingerprint of the component."""
    distinct = saved(prints.select("print").distinct(), "prints")
    roots = components(links(distinct, max_bits)).select(F.col("node").alias("print"), "root")
    return prints.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))


def simhash_dedup(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (hexadecimal) and component_id of each document."""
    prepare(docs.sparkSession)
    prints = saved(docs.select("doc_id", fingerprint(F.col("text"), shingle_words).alias("print")), "fingerprints")
    rows = linked(prints, max_bits)
    ids = saved(rows.groupBy("root").agg(F.min("doc_id").alias("component_id")), "ids")
    return rows.join(ids, "root").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: that of the least doc_id (then of the least row hash); the columns of ``docs``."""
    prepare(docs.sparkSession)
    names = docs.columns
    keys = row_keys(docs, SEED)
    prints = docs.select(F.col("doc_id").alias("id"), *(c.alias(n) for n, c in keys.items()), fingerprint(F.col("text"), shingle_words).alias("print"))
    best = linked(saved(prints, "fingerprints"), max_bits).groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row_key1", "row_key2")).alias("best"))
    best = best.select("best.row_key1", "best.row_key2")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), *(c.alias(n) for n, c in keys.items())).join(best, ["row_key1", "row_key2"], "left_semi")
    first = rows.withColumn("copy", F.row_number().over(Window.partitionBy("row_key1", "row_key2").orderBy(F.lit(1)))).where("copy = 1")
    return first.select("row.*")


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))
