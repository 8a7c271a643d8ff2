"""N-gram Jaccard join: blocked sparse products of a document by n-gram incidence matrix.

A document's set holds its distinct word shingles. Two documents link when their sets' Jaccard similarity is at
least ``percent`` hundredths; the result names the connected component of each document.

**Row blocks.** Multiplying the whole matrix by its transpose would meet every pair that shares a common phrase.
Sizes rule most of that out: of two sets of the same or adjacent size class that link, the greater size is at
most 100/percent of the lesser, so they differ in at most ``d`` shingles, a number that follows from the class.
Shingles are dealt by their hashes to ``d + 1`` parts; at least one part is then equal in both. So each set
signs its parts, once for its own class and once for the class below, and sets with a common signature are
candidates. The candidates' components, found by star rounds, are the matrix's row blocks: no link leaves one.

**Products.** Only sets that have a candidate are built again. A block is cut into chunks of bounded size, and
the block's least set goes into each chunk. A task multiplies a chunk by its transpose, column block by column
block: it adds up the overlap counts, drops the pairs that can no longer reach the overlap that their sizes
demand, and drops the rows that are left without a pair. Of a block with several chunks, the sets outside its
largest component so far meet the other chunks too; two sets inside it are linked already. (With ``count_links``
all chunks meet, because then every pair counts.)

Shingles are compared by 64-bit hashes, sets by 128 bits. Copies of a text or of a set are one row of the matrix.

Defined cases: a null, empty or blank text has an empty set (0 shingles) and is its own component. A text with
fewer words than a shingle is one shingle. Very long texts only make longer rows. Repeated rows share a set and a
component. A component's id is its least doc_id; null ids are passed over unless all of the component are null;
an empty set's component is its own doc_id. An empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonora.llm import words as W
from sonora.llm.components import components
from sonora.llm.hashing import ODD, mixed, rolled
from sonora.llm.shared import attached, prepare, saved, table

SHINGLE_WORDS, PERCENT = 3, 90
#: A chunk holds about so many sets, and about so many shingles, at most.
CHUNK_SETS, CHUNK_SHINGLES = 1024, 1 << 19
COLUMNS = 1024
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """The place of each text and the sorted hashes of its distinct shingles."""
    for first, data, offsets in W.slices(texts):
        words, ends = W.split_words(np.frombuffer(data.tobytes().translate(_LOWER), np.uint8), offsets)
        names = W.Vocabulary()
        ids = names.ids(words)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, names), np.uint64, len(names))[ids] if len(ids) else np.zeros(0, np.uint64)
        grams = rolled(h, max(0, len(h) - width + 1), width, ODD[0])
        for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            if b - a >= width:
                yield first + k, np.unique(grams[a : b - width + 1])
            else:
                yield first + k, rolled(h[a:b], min(1, b - a), b - a, ODD[b - a])


class SizeClasses:
    """Sizes in classes such that sets of linked sizes lie in the same or in adjacent classes."""

    def __init__(self, percent: int) -> None:
        self.percent, self.starts = percent, [1]

    def of(self, size: int) -> int:
        while self.starts[-1] <= size or len(self.starts) < 2:
            self.starts.append(max(self.starts[-1] + 1, self.starts[-1] * 100 // self.percent + 1))
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def parts(self, kind: int) -> int:
        """One more than the shingles in which a set of this class can differ from a linked one of this or the next class."""
        most = self.starts[kind + 1] - 1
        # |A| + |B| - 2 |A and B| is at most (|A| + |B|) (100 - p) / (100 + p), and |B| at most 100 |A| / p.
        return most * (100 - self.percent) // self.percent + 1

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        """A hash of each part, for the set's own class and the one below."""
        own, out = self.of(len(shingles)), []
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(shingles ^ ODD[1]), dtype=np.uint64)])
        for kind in {own, max(own - 1, 0)}:
            n = np.uint64(self.parts(kind))
            edges = np.searchsorted((shingles >> np.uint64(32)) * n >> np.uint64(32), np.arange(int(n) + 1, dtype=np.uint64))
            name = mixed(np.arange(int(n), dtype=np.uint64) + (np.uint64(kind + 1) << np.uint64(40)))
            out.append(mixed((total[edges[1:]] - total[edges[:-1]]) ^ name))
        return np.concatenate(out)


def _signed(width: int, percent: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = SizeClasses(percent)
        for batch in batches:
            n, k1, k2, ends, signs = [], [], [], [0], [np.zeros(0, np.uint64)]
            for _, found in _shingle_sets(batch.column("text"), width):
                key = xxhash.xxh3_128_intdigest(found.tobytes())
                n.append(len(found))
                k1.append(key >> 64)
                k2.append(key & 0xFFFFFFFFFFFFFFFF)
                if len(found):
                    signs.append(classes.signatures(found))
                ends.append(ends[-1] + (len(signs[-1]) if len(found) else 0))
            keys = [pa.array(np.array(k, np.uint64).view(np.int64)) for k in (k1, k2)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(signs).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "t1", "t2")), pa.array(n, pa.int64()), *keys, lists], names=["doc_id", "t1", "t2", "n", "k1", "k2", "signs"])

    return task


def _rebuilt(width: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, found in _shingle_sets(batch.column("text"), width):
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, 1) for c in ("block", "id", "n")), pa.array([found.tobytes()], pa.binary())], names=["block", "id", "n", "shingles"])

    return task


def _least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of sets of sizes ``a`` and ``b`` that link."""
    return -(-percent * (a + b) // (100 + percent))


def linked_pairs(sets: list[np.ndarray], side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b), a before b, of linked sets of two sides; where all are of side 0, of all linked sets."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    two = side.any()
    live = np.arange(len(sets))
    small, great = np.minimum.outer(size, size), np.maximum.outer(size, size)
    pairs = 100 * small >= percent * great
    pairs &= (side[:, None] != side[None, :]) if two else ~np.eye(len(sets), dtype=bool)
    columns, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(live, size)
    shared = times[column] > 1  # an n-gram of one set adds to no overlap
    number = np.cumsum(times > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    n_columns = int((times > 1).sum())
    kind = np.float32 if size.max(initial=0) < 1 << 24 else np.float64
    need = _least_overlap(size[:, None], size[None, :], percent)
    overlap = np.zeros((len(sets), len(sets)), kind)
    rest = np.bincount(row, minlength=len(sets))
    for start in range(0, n_columns + 1, COLUMNS):
        # Pairs that the columns to come cannot lift to the overlap they need are dropped, and rows without a pair.
        pairs &= overlap + np.minimum.outer(rest, rest)[np.ix_(live, live)] >= need
        keep = pairs.any(1)
        if not keep.all():
            live, at = live[keep], np.ix_(keep, keep)
            pairs, overlap, need = pairs[at], overlap[at], need[at]
        if not len(live) or start == n_columns:
            break
        a, b = np.searchsorted(column, (start, start + COLUMNS))
        place = np.full(len(sets), -1)
        place[live] = np.arange(len(live))
        inside = place[row[a:b]]
        block = np.zeros((len(live), COLUMNS), kind)
        block[inside[inside >= 0], column[a:b][inside >= 0] - start] = 1
        overlap += block @ block.T
        rest = rest - np.bincount(row[a:b], minlength=len(sets))
    a, b = np.nonzero(pairs & (overlap >= need)) if len(live) else (np.zeros(0, np.int64),) * 2
    return live[a[a < b]], live[b[a < b]]


def _multiplied(percent: int, count_links: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tile. Of each tile, stars of linked sets (a, b), or each set's links (a, their number)."""
        tile, held = None, []

        def product() -> Iterator[pa.RecordBatch]:
            if len(held) < 2:
                return
            ids, copies = (np.array([h[k] for h in held], np.int64) for k in (0, 1))
            side = np.array([h[2] for h in held], np.int8)
            a, b = linked_pairs([np.frombuffer(h[3], np.uint64) for h in held], side, percent)
            if count_links:
                n = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
                out = ids, n.astype(np.int64)
            else:
                root = np.arange(len(ids))
                while (root[a] != root[b]).any():
                    low = np.minimum(root[a], root[b])
                    np.minimum.at(root, root[a], low)
                    np.minimum.at(root, root[b], low)
                    root = root[root]
                out = ids, ids[root]
            apart = out[1] != (0 if count_links else ids)
            yield pa.RecordBatch.from_pydict({"a": out[0][apart], "b": out[1][apart]})

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("tile", "id", "copies", "side", "shingles")]
            for g, *row in zip(*columns):
                if g != tile:
                    yield from product()
                    tile, held = g, []
                held.append(row)
        yield from product()

    return task


def _tiled(rows: DataFrame, percent: int, count_links: bool) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("tile", "id", "copies", "side", "shingles")
    return rows.repartition(n, "tile").sortWithinPartitions("tile").mapInArrow(_multiplied(percent, count_links), "a long, b long")


def _chunks(sets: str = "sets", shingles: str = "shingles"):
    return F.greatest(F.ceil(F.col(sets) / CHUNK_SETS), F.ceil(F.col(shingles) / CHUNK_SHINGLES))


def _within(sets: DataFrame, percent: int) -> DataFrame:
    """Stars of the links within each chunk; the block's least set is in each of its chunks."""
    least = sets.where("least and chunks > 1").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    least = least.where("other != chunk").withColumn("chunk", F.col("other")).drop("other")
    rows = sets.unionByName(least).select(F.xxhash64("block", "chunk").alias("tile"), "id", "copies", F.lit(0).cast("byte").alias("side"), "shingles")
    return _tiled(rows, percent, False)


def _across(sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Stars of the links between the sets outside a block's largest component and the block's other chunks."""
    parted = sets.where("chunks > 1")
    rooted = parted.select("block", "id", "n").join(components(found).withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    rooted = saved(rooted, "rooted")
    largest = rooted.groupBy("block", "root").agg(F.count("*").alias("m")).groupBy("block").agg(F.max(F.struct("m", "root"))["root"].alias("largest"))
    outside = rooted.join(largest, "block").where("root != largest")
    groups = outside.groupBy("block").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles")).select("block", _chunks().alias("groups"))
    groups = saved(groups, "groups")
    left = parted.join(outside.select("id"), "id", "left_semi").join(groups, "block")
    left = left.withColumn("group", F.pmod(F.xxhash64("id", F.lit(1)), "groups")).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    right = parted.join(groups, "block").withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    sides = [df.select(F.xxhash64("block", "group", "chunk").alias("tile"), "id", "copies", F.lit(k).cast("byte").alias("side"), "shingles") for k, df in enumerate((left, right))]
    return _tiled(sides[0].unionByName(sides[1]), percent, False)


def _counts(sets: DataFrame, percent: int) -> DataFrame:
    """Of each set, the documents that other sets' links give it; every pair of chunks of a block meets."""
    within = sets.select(F.xxhash64("block", "chunk").alias("tile"), "id", "copies", F.lit(0).cast("byte").alias("side"), "shingles")
    other = sets.where("chunks > 1").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).where("other != chunk")
    pair = F.xxhash64("block", F.least("chunk", "other"), F.greatest("chunk", "other"))
    across = other.select(pair.alias("tile"), "id", "copies", (F.col("chunk") > F.col("other")).cast("byte").alias("side"), "shingles")
    return _tiled(within.unionByName(across), percent, True).groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("links"))


def jaccard_join(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT, count_links: bool = False) -> DataFrame:
    """doc_id, n_shingles and component_id of each document; with ``count_links`` also ``n_links``, the other documents it links to."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text").withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})
    rows = saved(docs.mapInArrow(_signed(shingle_words, percent), "doc_id long, t1 long, t2 long, n long, k1 long, k2 long, signs array<long>"), "signed")

    # Candidates: sets that share a signature, as stars around the least of them (by the first half of their names).
    signs = rows.select("k1", F.explode("signs").alias("sign"))
    met = signs.groupBy("sign").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low != high").select("sign", "low")
    stars = signs.join(saved(met, "met"), "sign").select(F.col("k1").alias("a"), F.col("low").alias("b"))
    blocks = components(stars)
    blocks = saved(blocks.select(F.col("node").alias("k1"), F.col("root").alias("block")).unionByName(blocks.select(F.col("root").alias("k1"), F.col("root").alias("block"))).distinct(), "blocks")

    # One text of each set that has a candidate, and the set again.
    distinct = rows.where("n > 0").groupBy("k1", "k2").agg(*(F.first(c).alias(c) for c in ("t1", "t2", "n")), F.count("*").alias("copies"), F.min("doc_id").alias("least_id"))
    distinct = saved(distinct, "distinct")
    named = distinct.join(blocks, "k1").withColumn("id", F.monotonically_increasing_id())
    named = saved(named, "named")
    texts = docs.select("t1", "t2", "text").dropDuplicates(["t1", "t2"]).join(named.select("t1", "t2", "block", "id", "n"), ["t1", "t2"])
    built = texts.select("block", "id", "n", "text").mapInArrow(_rebuilt(shingle_words), "block long, id long, n long, shingles binary")
    cuts = named.groupBy("block").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles")).select("block", _chunks().alias("chunks"))
    cuts = named.select("id", "block", "copies", (F.col("k1") == F.col("block")).alias("least")).join(cuts, "block")
    sets = built.join(cuts.drop("block"), "id").withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks"))
    sets = saved(sets, "sets")

    links = saved(_within(sets, percent), "links")
    if not sets.where("chunks > 1").isEmpty():
        links = saved(links.unionByName(_across(sets, links, percent)), "links")
    known = named.join(components(links).select(F.col("node").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    known = known.join(known.groupBy("root").agg(F.min("least_id").alias("component_id")), "root")
    if count_links:
        known = known.join(_counts(sets, percent), "id", "left")
    alone = distinct.join(blocks, "k1", "left_anti").withColumn("component_id", F.col("least_id"))
    found = saved(known.unionByName(alone, allowMissingColumns=True).select("k1", "k2", "copies", "component_id", *(["links"] if count_links else [])), "found")
    if count_links:
        found = found.select("k1", "k2", "copies", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = attached(rows.where("n > 0").select("doc_id", "n", "k1", "k2"), found, ["k1", "k2"])
    empty = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    names = ["doc_id", F.col("n").alias("n_shingles"), "component_id", *(["n_links"] if count_links else [])]
    return out.select(*names).unionByName(empty.select(*names))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
