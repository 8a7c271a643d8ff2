"""Mixing sources to target weights by Sainte-Laguë apportionment, taken in equal-token blocks.

Sources, by code point and null last, weigh 3, 1, 2, repeating, and share ``budget`` times all words; a
target stops at ``most_copies`` times its source's words, and the excess is shared anew by weight among the
others. Each source's documents are dealt by a seeded hash into shards and laid end to end there in seeded
order; blocks are runs of ``block_words`` words of that order, in every source. A source's quota is its target
to the word. Highest quotients deal the quota's whole blocks to the source's shards by their words; what is left
is a part of one more block, in one shard (in several where shards are
full); the other shards' quotas are whole blocks, or their most. A shard takes all its words ``quota div
words`` times, and the rest of its quota once more in blocks by systematic selection from a seeded start, so
that how many words of a document are taken follows from two prefix sums, without listing blocks.

A rest is as many blocks as hold it, and what they hold beyond it is cut off their end (only there where a
shard is taken more than once or has its source's cut); no source changes how another's documents are cut.
A very long document spans many blocks of one shard; no task holds more than a batch of texts.

Defined cases: a null text has no words; a document without words is taken 0 times. Repeated rows are taken
each on its own. A null source is a source, last; a null doc_id is dealt like a value. If no document has
words all targets are 0. An empty table gives an empty result; extra columns pass through or are ignored.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonora.llm import words as W
from sonora.llm.shared import prepare, row_keys, saved, table

WEIGHTS, BUDGET, MOST_COPIES = (3.0, 1.0, 2.0), 1.5, 2
BLOCK_WORDS, SHARD_BLOCKS, MOST_SHARDS, SEED = 64, 256, 4096, 5


def word_count(text: Column) -> Column:
    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array(W.count_words(texts))

    return count(text)


def sainte_lague(weights: np.ndarray, seats: int, caps: np.ndarray) -> np.ndarray:
    """Seats by highest quotients weight / (2 k + 1), none above its cap; equal quotients go to the earlier party."""
    weights, caps = np.asarray(weights, float), np.asarray(caps, np.int64)
    seats = int(min(seats, caps[weights > 0].sum()))
    won = lambda level: np.minimum(caps, np.floor(weights / level / 2 + 0.5)).astype(np.int64)  # noqa: E731  quotients of at least `level`
    if seats <= 0:
        return np.zeros(len(weights), np.int64)
    low, high = 0.0, float(weights.max()) * 2
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (low, mid) if won(mid).sum() <= seats else (mid, high)
    got = won(high)
    while (rest := seats - int(got.sum())) > 0:  # quotients between the two last levels: ties
        open_ = np.flatnonzero((got < caps) & (weights > 0))
        best = open_[np.argsort(-weights[open_] / (2 * got[open_] + 1), kind="stable")][:rest]
        got[best] += 1
    return got


def fitted(quota: np.ndarray, words: int, caps: np.ndarray) -> np.ndarray:
    """The quotas brought to a sum of ``words``, the last parties giving or taking first, none below 0 or above its cap."""
    quota, caps = quota[::-1], caps[::-1]
    more = words - int(quota.sum())
    open_ = caps - quota if more > 0 else quota
    change = np.clip(abs(more) - (np.cumsum(open_) - open_), 0, open_)
    return (quota + np.sign(more) * change)[::-1]


def in_blocks(weights: np.ndarray, words: int, caps: np.ndarray, block: int) -> np.ndarray:
    """Quotas of ``words`` words in all: whole blocks by highest quotients, one of them cut or a part of one more."""
    caps = np.asarray(caps, np.int64)
    return fitted(np.minimum(sainte_lague(weights, words // block, -(-caps // block)) * block, caps), words, caps)


def targets(sources: pd.DataFrame, budget: float, most_copies: int, weights: tuple[float, ...]) -> pd.Series:
    """Words to take from each source. ``sources``: size, in the sources' order."""
    size = sources["size"].to_numpy(float)
    weight = np.resize(np.array(weights, float), len(size))
    out, open_ = np.zeros(len(size)), np.ones(len(size), bool)
    left = budget * size.sum()
    while open_.any():
        share = left * weight / weight[open_].sum()
        full = open_ & (share > most_copies * size)
        if not full.any():
            out[open_] = share[open_]
            break
        out[full] = most_copies * size[full]
        left = max(0.0, budget * size.sum() - out[~(open_ & ~full)].sum())
        open_ &= ~full
    return pd.Series(out, sources.index)


def plan_sources(sources: pd.DataFrame, budget=BUDGET, most_copies=MOST_COPIES, weights=WEIGHTS, block_words=BLOCK_WORDS) -> pd.DataFrame:
    """Targets, shards and quota of words of each source; one row for each source in and out."""
    sources = sources.iloc[sorted(range(len(sources)), key=lambda k: (sources["source"][k] is None, sources["source"][k] or ""))].reset_index(drop=True)
    sources["target"] = targets(sources, budget, most_copies, weights)
    sizes = sources["size"].to_numpy(np.int64)
    sources["shards"] = np.clip(sizes // (block_words * SHARD_BLOCKS), 1, MOST_SHARDS)
    # To the word: dealing whole blocks among sources and then cutting each source's last one would end at the same number.
    sources["quota"] = np.clip(np.rint(sources["target"].to_numpy()).astype(np.int64), 0, most_copies * sizes)
    return sources


def _once_more(x, block, blocks, extra, start):
    """Words of a shard's first ``x`` words that lie in the blocks of :data:`_ONCE_MORE`."""
    before, after = ((x // block + start + k) * extra // blocks - start * extra // blocks for k in (0, 1))
    return before * block + (after - before) * (x % block)


def _shard_quotas(most_copies: int, block: int):
    def quotas(group: pd.DataFrame) -> pd.DataFrame:
        """Of one source's shards, MOST_SHARDS at most."""
        group = group.sort_values("shard", ignore_index=True)
        words = group["words"].to_numpy(np.int64)
        quota = in_blocks(words, int(group["quota"].iloc[0]), most_copies * words, block)
        blocks = np.maximum(1, -(-words // block))
        group["blocks"], group["start"] = blocks, group["seeded"].to_numpy(np.int64) % blocks
        group["copies"], group["once"] = quota // np.maximum(1, words), quota % np.maximum(1, words)
        extra = -(-group["once"].to_numpy() // block)
        # One block more where the shard's short last block is among the selected and they hold too little.
        extra += _once_more(words, block, blocks, extra, group["start"].to_numpy()) < group["once"].to_numpy()
        group["extra"] = extra
        return group[["number", "shard", "blocks", "start", "copies", "extra", "once"]]

    return quotas


def placed(docs: DataFrame, budget: float = BUDGET, most_copies: int = MOST_COPIES, weights: tuple[float, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, row keys, size, source_size, target, and where each document lies in the blocks of its shard."""
    spark = prepare(docs.sparkSession)
    sized = docs.select("doc_id", "source", *(c.alias(n) for n, c in row_keys(docs, seed).items()), word_count(F.col("text")).alias("size"))
    sized = saved(sized, "sizes")
    # One row for each source: as few as the sources that a mix names weights for.
    found = [(r["source"], r["size"]) for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    plan = plan_sources(pd.DataFrame(found, columns=["source", "size"]), budget, most_copies, weights, block_words)
    kinds = "number int, source string, source_size long, target double, shards long, quota long"
    sources = spark.createDataFrame([(k, s if isinstance(s, str) else None, *(x.item() for x in rest)) for k, (s, *rest) in enumerate(zip(plan["source"], *(plan[c].to_numpy() for c in ("size", "target", "shards", "quota"))))], kinds)
    rows = sized.alias("d").join(F.broadcast(sources.alias("s")), F.expr("d.source <=> s.source")).select("d.doc_id", "d.row_key1", "d.row_key2", "d.size", "s.number", *(f"s.{c}" for c in ("source_size", "target", "shards", "quota")), F.lit(block_words).cast("long").alias("block"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "row_key1"), "shards"))
    shards = rows.groupBy("number", "shard", "quota").agg(F.sum("size").alias("words")).withColumn("seeded", F.xxhash64(F.lit(seed), "number", "shard"))
    quotas = shards.groupBy("number").applyInPandas(_shard_quotas(most_copies, block_words), "number int, shard long, blocks long, start long, copies long, extra long, once long")
    before = Window.partitionBy("number", "shard").orderBy("row_key1", "row_key2", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return rows.join(quotas, ["number", "shard"])


#: Words of a shard's first `x` words that lie in blocks taken once more: block j is taken if
#: (j + start + 1) * extra div blocks exceeds (j + start) * extra div blocks. Of these words the first `once` count.
_ONCE_MORE = """least(once, (((({x}) div block + start) * extra) div blocks - (start * extra) div blocks) * block
    + (((({x}) div block + start + 1) * extra) div blocks - ((({x}) div block + start) * extra) div blocks) * (({x}) % block))"""


def taken(rows: DataFrame) -> DataFrame:
    """The words taken of each document: whole copies, and those in blocks taken once more."""
    return rows.withColumn("taken", F.expr(f"copies * size + {_ONCE_MORE.format(x='at + size')} - {_ONCE_MORE.format(x='at')}"))


def mix(docs: DataFrame, **params) -> DataFrame:
    """doc_id, size, source_size, target and taken of each document."""
    return taken(placed(docs, **params)).select("doc_id", "size", "source_size", "target", "taken")


#: What :func:`_copies` takes after a document's place and size.
PLACE = ("block", "blocks", "take", "start", "extra", "once")


def _copies(text: str, at: int, size: int, block: int, blocks: int, take: int, start: int, extra: int | None = None, once: int | None = None) -> list[str]:
    """A document's whole copies, and the words of its blocks that are taken once more.

    ``take`` counts blocks, ``extra`` of them taken once more (the rest of whole copies where not given), of
    whose words the first ``once`` in the shard count (all where not given).
    """
    if not size:
        return []
    extra = take % blocks if extra is None else extra
    out = [text] * ((take - extra) // blocks)
    if extra:
        j = np.arange(at // block, (at + size - 1) // block + 1)
        chosen = j[(j + start + 1) * extra // blocks > (j + start) * extra // blocks]
        left = size if once is None else max(0, once - _once_more(at, block, blocks, extra, start))
        if len(chosen) == len(j) and left >= size:
            out.append(text)
        elif len(chosen) and left:
            words = text.encode().split()
            part = [w for k in chosen.tolist() for w in words[max(0, k * block - at) : (k + 1) * block - at]]
            out.append(b" ".join(part[:left]).decode())
    return out


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each whole copy taken and one for a partial copy's blocks.

    A whole copy keeps its text as it is; a partial copy is the words of its blocks, joined by one space.
    """
    names = docs.columns
    places = placed(docs, **params).withColumn("take", F.expr("copies * blocks + extra")).where("size > 0 and take > 0").select("row_key1", "row_key2", "at", "size", *PLACE)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names if c != "text")).alias("row"), "text", *(c.alias(n) for n, c in row_keys(docs, params.get("seed", SEED)).items()))
    # Equal rows stand for each other: one of them meets the places of all.
    one = rows.withColumn("copy", F.row_number().over(Window.partitionBy("row_key1", "row_key2").orderBy(F.lit(1)))).where("copy = 1").drop("copy")

    @F.arrow_udf("array<string>")
    def copies(texts: pa.Array, *place: pa.Array) -> pa.Array:
        place = zip(*(p.to_pylist() for p in place))
        return pa.array([_copies(t.as_py(), *p) for t, p in zip(texts, place)], pa.list_(pa.string()))

    cut = copies("text", "at", "size", *PLACE)
    cut = one.join(places, ["row_key1", "row_key2"]).select("row", F.explode(cut).alias("text"))
    return cut.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
