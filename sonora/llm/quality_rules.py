"""Quality rules: plain text rules, then a calibrated logistic regression on hashed n-grams.

Word 1- and 2-grams and character 2- and 3-grams are hashed into fixed blocks; a document's features
are its relative n-gram frequencies in each block. The regression is fitted on a bounded sample of
labelled rows (``sample_rows``), Platt-calibrated on a held-back quarter of that sample, and scored in
Arrow batches. A document is kept if it passes the base rules and its calibrated probability of being
good reaches the fixed ``least_probability``.

Defined cases: a null text has no words, so it fails the base rules; an empty text and one with fewer
than ``min_words`` words as well. Repeated rows are scored alike, each on its own. A label that is null,
or whose document is missing, is not learned; several labels of a document count as their mean, good
from 0.5. Without labels of both kinds the probability is the share of good labels (1.0 without any).
Extra columns of the input pass through; an empty table gives an empty result.
"""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonora.llm import words as W
from sonora.llm.shared import prepare, table

#: Hashed dimensions of a block; blocks are word 1-, word 2-, character 2-, character 3-grams.
BITS, BLOCKS = 13, 4
MIN_WORDS, MOST_REPEAT_PERCENT = 50, 50
SAMPLE_ROWS, LEAST_PROBABILITY, SEED = 3000, 0.5, 7
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MIX = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)]

BASE_TYPE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass
class Model:
    """Weights by block and hash, an intercept, and Platt's slope and shift."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin + self.bias) + self.shift, -500, 500)))


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    """A hash below 2**BITS of each n-gram, from its parts' numbers."""
    h = np.zeros(len(parts[0]), np.uint32)
    for x, m in zip(parts, _MIX):
        h = (h ^ (x * m)) * np.uint32(0x27D4EB2F)
        h ^= h >> np.uint32(15)
    return (h >> np.uint32(32 - BITS)).astype(np.int64)


def grams(data: np.ndarray, offsets: np.ndarray, words: list[bytes], ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each block: hashes of all n-grams of the slice, the first n-gram and the number of n-grams of each row."""
    names = W.Vocabulary()
    ids = names.ids(words)
    crc = np.fromiter(map(zlib.crc32, names), np.uint32, len(names))
    word = crc[ids] if len(ids) else np.zeros(0, np.uint32)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    out = []
    for seq, at, n in ((word, ends, 1), (word, ends, 2), (points, heads, 2), (points, heads, 3)):
        m = max(0, len(seq) - n + 1)
        out.append((_fold([seq[k : k + m] for k in range(n)]), at[:-1], np.maximum(0, np.diff(at) - n + 1)))
    return out


def base_counts(data: np.ndarray, offsets: np.ndarray, words: list[bytes], ends: np.ndarray) -> dict[str, np.ndarray]:
    """The base figures of each row of a slice."""
    names = W.Vocabulary()
    ids = names.ids(words)
    raw, n = data.tobytes(), len(offsets) - 1
    dup, again = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k in range(n):
        lines = [x for x in raw[offsets[k] : offsets[k + 1]].split(b"\n") if x and not x.isspace()]
        dup[k] = len(lines) - len(set(lines))
        again[k] = W.repeated_window_words(ids[ends[k] : ends[k + 1]], len(names))
    inside = ~W.SPACE[data] & ((data & 0xC0) != 0x80)
    return {"n_words": np.diff(ends), "word_chars": W.sums(inside.astype(np.int64), offsets), "n_symbols": W.sums(_SYMBOL[data].astype(np.int64), offsets), "n_dup_lines": dup, "n_repeat_words": again}


def _base_failed(n_words, n_repeat, min_words: int, most_repeat: int):
    return (n_words < min_words) | (100 * n_repeat > most_repeat * n_words)


def margins(blocks, weights: np.ndarray) -> np.ndarray:
    """Weights times relative n-gram frequencies, summed over the blocks."""
    total = 0
    for w, (h, first, count) in zip(weights, blocks):
        run = np.concatenate([[0.0], np.cumsum(w[h])])
        total = total + (run[np.minimum(first + count, len(h))] - run[np.minimum(first, len(h))]) / np.maximum(count, 1)
    return total


def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse frequencies of labelled rows: y, fold, and the numbers and values of the features."""
    for batch in batches:
        out = {"y": [], "fold": [], "at": [], "value": []}
        y, fold = batch.column("y").to_pylist(), batch.column("fold").to_pylist()
        for first, data, offsets in W.slices(batch.column("text")):
            blocks = grams(data, offsets, *W.split_words(data, offsets))
            for k in range(len(offsets) - 1):
                at, value = [], []
                for b, (h, start, count) in enumerate(blocks):
                    hashes, n = np.unique(h[start[k] : start[k] + count[k]], return_counts=True)
                    at.append(hashes + (b << BITS))
                    value.append(n / max(1, count[k]))
                out["y"].append(y[first + k])
                out["fold"].append(fold[first + k])
                out["at"].append(np.concatenate(at).astype("<i4").tobytes())
                out["value"].append(np.concatenate(value).astype("<f4").tobytes())
        yield pa.RecordBatch.from_pydict(out, pa.schema([("y", pa.float64()), ("fold", pa.int64()), ("at", pa.binary()), ("value", pa.binary())]))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def row_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum of each row's values; rows lie end to end."""
    out, some = np.zeros(len(lengths)), lengths > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(lengths) - lengths)[some])
    return out


def fit_logistic(at: np.ndarray, value: np.ndarray, lengths: np.ndarray, y: np.ndarray, n_features: int, ridge: float = 1e-3, steps: int = 80) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse rows, end to end in flat arrays, by accelerated gradient descent on scaled features."""
    rows = len(lengths)
    scale = np.sqrt(np.bincount(at, value, n_features) / rows) + 1e-3
    value = value / scale.astype(np.float32)[at]
    times = lambda w: row_sums(value * w.astype(np.float32)[at], lengths)
    back = lambda r: np.bincount(at, value * np.repeat(r.astype(np.float32), lengths), n_features)
    v = np.ones(n_features)
    for _ in range(8):
        v = back(times(v))
        v /= np.linalg.norm(v) or 1.0
    most = float(np.linalg.norm(back(times(v)))) / rows + 1
    w, bias, ahead, ahead_bias, t = np.zeros(n_features), 0.0, np.zeros(n_features), 0.0, 1.0
    for _ in range(steps):
        r = (_sigmoid(times(ahead) + ahead_bias) - y) / rows
        step = 1 / (0.25 * most + ridge)
        new, new_bias = ahead - step * (back(r) + ridge * ahead), ahead_bias - step * r.sum()
        t, old = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        ahead, ahead_bias = new + (old - 1) / t * (new - w), new_bias + (old - 1) / t * (new_bias - bias)
        w, bias = new, new_bias
    return w / scale, bias


def fit_platt(margin: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities, by Newton steps on smoothed targets."""
    good, bad = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margin, np.ones(len(margin))], 1)
    theta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = _sigmoid(x @ theta)
        grad = x.T @ (p - target) + 1e-3 * (theta - [1.0, 0.0])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        theta = theta - move * min(1.0, 5 / (np.abs(move).max() + 1e-12))
        if np.abs(move).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def _flat(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed numbers, end to end, and how many each row has."""
    parts, lengths = [np.zeros(0, kind)], [np.zeros(0, np.int64)]
    for chunk in column.chunks:
        offsets = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1].astype(np.int64)
        data = chunk.buffers()[2]
        if len(chunk) and data is not None:
            parts.append(np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind))
        lengths.append(np.diff(offsets) // np.dtype(kind).itemsize)
    return np.concatenate(parts), np.concatenate(lengths)


def one_text_each(rows: DataFrame) -> DataFrame:
    """One row for each id, its label and fold, with the least of its texts: a minimum that combines before the shuffle."""
    return rows.groupBy("doc_id", "y", "fold").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> Model:
    """Fit on about ``sample_rows`` labelled documents, drawn by a hash of the id (twice as many at most).

    Rows of one id count once, with their least text.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    stat = known.agg(F.count("*").alias("n"), F.avg("y").alias("share")).first()
    n_features = BLOCKS << BITS
    constant = Model(np.zeros((BLOCKS, 1 << BITS)), 0.0, 0.0, 500.0 if not stat["n"] else math.log(max(stat["share"], 1e-9) / max(1 - stat["share"], 1e-9)))
    if not stat["n"] or stat["share"] in (0.0, 1.0):
        return constant
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20))
    sample = known.where(draw < math.ceil((1 << 20) * min(1.0, sample_rows / stat["n"]))).limit(2 * sample_rows)
    sample = sample.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(4)))
    rows = one_text_each(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")).select("text", "y", "fold")
    got = rows.mapInArrow(features, "y double, fold long, at binary, value binary").toArrow()
    y, fold = got["y"].to_numpy(), got["fold"].to_numpy()
    (at, lengths), value = _flat(got["at"], "<i4"), _flat(got["value"], "<f4")[0]
    del got
    fit, held = fold != 0, fold == 0
    if held.sum() < 20 or len(set(y[held])) < 2:  # too few to hold back
        fit = held = np.ones(len(y), bool)
    if len(set(y[fit])) < 2:
        return constant
    own = np.repeat(fit, lengths)
    weights, bias = fit_logistic(at[own], value[own], lengths[fit], y[fit], n_features)
    margin = row_sums(value * weights.astype(np.float32)[at], lengths) + bias
    slope, shift = fit_platt(margin[held], y[held])
    return Model(weights.reshape(BLOCKS, -1), bias, slope, shift)


def verdict(text: Column, model: Model, min_words: int = MIN_WORDS, most_repeat: int = MOST_REPEAT_PERCENT, least_probability: float = LEAST_PROBABILITY) -> Column:
    """A struct of the base figures, base_failed, probability and kept, computed in Arrow batches."""

    @F.arrow_udf(f"struct<{BASE_TYPE.replace(' long', ':long')},base_failed:boolean,probability:double,kept:boolean>")
    def rules(texts: pa.Array) -> pa.Array:
        parts = []
        for _, data, offsets in W.slices(texts):
            words, ends = W.split_words(data, offsets)
            found = base_counts(data, offsets, words, ends)
            found["base_failed"] = _base_failed(found["n_words"], found["n_repeat_words"], min_words, most_repeat)
            found["probability"] = model.probability(margins(grams(data, offsets, words, ends), model.weights))
            found["kept"] = ~found["base_failed"] & (found["probability"] >= least_probability)
            parts.append(pa.StructArray.from_arrays([pa.array(x) for x in found.values()], list(found)))
        kind = pa.struct([*((n.split()[0], pa.int64()) for n in BASE_TYPE.split(", ")), ("base_failed", pa.bool_()), ("probability", pa.float64()), ("kept", pa.bool_())])
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return rules(text)


def quality_rules(docs: DataFrame, model: Model, text: str = "text", into: str = "quality_rules", **limits) -> DataFrame:
    """``docs`` with the struct of :func:`verdict` in the column ``into``."""
    prepare(docs.sparkSession)
    return docs.withColumn(into, verdict(F.col(text), model, **limits))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality_rules(docs.select("doc_id", "text"), train(docs, labels))
    return found.select("doc_id", "quality_rules.*")
