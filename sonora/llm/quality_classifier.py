"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

Every document is reduced once to a short vector of statistics (written to the shared folder). All
labelled rows take part in the fit: each partition sums its share of the normal equations, Spark adds the
shares up entry by entry, and the driver solves one system of fixed size. The ridge scores of a held-back
fifth of the learned rows are counted in fixed bins; pooling adjacent violators over the bins gives the
calibration, interpolated between the pooled blocks.

Defined cases: a null text counts as empty, and an empty text is scored from its all-zero statistics.
Repeated rows are scored alike. A null doc_id is never learned and is not held out. Several labels of a
document count as their mean, good from 0.5. Without labels of both kinds every score is the share of
good labels (0.5 without any). An empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonora.llm import words as W
from sonora.llm.shared import prepare, remainder, saved, table

#: Random features, kernel width (in standard deviations), ridge, bins of the calibration, seed.
N_FEATURES, WIDTH, RIDGE, BINS, SEED = 192, 4.0, 1e-3, 1024, 11
HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 3, 1

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "stop": b".,;:!?", "bang": b"!?",
    "symbol": b"#*$%&|<>@^~=+_\\/", "bracket": b"()[]{}\"'`", "newline": b"\n",
}
STATISTICS = ["log_bytes", "log_words", "log_lines", "word_length", "word_length_spread", "space", "wide", *_CLASSES, "distinct_words", "commonest_word", "words_ending_plain", "words_upper", "dup_lines", "repeat_words", "line_length", "entropy"]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of figures, each of a bounded range, for every text."""
    out = np.zeros((len(texts), len(STATISTICS)))
    tables = [np.isin(np.arange(256), list(x)) for x in _CLASSES.values()]
    for first, data, offsets in W.slices(texts):
        raw, words, ends = data.tobytes(), *W.split_words(data, offsets)
        names = W.Vocabulary()
        ids = names.ids(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        spelled = list(names)
        plain = np.fromiter((w[-1:].isalpha() or w[-1] >= 0x80 for w in spelled), bool, len(spelled))
        upper = np.fromiter((w.isupper() and len(w) > 1 for w in spelled), bool, len(spelled))
        shares = [W.sums(t[data].astype(np.int64), offsets) for t in [W.SPACE, np.arange(256) >= 0x80, *tables]]
        n_bytes, n_words = np.diff(offsets), np.diff(ends)
        total, square = W.sums(lengths, ends), W.sums(lengths**2, ends)
        plain_n, upper_n = W.sums(plain[ids].astype(np.int64), ends), W.sums(upper[ids].astype(np.int64), ends)
        for k in range(len(offsets) - 1):
            b, n = max(1, int(n_bytes[k])), max(1, int(n_words[k]))
            own = ids[ends[k] : ends[k + 1]]
            _, counts = np.unique(own, return_counts=True)
            lines = [x for x in raw[offsets[k] : offsets[k + 1]].split(b"\n") if x and not x.isspace()]
            bytes_n = np.bincount(data[offsets[k] : offsets[k + 1]], minlength=1)
            p = bytes_n[bytes_n > 0] / b
            mean = total[k] / n
            out[first + k] = [
                np.log1p(n_bytes[k]), np.log1p(n_words[k]), np.log1p(len(lines)), min(mean, 50), min(np.sqrt(max(0.0, square[k] / n - mean * mean)), 50),
                *(s[k] / b for s in shares), len(counts) / n, counts.max(initial=0) / n, plain_n[k] / n, upper_n[k] / n,
                1 - len(set(lines)) / max(1, len(lines)), W.repeated_window_words(own, len(names)) / n, np.log1p(n_bytes[k] / max(1, len(lines))), -float(p @ np.log2(p)) if len(p) else 0.0,
            ]
    return out


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each document's text."""

    @F.arrow_udf("array<double>")
    def figures(texts: pa.Array) -> pa.Array:
        x = statistics(texts)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(STATISTICS)), pa.int32()), pa.array(x.ravel()))

    return docs.select("doc_id", figures("text").alias("x"))


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Model:
    """Scaling, the random projection, ridge weights, and the calibration's knots."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8) @ self.directions + self.phases
        return np.concatenate([np.sqrt(2 / len(self.phases)) * np.cos(z), np.ones((len(x), 1))], 1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, 0, 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x) if self.weights is not None else np.zeros(len(x)), *self.knots)


def normal_equations(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """This partition's share of Z'Z (upper triangle) and Z'y, as one row for each entry."""
    size = len(model.phases) + 1
    gram, right = np.zeros((size, size)), np.zeros(size)
    for batch in batches:
        z, y = model.features(_vectors(batch.column("x"))), batch.column("y").to_numpy()
        gram += z.T @ z
        right += z.T @ y
    i, j = np.triu_indices(size)
    yield pa.RecordBatch.from_pydict({"entry": np.concatenate([i * size + j, size * size + np.arange(size)]), "value": np.concatenate([gram[i, j], right])})


def pool_adjacent(x: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression over bins in order: the mean place and the level of each pooled block."""
    blocks: list[list[float]] = []
    for px, pg, pn in zip(x, good, count):
        blocks.append([px * pn, pg, pn])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def train(figures: DataFrame, labels: DataFrame, n_features: int = N_FEATURES, width: float = WIDTH, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """Fit on all labelled rows that are not held out. ``figures``: doc_id and x, one row for each document."""
    d = len(STATISTICS)
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    known = known.where(remainder(F.col("doc_id"), HELD_OUT_MODULUS) != HELD_OUT_REMAINDER)
    known = saved(figures.join(known, "doc_id").withColumn("part", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(5))), "labelled")
    moments = known.agg(F.count("*"), F.avg("y"), *(f(F.col("x")[k]) for k in range(d) for f in (F.avg, F.stddev_pop))).first()
    n, share, moments = moments[0], moments[1], np.array(moments[2:], float) if moments[0] else np.zeros(2 * d)
    rng = np.random.default_rng(seed)
    model = Model(moments[::2], np.maximum(moments[1::2], 1e-6), rng.normal(size=(d, n_features)) / width, rng.uniform(0, 2 * np.pi, n_features))
    if not n or share in (0.0, 1.0):
        model.knots = np.array([0.0, 1.0]), np.full(2, 0.5 if not n else share)
        return model
    size = n_features + 1
    entries = known.where("part > 0").select("x", "y").mapInArrow(lambda b: normal_equations(b, model), "entry long, value double").groupBy("entry").agg(F.sum("value").alias("value")).toArrow()
    flat = np.zeros(size * size + size)
    flat[entries["entry"].to_numpy()] = entries["value"].to_numpy()
    gram = flat[: size * size].reshape(size, size)
    gram = gram + np.triu(gram, 1).T
    model.weights = np.linalg.solve(gram + ridge * max(1.0, gram[-1, -1]) * np.diag([*[1.0] * n_features, 1e-6]), flat[size * size :])
    bins = known.where("part = 0").select(_scored(F.col("x"), model, raw=True).alias("s"), "y")
    bins = bins.groupBy(F.least(F.floor(F.col("s") * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.avg("s"), F.sum("y"), F.count("*")).orderBy("bin").collect()
    if len(bins) > 1:
        model.knots = pool_adjacent(*(np.array([b[k] for b in bins], float) for k in (1, 2, 3)))
    else:
        model.knots = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def _scored(x: Column, model: Model, raw: bool = False) -> Column:
    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.float64())
        return pa.array(np.clip((model.raw if raw else model.score)(_vectors(column)), 0.0, 1.0))

    return score(x)


def quality_classifier(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    prepare(docs.sparkSession)
    figures = saved(with_statistics(docs), "statistics")
    found = figures.select("doc_id", "x").withColumn("score", _scored(F.col("x"), train(figures, labels, **params)))
    held = F.coalesce(remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT_REMAINDER, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
