"""Language ID by rank-order profiles of character n-grams (out-of-place distance).

A text is lower-cased and cut into words of letters (``str.isalpha``); each word, with a mark at both ends, gives its 1- to
3-grams. A profile lists the ``PROFILE_SIZE`` most frequent n-grams by rank, ties by the n-gram's code
points. A document's distance to a language sums, over the document's own profile, how far out of place
each n-gram is; an n-gram that the language's profile lacks counts ``PROFILE_SIZE``. Profiles are counted
over all learned documents: partial counts of each batch are added up by Spark.

Defined cases: a null text, one without letters, and any text when nothing could be learned get ``und``
with score 0. Equal distances go to the language that sorts first. Repeated rows count and are predicted
each on its own. A null doc_id or lang is never learned; a null doc_id is not held out. An empty table
gives an empty result; extra columns are ignored. A very long text is cut into words ``PIECE`` characters at
a time, never within a word, and counts whole.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonora.llm.shared import prepare, remainder, table

PROFILE_SIZE, LONGEST = 300, 3
HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 5, 0
#: Characters of a text that are lower-cased and cut into words at once; a cut never falls within a word.
PIECE = 1 << 22
#: Distinct words whose n-grams, and n-grams whose numbers, a task remembers.
WORDS_KEPT, GRAMS_KEPT = 200_000, 100_000
#: Parts in which the most frequent n-grams of a language are sought before the parts are merged.
PARTS = 8
#: Runs of letters and of numeric signs that are no decimal digits (``²``, ``½``, ``Ⅷ``), which ``letters_only`` cuts out.
_LETTERS = re.compile(r"[^\W\d_]+")
_MARK = 0x20


def letters_only(found: Counter) -> Counter:
    """The counts with each word that holds a character which is no letter cut there."""
    for word in [w for w in found if not w.isalpha()]:
        n = found.pop(word)
        for part in "".join(c if c.isalpha() else " " for c in word).split():
            found[part] += n
    return found


def count_words(text: str | None) -> Counter:
    """How often each lower-cased word of letters occurs."""
    found: Counter = Counter()
    start, n = 0, len(text or "")
    while start < n:
        end = min(n, start + PIECE)
        while end < n and text[end].isalpha():
            end += 1
        found.update(_LETTERS.findall(text[start:end].lower()))
        start = end
    return letters_only(found)


def gram_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of marked words as numbers, up to three code points of 21 bits, and each one's word; by word."""
    p = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = p != _MARK
    word = np.cumsum(~letter) - 1
    pair = letter[:-1] | letter[1:]
    codes = [p[letter] << 42, (p[:-1] << 42 | p[1:] << 21)[pair], (p[:-2] << 42 | p[1:-1] << 21 | p[2:])[letter[1:-1]]]
    # A mark between two words counts with the word before it as an end, and with the word after it as a start.
    of = [word[letter], np.where(letter[:-1], word[:-1], word[1:])[pair], word[1:-1][letter[1:-1]]]
    codes, of = np.concatenate(codes), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return codes[order], of[order]


class Grams:
    """Numbers n-grams and remembers the n-grams of words."""

    def __init__(self) -> None:
        self.number, self.words, self.codes = {}, {}, np.zeros(0, np.int64)
        self.pool, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        codes, of = gram_codes(words)
        fresh, at = np.unique(codes, return_inverse=True)
        number = self.number
        numbers = np.fromiter((number.setdefault(c, len(number)) for c in fresh.tolist()), np.int32, len(fresh))
        self.pool = np.concatenate([self.pool, numbers[at]])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.bincount(of, minlength=len(words)))])
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words))))
        self.codes = np.fromiter(number, np.int64, len(number))

    def counts(self, docs: list[Counter]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The codes of each document's n-grams, and how often each occurs."""
        if len(self.words) > WORDS_KEPT or len(self.number) > GRAMS_KEPT:
            self.__init__()
        fresh = list({w: None for words in docs for w in words if w not in self.words})
        if fresh:
            self._learn(fresh)
        for words in docs:
            at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
            first, lengths = self.ends[at], self.ends[at + 1] - self.ends[at]
            places = np.arange(lengths.sum()) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)
            times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), lengths)
            n = np.bincount(self.pool[places], times, len(self.codes)).astype(np.int64)
            found = np.flatnonzero(n)
            yield self.codes[found], n[found]


def _lots(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts, about PIECE characters at a time."""
    lot, size = [], 0
    for text in texts:
        lot.append(text.as_py())
        size += len(lot[-1] or "")
        if size >= PIECE:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


def ranked(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE_SIZE) -> np.ndarray:
    """The most frequent codes, in the order of their ranks."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))[:size]]


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n-gram counts by language of each batch."""
    grams = Grams()
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            words.setdefault(lang, Counter()).update(count_words(text.as_py()))
        for lang, (codes, counts) in zip(words, grams.counts(list(words.values()))):
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(codes), pa.string()), "gram": codes, "n": counts})


def train(docs: DataFrame, size: int = PROFILE_SIZE) -> dict[str, np.ndarray]:
    """The profile of each language, from all rows that are not held out and have a language."""
    learned = docs.where((remainder(F.col("doc_id"), HELD_OUT_MODULUS) != HELD_OUT_REMAINDER) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = learned.select("lang", "text").mapInArrow(partial_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Each part keeps its `size` most frequent n-grams, so what reaches the driver is bounded by languages x PARTS x size.
    # The rank is a window that can spill; Spark cuts it off before the shuffle, so no task holds a language's n-grams.
    part = F.pmod(F.xxhash64("gram"), F.lit(PARTS)).alias("part")
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(F.col("n").desc(), "gram"))
    top = counts.select("lang", "gram", "n", part).withColumn("place", place).where(F.col("place") <= size)
    found: dict[str, list] = {}
    for row in top.select("lang", "gram", "n").collect():
        found.setdefault(row["lang"], []).append((-row["n"], row["gram"]))
    return {lang: np.array([g for _, g in sorted(found[lang])[:size]], np.int64) for lang in sorted(found)}


class Profiles:
    """Out-of-place distances of a document's profile to all languages."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int = PROFILE_SIZE) -> None:
        self.langs, self.size = list(profiles), size
        self.codes = np.unique(np.concatenate([np.zeros(0, np.int64), *profiles.values()]))
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int64)
        for k, profile in enumerate(profiles.values()):
            self.ranks[np.searchsorted(self.codes, profile), k] = np.arange(len(profile))

    def predict(self, own: np.ndarray) -> tuple[str, float]:
        if not len(own) or not self.langs:
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        at = np.where(self.codes[at] == own, at, len(self.codes))
        there = self.ranks[at]
        away = np.where(there < 0, self.size, np.abs(there - np.arange(len(own))[:, None])).sum(0)
        best = int(np.argmin(away))
        return self.langs[best], float(1 - away[best] / (len(own) * self.size))


def predicted(text: Column, profiles: dict[str, np.ndarray], size: int = PROFILE_SIZE) -> Column:
    """A struct of the predicted language and a score from 0 to 1."""
    index = Profiles(profiles, size)
    state: list[Grams] = []

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        if not state:
            state.append(Grams())
        found = [index.predict(ranked(*n, size)) for lot in _lots(texts) for n in state[0].counts([count_words(t) for t in lot])]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang", "score"])

    return predict(text)


def language_id(docs: DataFrame, size: int = PROFILE_SIZE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""
    prepare(docs.sparkSession)
    profiles = train(docs.select("doc_id", "lang", "text"), size)
    held = F.coalesce(remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT_REMAINDER, F.lit(False))
    found = docs.select("doc_id", predicted(F.col("text"), profiles, size).alias("found"))
    return found.select("doc_id", held.alias("held_out"), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))
