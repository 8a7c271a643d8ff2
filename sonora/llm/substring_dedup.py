"""Substring dedup: suffix automata of reference shards find windows of words that start more than once.

Every window of ``window`` words is filed under its anchor, the least hash of the ``anchor_words``-grams in it;
equal windows share their anchor, so only windows whose anchor occurs twice can repeat. Consecutive windows of
one anchor form a segment. Copies of a text count once: all words of a text with copies go, and it meets other
texts as one. Copies of a segment count once too: the distinct segments of a repeated anchor, each weighed by its
occurrences, are a reference shard. A shard's task builds a suffix automaton over them and streams them through it:
the state of the last ``window`` words tells how often they occur in the corpus. An automaton goes only to the
task that reads its shard; sending all of them to all tasks would grow with the corpus.

A shard holds at most ``most_segments`` distinct segments and ``most_words`` words. Beyond that its windows are
counted one by one under a 128-bit hash of their bytes, a sum that Spark combines before it shuffles, so no hot
shard forms and nothing is lost. Results go back to segments, texts and documents by joins in which a key that
holds a large share of the rows is broadcast, so no key's rows are gathered.

Defined cases: a null or empty text has no words (the checksum of the empty string). Texts shorter than the
window lose nothing. Repeated rows repeat each other's windows. A very long text is one row, worked on by itself. A null doc_id is carried. An empty table gives
an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonora.llm import words as W
from sonora.llm.hashing import ODD, mixed, rolled
from sonora.llm.shared import attached, prepare, saved, table

WINDOW, ANCHOR_WORDS, MOST_SEGMENTS, MOST_WORDS = 35, 8, 8192, 1 << 18


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x, done = np.minimum(x[:-done], x[done:]), 2 * done
    rest = width - done
    return np.minimum(x[:-rest], x[rest:]) if rest else x


class Segments:
    """The segments of a slice of texts: document, anchor, first window, windows; and the word hashes."""

    def __init__(self, words: list[bytes], ends: np.ndarray, window: int, anchor_words: int) -> None:
        names = W.Vocabulary()
        ids = names.ids(words)
        digest = xxhash.xxh3_64_intdigest
        self.hash = np.fromiter(map(digest, names), np.uint64, len(names))[ids] if len(ids) else np.zeros(0, np.uint64)
        self.doc = self.anchor = self.first = self.count = np.zeros(0, np.int64)
        n_windows = np.maximum(0, np.diff(ends) - window + 1)
        if not n_windows.any():
            return
        grams = rolled(self.hash, len(words) - anchor_words + 1, anchor_words, ODD[0])
        least = _least(grams, window - anchor_words + 1)
        doc = np.repeat(np.arange(len(n_windows)), n_windows)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        value = least[ends[doc] + at]
        cut = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])]))
        self.doc, self.anchor, self.first = doc[cut], value[cut], at[cut]
        self.count = np.diff(np.append(cut, len(doc)))
        self._grams, self._ends, self._n = grams, ends, np.maximum(0, np.diff(ends) - anchor_words + 1)

    def key(self, doc: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        return mixed(anchor + mixed(doc.astype(np.uint64) * ODD[1] + np.uint64(1)))

    def occurrences(self) -> np.ndarray:
        """2 for an anchor whose words occur twice or more in its document, else 1."""
        if not len(self.doc):
            return np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(self._n)), self._n)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(self._n) - self._n, self._n)
        keys = np.sort(self.key(doc, self._grams[self._ends[doc] + at]))
        again = keys[1:][keys[1:] == keys[:-1]]
        return 1 + np.isin(self.key(self.doc, self.anchor), again)


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _digests(things: list[bytes]) -> tuple[pa.Array, pa.Array]:
    """Both halves of a 128-bit hash of each."""
    found = list(map(xxhash.xxh3_128_digest, things))
    halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2) if found else np.zeros((0, 2), np.int64)
    return pa.array(halves[:, 0]), pa.array(halves[:, 1])


def _anchors(window: int, anchor_words: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each text, its number of words and its anchors, each with 2 where its words occur twice in the text, else 1."""
        for batch in batches:
            for first, data, offsets in W.slices(batch.column("text")):
                words, ends = W.split_words(data, offsets)
                s, n = Segments(words, ends, window, anchor_words), len(ends) - 1
                cuts = np.concatenate([[0], np.cumsum(np.bincount(s.doc, minlength=n))])
                pairs = pa.StructArray.from_arrays([_longs(s.anchor), pa.array(s.occurrences())], ["anchor", "n"])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, n) for c in ("t1", "t2")), pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pairs)], names=["t1", "t2", "n_words", "anchors"])

    return task


def _segments(window: int, anchor_words: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The segments of repeated anchors: where they lie, a hash of their words, and the words."""
        for batch in batches:
            t1, t2 = (batch.column(c).to_numpy() for c in ("t1", "t2"))
            for first, data, offsets in W.slices(batch.column("text")):
                words, ends = W.split_words(data, offsets)
                s = Segments(words, ends, window, anchor_words)
                lists = batch.column("repeated").slice(first, len(offsets) - 1)
                doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                known = s.key(doc, lists.flatten().to_numpy().view(np.uint64))
                at = np.flatnonzero(np.isin(s.key(s.doc, s.anchor), known))
                begin = ends[s.doc[at]] + s.first[at]
                joined = [b" ".join(words[a:b]) for a, b in zip(begin.tolist(), (begin + s.count[at] + window - 1).tolist())]
                yield pa.RecordBatch.from_arrays([_longs(s.anchor[at]), *_digests(joined), pa.array(t1[first + s.doc[at]]), pa.array(t2[first + s.doc[at]]), pa.array(s.first[at]), pa.array(s.count[at] + window - 1), pa.array(joined, pa.binary())], names=["anchor", "s1", "s2", "t1", "t2", "start", "size", "words"])

    return task


def _windows(window: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each window of some segments: its place and a hash of its words."""
        for batch in batches:
            for k, joined in enumerate(batch.column("words")):
                whole = joined.as_py()
                ends = np.flatnonzero(np.frombuffer(whole + b" ", np.uint8) == 32)
                starts = np.concatenate([[0], ends[:-1] + 1])
                n = len(ends) - window + 1
                for lo in range(0, n, 1 << 14):  # a long segment's windows, some at a time
                    hi = min(lo + (1 << 14), n)
                    found = [whole[a:b] for a, b in zip(starts[lo:hi].tolist(), ends[lo + window - 1 : hi + window - 1].tolist())]
                    own = [pa.repeat(batch.column(c)[k], hi - lo) for c in ("s1", "s2", "copies")]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(np.arange(lo, hi)), *_digests(found)], names=["s1", "s2", "times", "first", "h1", "h2"])

    return task


class SuffixAutomaton:
    """All runs of symbols of some sequences, with how often each occurs, copies counted."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.times = [-1], [0], [0]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.times.append(0)
        return len(self.next) - 1

    def _split(self, p: int, symbol: int, q: int) -> int:
        """The state for the longest run that reaches ``q`` from ``p``; ``q`` keeps the longer ones."""
        if self.length[q] == self.length[p] + 1:
            return q
        short = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = short
        while p != -1 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = short
            p = self.link[p]
        return short

    def add(self, sequence: list[int], copies: int) -> None:
        last = 0
        for symbol in sequence:
            if symbol in self.next[last]:
                last = self._split(last, symbol, self.next[last][symbol])
            else:
                new, p = self._state(self.length[last] + 1, 0, {}), last
                while p != -1 and symbol not in self.next[p]:
                    self.next[p][symbol] = new
                    p = self.link[p]
                if p != -1:
                    self.link[new] = self._split(p, symbol, self.next[p][symbol])
                last = new
            self.times[last] += copies

    def close(self) -> None:
        """Add the counts of longer runs to those of their ends."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.times[self.link[state]] += self.times[state]

    def repeated(self, sequence: list[int], window: int) -> list[bool]:
        """For each window of the sequence, whether it occurs more than once."""
        state, matched, out = 0, 0, []
        nxt, link, length, times = self.next, self.link, self.length, self.times
        for symbol in sequence:
            while state and symbol not in nxt[state]:
                state = link[state]
                matched = length[state]
            if symbol in nxt[state]:
                state, matched = nxt[state][symbol], matched + 1
            while state and length[link[state]] >= window:
                state = link[state]
                matched = min(matched, length[state])
            if matched >= window:
                out.append(times[state] > 1)
        return out


def _shard(segments: list[bytes], copies: list[int], window: int) -> list[list[tuple[int, int]]]:
    """For each distinct segment of a shard: spans of words that repeated windows cover."""
    if len(segments) == 1 and copies[0] > 1:
        return [[(0, segments[0].count(b" ") + 1)]]
    names = W.Vocabulary()
    sequences = [[names[w] for w in s.split(b" ")] for s in segments]
    automaton = SuffixAutomaton()
    for sequence, n in zip(sequences, copies):
        automaton.add(sequence, n)
    automaton.close()
    out = []
    for sequence in sequences:
        spans: list[tuple[int, int]] = []
        for k, again in enumerate(automaton.repeated(sequence, window)):
            if again and spans and k <= spans[-1][1]:
                spans[-1] = (spans[-1][0], k + window)
            elif again:
                spans.append((k, k + window))
        out.append(spans)
    return out


_SPANS = "array<struct<first:long,last:long>>"


def _shards(window: int):
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor; of each segment with repeated windows, the spans that they cover."""
        held, anchor = [], None

        def spans() -> list[tuple]:
            found = _shard([h[3] for h in held], [h[2] for h in held], window)
            return [(s1, s2, n, rows) for (s1, s2, n, _), rows in zip(held, found) if rows]

        def sent(rows: list[tuple]) -> pa.RecordBatch:
            columns = [[r[k] for r in rows] for k in range(4)]
            lists = [[{"first": a, "last": b} for a, b in x] for x in columns[3]]
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(lists, kind)], names=["s1", "s2", "copies", "spans"])

        for batch in batches:
            rows: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("anchor", "s1", "s2", "copies", "words")]
            for g, *row in zip(*columns):
                if g != anchor:
                    rows += spans() if held else []
                    held, anchor = [], g
                held.append(row)
            yield sent(rows)
        if held:
            yield sent(spans())

    return task


def spans(docs: DataFrame, window: int = WINDOW, anchor_words: int = ANCHOR_WORDS, most_segments: int = MOST_SEGMENTS, most_words: int = MOST_WORDS) -> DataFrame:
    """t1, t2 (hashes of a text), ``copies`` of the text, and ``spans``: first and last (exclusive) of the words that
    repeated windows cover. ``docs``: t1, t2, text."""
    spark = docs.sparkSession
    texts = docs.select("t1", "t2", "text").where(F.char_length("text") >= 2 * window - 1)
    found = texts.mapInArrow(_anchors(window, anchor_words), "t1 long, t2 long, n_words long, anchors array<struct<anchor:long,n:long>>")
    found = saved(found.where(F.col("n_words") >= window).groupBy("t1", "t2").agg(F.first("n_words").alias("n_words"), F.first("anchors").alias("anchors"), F.count("*").alias("copies")), "anchors")
    filed = found.select("t1", "t2", F.explode("anchors").alias("a")).select("t1", "t2", "a.*")
    twice = saved(filed.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "repeated")
    by_text = filed.select("t1", "t2", "anchor").join(twice, "anchor").groupBy("t1", "t2").agg(F.collect_set("anchor").alias("repeated"))
    once = texts.dropDuplicates(["t1", "t2"]).join(saved(by_text, "by-text"), ["t1", "t2"])
    segments = saved(once.mapInArrow(_segments(window, anchor_words), "anchor long, s1 long, s2 long, t1 long, t2 long, start long, size long, words binary"), "segments")

    # Distinct segments, weighed by their occurrences; shards too large for an automaton are counted by windows.
    distinct = saved(segments.groupBy("anchor", "s1", "s2").agg(F.first("words").alias("words"), F.first("size").alias("size"), F.count("*").alias("copies")), "distinct")
    sizes = distinct.groupBy("anchor").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    large = saved(sizes.where((F.col("n") > most_segments) | (F.col("size") > most_words)).select("anchor"), "large")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cold = distinct.join(large, "anchor", "left_anti").repartition(n, "anchor").sortWithinPartitions("anchor")
    cold = cold.mapInArrow(_shards(window), f"s1 long, s2 long, copies long, spans {_SPANS}")
    covered = cold
    if not large.isEmpty():
        windows = distinct.join(large, "anchor", "left_semi").select("s1", "s2", "copies", "words")
        windows = saved(windows.mapInArrow(_windows(window), "s1 long, s2 long, times long, first long, h1 long, h2 long"), "windows")
        again = saved(windows.groupBy("h1", "h2").agg(F.sum("times").alias("total"), F.count("*").alias("copies")).where("total > 1").select("h1", "h2", "copies"), "again")
        hot = attached(windows, again, ["h1", "h2"]).groupBy("s1", "s2").agg(F.first("times").alias("copies"), F.collect_list(F.struct("first", (F.col("first") + window).alias("last"))).alias("spans"))
        covered = cold.unionByName(hot)
    covered = saved(covered, "covered")

    shifted = F.transform("spans", lambda x: F.struct((x["first"] + F.col("start")).alias("first"), (x["last"] + F.col("start")).alias("last")))
    within = attached(segments.select("s1", "s2", "t1", "t2", "start"), covered, ["s1", "s2"]).select("t1", "t2", shifted.alias("spans"))
    whole = found.where("copies > 1").select("t1", "t2", F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("last"))).alias("spans"))
    joined = within.unionByName(whole).groupBy("t1", "t2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return joined.join(found.select("t1", "t2", "copies"), ["t1", "t2"])


def with_text_keys(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})


def substring_dedup(docs: DataFrame, window: int = WINDOW, **params) -> DataFrame:
    """doc_id, n_words, n_removed and the remaining text (``kept``: words joined by one space) of each document."""
    prepare(docs.sparkSession)
    docs = with_text_keys(docs.select("doc_id", "text"))

    @F.arrow_udf("struct<n_words:long,n_removed:long,kept:string>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts, spans):
            words = (text.as_py() or "").encode().split()
            edge = np.zeros(len(words) + 1, np.int64)
            for s in found.as_py() or []:
                edge[s["first"]] += 1
                edge[s["last"]] -= 1
            kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
            out.append((len(words), len(words) - len(kept), b" ".join([words[k] for k in kept]).decode()))
        return pa.StructArray.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["n_words", "n_removed", "kept"])

    covered = saved(spans(docs, window, **params), "spans")
    rows = attached(docs, covered, ["t1", "t2"], how="left").select("doc_id", cut("text", "spans").alias("cut"))
    return rows.select("doc_id", "cut.*")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
