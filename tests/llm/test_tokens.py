import random
import zlib
from unittest import mock

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sonora.llm import packing as P
from sonora.llm import token_counts as T
from sonora.llm import tokens as K
from sonora.llm import words as W
from sonora.llm.shared import fresh_path
from sonora.llm.tokens import Tokens, default_tokenizer
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_texts_ids(rows, whole):
    known = Tokens(default_tokenizer())
    for _, text, *_ in rows:
        assert known.ids((text or "").encode().split())[0].tolist() == whole(text)


def _drawn(seed, n, alphabet):
    draw = random.Random(seed)
    return ["".join(draw.choices(alphabet, k=draw.randint(0, 12))) for _ in range(n)]


STRANGE = [chr(c) for c in (*range(1, 0x260), 0x130, 0x301, 0x3A3, 0x416, 0x4E2D, 0x212A, 0x2C65, 0x1F600, 0x85, 0x2028)]


@pytest.mark.parametrize("alphabet", [list("'sStTrReEvVmMlLdD0\"x"), list("aE\u00e9\u00c9\u00df\u01c5\u023a\u023e'1\u00b2.$ "), STRANGE], ids=["contractions", "latin", "strange"])
def test_words_of_odd_characters(whole, alphabet):
    known = Tokens(default_tokenizer())
    for text in [*_drawn(1, 300, alphabet), " ".join(_drawn(2, 2000, alphabet)), "x<|endoftext|>y <|ENDOFTEXT|> it's"]:
        words = text.encode().split()
        ids, lengths = known.ids(words)
        assert ids.tolist() == whole(b" ".join(words).decode())
        assert lengths.tolist() == known.counts(words).tolist() == [len(whole(w.decode())) for w in words]


def test_words_of_another_pattern(whole):
    known = Tokens(default_tokenizer())
    known.plainly = False  # as for a tokenizer that cuts in other ways
    text = "It's 12 \u00c9t\u00e9s, it's"
    assert known.ids(text.encode().split())[0].tolist() == whole(text)


@pytest.mark.parametrize("kept", [0, 5, 40])
def test_ids_after_dictionaries_are_started_anew(rows, whole, kept):
    known = Tokens(default_tokenizer())
    with mock.patch.multiple(K, WORDS_KEPT=kept, PIECES_KEPT=kept):
        for text in ["one two \u4e2d\u6587 three", "two three\u4e2d four", *(r[1] or "" for r in rows)]:
            assert known.ids(text.encode().split())[0].tolist() == whole(text)


def test_word_array():
    texts = ["", "a b", "c", None, " d\te\n", "\u00e9\u00a0f", "", "  ", *_drawn(3, 200, "ab \t\n\x0b\x1c\u00e9"), None]
    for given in (texts, texts[1:2], [None], [], ["ab", "cd"]):
        seen = []
        for most in (1, 7, 1 << 20):
            found = []
            for _, data, offsets in W.slices(pa.array(given, pa.string()), most):
                words, ends = W.word_array(data, offsets)
                words = words.to_pylist()
                assert (words, ends.tolist()) == (lambda w, e: (w, e.tolist()))(*W.split_words(data, offsets))
                found += [words[a:b] for a, b in zip(ends[:-1], ends[1:])]
            seen.append(found)
        assert seen == [[(t or "").encode().split() for t in given]] * 3


@pytest.mark.parametrize("length", [4096, 64])
def test_packing_round_trip(docs, rows, whole, length):
    pieces = P.pack(docs, length=length).collect()
    seen = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    at = 0
    for s, o, n in seen:  # gapless
        assert (s, o) == divmod(at, length) and 0 < n <= length - o
        at += n
    stream = np.zeros(at, np.uint32)
    documents = {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length
        stream[p.sequence_id * length + p.offset :][: p.length] = ids
        documents.setdefault((p.doc_id, p.sequence_id * length + p.offset - p.start), []).append((p.start, p.length, p.doc_tokens))
    assert len(documents) == len(rows)
    expected = sorted(((r[0], tuple([*whole(r[1]), 2])) for r in rows), key=str)
    found = []
    for (doc_id, begin), parts in documents.items():
        assert sum(n for _, n, _ in parts) == parts[0][2]
        found.append((doc_id, tuple(stream[begin : begin + parts[0][2]].tolist())))
    assert sorted(found, key=str) == expected


def test_digest(docs):
    pieces = P.pack(docs.where("doc_id < 10")).cache()
    sums = {(r.doc_id, r.start, r.sequence_id, r.offset): r.ids_crc32 for r in P.digest(pieces).collect()}
    for p in pieces.collect():
        assert sums[p.doc_id, p.start, p.sequence_id, p.offset] == zlib.crc32(bytes(p.ids))


def test_no_documents(no_docs):
    assert P.pack(no_docs).count() == 0 and T.counted(no_docs).count() == 0


def _totals(rollup):
    return {(r.source, r.lang, r.tokenizer_version): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


def _recount(rows, whole, version="v1", extra=0):
    out = {}
    for doc_id, text, lang, source, *_ in rows:
        n, t = out.get((source, lang, version), (0, 0))
        out[source, lang, version] = (n + 1, t + len(whole(text)) + extra)
    return out


def test_rollup_follows_changes(spark, docs, rows, whole):
    counted = T.counted(docs).withColumn("tokenizer_version", F.lit("v1")).cache()
    rollup = T.Rollup(spark, fresh_path(spark, "test-rollup"))
    assert _totals(rollup) == {}
    assert rollup.commit("1", T.inserts(counted)) and not rollup.commit("1", T.inserts(counted))
    assert _totals(rollup) == _recount(rows, whole)
    gone = F.col("doc_id") % 2 == 0
    assert rollup.commit("2", T.deletes(counted.where(gone))) and not rollup.commit("2", T.deletes(counted.where(gone)))
    left = [r for r in rows if r[0] is None or r[0] % 2]
    assert _totals(rollup) == _recount(left, whole)
    late = counted.where("doc_id % 2 = 1 and doc_id > 50")
    rollup.commit("3", T.revisions(late, late.withColumns({"tokenizer_version": F.lit("v2"), "n_tokens": F.col("n_tokens") + 1})))
    old, new = [r for r in left if r[0] is None or r[0] <= 50], [r for r in left if r[0] is not None and r[0] > 50]
    assert _totals(rollup) == {**_recount(old, whole), **_recount(new, whole, "v2", 1)}
    assert rollup.commit("4", T.inserts(counted.where("false"))) and not rollup.commit("4", T.inserts(counted))


def test_op8_counts_the_whole_table(spark, sf001, whole):
    expected = {}
    for r in spark.read.parquet(f"{sf001}/documents.parquet").collect():
        n, t = expected.get((r.source, r.lang, "word_bpe_49k"), (0, 0))
        expected[r.source, r.lang, "word_bpe_49k"] = (n + 1, t + len(whole(r.text)))
    got = {(r.source, r.lang, r.tokenizer_version): (r.n_docs, r.n_tokens) for r in T.op8_token_counts(spark, sf001).collect()}
    assert got == expected


def test_broken_batch_is_written_again(spark, docs, rows, whole):
    counted = T.counted(docs).withColumn("tokenizer_version", F.lit("v1"))
    rollup = T.Rollup(spark, fresh_path(spark, "test-rollup"))
    rollup.commit("1", T.inserts(counted.where("doc_id < 5")))
    fs, mark = rollup._hadoop(f"{rollup.path}/batch=1/_SUCCESS")
    fs.delete(mark, False)  # as if the writing had broken off
    assert _totals(rollup) == {}
    assert rollup.commit("1", T.inserts(counted)) and _totals(rollup) == _recount(rows, whole)
