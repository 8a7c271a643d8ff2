import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from sonora.llm import components as G
from sonora.llm import simhash_dedup as H
from sonora.llm import substring_dedup as B


def simhash(text, n=3):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[k : k + n]), 42) for k in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, most):
    up = {p: p for p in prints}

    def find(p):
        while up[p] != p:
            p = up[p]
        return p

    ordered = sorted(up)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= most:
                up[find(a)] = find(b)
    return {p: find(p) for p in up}


def test_components_of_documents(docs, rows):
    prints = [simhash(r[1]) for r in rows]
    root = roots(prints, 3)
    least = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[root[p]] = min(r[0], least.get(root[p], r[0]))
    expected = Counter((r[0], f"{p:016x}", least.get(root[p])) for r, p in zip(rows, prints))
    assert Counter(tuple(r) for r in H.simhash_dedup(docs).collect()) == expected
    one = H.one_of_each(docs)
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.where("doc_id is not null").collect()) == sorted(set(least.values()))


def test_no_documents(no_docs):
    assert H.simhash_dedup(no_docs).count() == 0 and H.one_of_each(no_docs).count() == 0 and B.substring_dedup(no_docs).count() == 0


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (4, None), (2, "")], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.component_id)) for r in H.simhash_dedup(docs).collect()) == [("2", "2"), ("4", "2"), ("None", "None"), ("None", "None")]
    assert H.one_of_each(docs).count() == 2


@pytest.mark.parametrize("limit", [4, 2048])
def test_links_of_clustered_fingerprints(spark, limit):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(300)]
    prints += [prints[0] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)]
    prints += [prints[1] ^ rng.getrandbits(9) for _ in range(200)]
    chain = prints[2]
    for k in range(0, 60, 3):
        chain ^= 7 << k
        prints.append(chain)
    prints = sorted(set(prints) | {0, 1, (1 << 64) - 1})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    found = H.links(frame, 3, limit)
    near = {(r.a % (1 << 64), r.b % (1 << 64)) for r in found.collect()}
    linked = G.components(found)
    got = {r.node % (1 << 64): r.root % (1 << 64) for r in linked.collect()}
    root = roots(prints, 3)
    groups, expected = {}, {}
    for p in prints:
        groups.setdefault(got.get(p, p), set()).add(p)
        expected.setdefault(root[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
    assert all(root[a] == root[b] for a, b in near)


def test_gray_rank_sorts_a_gray_code():
    codes = np.array([k ^ (k >> 1) for k in range(64)], np.uint64)
    assert H.gray_rank(codes).tolist() == list(range(64))


def test_star_rounds(spark):
    pairs = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (200, 200), (7, 300)]
    got = {r.node: r.root for r in G.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 41)}, 300: 0, 101: 100}
    assert G.components(spark.createDataFrame([], "a long, b long")).count() == 0


def kept(texts, window):
    words = [(t or "").encode().split() for t in texts]
    times = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if times[tuple(w[k : k + window])] > 1:
                gone |= set(range(k, k + window))
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


@pytest.mark.parametrize("most", [2, 256])
def test_substring_dedup(docs, rows, most):
    expected = Counter(zip((r[0] for r in rows), *zip(*kept([r[1] for r in rows], B.WINDOW))))
    assert Counter(tuple(r) for r in B.substring_dedup(docs, most_segments=most).collect()) == expected


@pytest.mark.parametrize("most", [1, 3, 256])
def test_overlapping_repeats(spark, most):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(30)] + ["a " * 50, "a b " * 30, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in B.substring_dedup(docs, window=9, anchor_words=3, most_segments=most).collect()}
    assert [out[k] for k in range(len(texts))] == kept(texts, 9)


def test_shards_bounded_by_their_words(spark):
    """Periodic texts have one anchor: a single segment beyond the bound goes by windows, and copies count once."""
    texts = ["a " * 400, "a b " * 90, "x " + "a " * 30] + ["c d e f " * 40] * 50 + ["q " + "c d e f " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in B.substring_dedup(docs, window=9, anchor_words=3, most_words=50).collect()}
    assert [out[k] for k in range(len(texts))] == kept(texts, 9)
    assert B.spans(B.with_text_keys(docs), 9, 3).count() == 5


def test_automaton_counts():
    rng = random.Random(2)
    for _ in range(40):
        sequences = [[rng.randrange(3) for _ in range(rng.randint(1, 30))] for _ in range(6)]
        copies = [rng.randint(1, 2) for _ in sequences]
        a = B.SuffixAutomaton()
        for s, n in zip(sequences, copies):
            a.add(s, n)
        a.close()
        times = Counter()
        for s, n in zip(sequences, copies):
            for k in range(len(s) - 4):
                times[tuple(s[k : k + 5])] += n
        for s in sequences:
            assert a.repeated(s, 5) == [times[tuple(s[k : k + 5])] > 1 for k in range(len(s) - 4)]


def test_checksum_query(spark, sf001):
    texts = spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text").collect()
    expected = {t.doc_id: (n, gone, hashlib.sha256(k.encode()).hexdigest()) for t, (n, gone, k) in zip(texts, kept([t.text for t in texts], 35))}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in B.op6_substring_dedup(spark, sf001).collect()} == expected
