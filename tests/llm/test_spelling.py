import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from sonora.llm import spelling_variants as V

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    """The distance table, stopped nowhere."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1] == 1


def variants(docs, least_length=6, least_count=5, every=199, ratio=5):
    n = Counter()
    for doc_id, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOW)
            h = crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += len(w) >= least_length
    n = {w: k for w, k in n.items() if k >= least_count}
    near, gaps = {w: set() for w in n}, {}
    for w in n:
        for k in range(len(w)):
            gaps.setdefault((w[:k], w[k + 1 :]), set()).add(w)
            if w[:k] + w[k + 1 :] in n:
                near[w].add(w[:k] + w[k + 1 :])
                near[w[:k] + w[k + 1 :]].add(w)
    for words in gaps.values():
        for w in words:
            near[w] |= words - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n}


def found(docs, **params):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in V.spelling_variants(docs, **params).collect()}


def texts():
    rng = random.Random(9)
    out = []
    base = ["".join(rng.choice("abcdeàÿ×") for _ in range(rng.randint(6, 14))) for _ in range(12)] + ["aaaaaa", "abababab"]
    for w in base:
        times = 900
        while times > 3:  # chains of edits, each rarer
            out += [w.upper() if w.isascii() and rng.random() < 0.2 else w] * times
            k = rng.randrange(len(w))
            w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abcÿ") + w[k:], w[:k] + rng.choice("abcà") + w[k + 1 :]])
            times //= rng.choice([2, 6])
    out += ["a" * 300, "a" * 301, "a" * 299 + "b"] * 5
    rng.shuffle(out)
    return [(k % 40, " .,-1".join(out[k::60])) for k in range(60)] + [(None, "Straße ÀÉÿþabc \U0001f600garçon's"), (None, None), (3, ""), (4, "x" * 6 + "Āabcdef­ghijkl")]


@pytest.mark.parametrize("limit", [3, 2048])
def test_variants(spark, limit):
    rows = texts()
    want = variants(rows, every=7)
    assert sum(v[2] is not None for v in want.values()) > 5 and any(v[4] not in (v[2], w) for w, v in want.items())
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    assert found(docs, slip_every=7, block_limit=limit) == want


def test_documents(docs, rows):
    assert found(docs, least_count=1) == variants([r[:2] for r in rows], least_count=1)


def test_no_documents(no_docs):
    assert V.spelling_variants(no_docs).count() == 0


def test_near_places_over_several_tiles(monkeypatch):
    monkeypatch.setattr(V, "TILE", 8)
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 5))) for _ in range(150)})
    block = np.sort(np.array([rng.randrange(4) for _ in words]))
    got = {frozenset(p) for p in zip(*(x.tolist() for x in V.near_places([w.encode() for w in words], block)))}
    want = {frozenset((i, j)) for i in range(len(words)) for j in range(i) if block[i] == block[j] and one_edit(words[i], words[j])}
    assert got == want
