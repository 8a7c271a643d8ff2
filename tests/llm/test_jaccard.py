import random
from collections import Counter

import numpy as np
import pytest
from sonora.llm import jaccard_join as J


def shingles(text, width=3):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset()


def joined(texts, percent, width=3):
    """Of each text: the size of its set, the places in its component, and how many other texts it links to."""
    sets = [shingles(t, width) for t in texts]
    up, links = list(range(len(sets))), [0] * len(sets)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i] += 1
                links[j] += 1
                up[find(i)] = find(j)
    places = {}
    for k in range(len(sets)):
        places.setdefault(find(k), []).append(k)
    return [(len(s), places[find(k)], links[k]) for k, s in enumerate(sets)]


def expected(ids, texts, percent=90, width=3):
    out = []
    for k, (n, places, links) in enumerate(joined(texts, percent, width)):
        known = [ids[p] for p in places if ids[p] is not None]
        out.append((ids[k], n, min(known, default=None), links))
    return Counter(out)


def test_documents(docs, rows):
    want = expected([r[0] for r in rows], [r[1] for r in rows])
    assert Counter(tuple(r) for r in J.jaccard_join(docs, count_links=True).collect()) == want
    assert max(n for *_, n in want) > 10


def families():
    """Chains of copies that drift away from each other, around every bound of the sizes."""
    rng = random.Random(12)
    texts = [None, "", " ", "a", "a b", "A  B", "a b c", "a b c d"]
    for length in (9, 11, 12, 13, 21, 40, 100):
        words = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        for _ in range(12):
            texts.append(" ".join(words))
            k = rng.randrange(len(words))
            words = rng.choice([words[:k] + ["new"] + words[k:], words[:k] + words[k + 1 :], words[:k] + [f"x{rng.random()}"] + words[k + 1 :], words + words[:2], words[:-1]])
    return texts


@pytest.mark.parametrize("percent, width, chunk", [(90, 3, 2), (75, 2, 1024)])
def test_families(spark, monkeypatch, percent, width, chunk):
    monkeypatch.setattr(J, "CHUNK_SETS", chunk)
    texts = families()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = expected(range(len(texts)), texts, percent, width)
    assert Counter(tuple(r) for r in J.jaccard_join(docs, width, percent).collect()) == Counter(w[:3] for w in want.elements())
    if percent == 75:
        monkeypatch.setattr(J, "CHUNK_SETS", 3)
        assert Counter(tuple(r) for r in J.jaccard_join(docs, width, percent, count_links=True).collect()) == want


def test_no_documents(no_docs):
    assert J.jaccard_join(no_docs).count() == 0


@pytest.mark.parametrize("percent", [50, 75, 90, 99, 100])
def test_linked_sets_share_a_signature(percent):
    """At the worst: sets of linked sizes that differ in as many shingles as they may."""
    rng = np.random.default_rng(5)
    classes = J.SizeClasses(percent)
    for a in [*range(1, 60), 100, 333, 1000]:
        for b in range(a, 100 * a // percent + 1):
            least = -(-percent * (a + b) // (100 + percent))
            pool = np.unique(rng.integers(0, 1 << 64, a + b, np.uint64))
            rng.shuffle(pool)
            x, y = np.sort(pool[:a]), np.sort(np.concatenate([pool[:least], pool[a : a + b - least]]))
            if 100 * least >= percent * (a + b - least):
                assert set(classes.signatures(x).tolist()) & set(classes.signatures(y).tolist()), (a, b)


def test_products_drop_pairs_early(monkeypatch):
    """Pairs come out alike however many columns a block has; unlinked rows are left out of later blocks."""
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 1 << 64, 900, np.uint64))
    sets = [np.sort(rng.choice(base, n, replace=False)) for n in (880, 870, 860, 850, 450, 440, 30, 900 - 1)]
    side = np.zeros(len(sets), np.int8)
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 10 * len(np.intersect1d(sets[i], sets[j])) >= 9 * len(np.union1d(sets[i], sets[j]))}
    for columns in (64, 1024):
        monkeypatch.setattr(J, "COLUMNS", columns)
        assert set(zip(*(x.tolist() for x in J.linked_pairs(sets, side, 90)))) == want and want
