"""The five stages on the fixture, each one's written input against a plain version of its work."""
import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline as P
from sonora.llm import mixing as M
from sonora.llm import quality_classifier as C
from sonora.llm import quality_rules as R
from sonora.llm import secret_scan as S
from sonora.llm.shared import saved
from sonora.llm.tokens import default_tokenizer
from tests.llm import test_secrets
from tests.llm.test_quality import base


def words(text):
    return (text or "").encode().split()


def bucket(parts):
    h = 0
    for x, m in zip(parts, R._MIX):
        h = ((h ^ (x * int(m) & 0xFFFFFFFF)) * 0x27D4EB2F) & 0xFFFFFFFF
        h ^= h >> 15
    return h >> (32 - R.BITS)


def gram_counts(text):
    """For each block (word 1-, 2-grams, character 2-, 3-grams): how often each bucket is met."""
    crc, points = [zlib.crc32(w) for w in words(text)], [ord(c) for c in text or ""]
    return [Counter(bucket(seq[k : k + n]) for k in range(len(seq) - n + 1)) for seq, n in ((crc, 1), (crc, 2), (points, 2), (points, 3))]


def plain_margin(text, weights):
    return sum(sum(w[h] * n for h, n in found.items()) / max(1, sum(found.values())) for w, found in zip(weights, gram_counts(text)))


def fingerprint(text):
    own = [w.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")) for w in words(text)]
    grams = [b" ".join(own[k : k + 3]) for k in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_hashed_ngrams_and_margins_are_plain_counts(rows):
    texts = [r[1] for r in rows if len(r[1] or "") < 5000]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string()), "y": np.ones(len(texts)), "fold": np.zeros(len(texts), np.int64)})
    out = [r for b in R.features(iter([batch])) for r in b.to_pylist()]
    weights = np.random.default_rng(0).normal(size=(4, 1 << R.BITS))
    for text, r in zip(texts, out):
        want = {(b << R.BITS) + h: n / sum(found.values()) for b, found in enumerate(gram_counts(text)) for h, n in found.items()}
        got = dict(zip(np.frombuffer(r["at"], "<i4").tolist(), np.frombuffer(r["value"], "<f4").tolist()))
        assert got.keys() == want.keys() and np.allclose([got[k] for k in want], list(want.values()))
    from sonora.llm import words as W

    for first, data, offsets in W.slices(pa.array(texts, pa.string())):
        got = R.margins(R.grams(data, offsets, *W.split_words(data, offsets)), weights)
        assert np.allclose(got, [plain_margin(t, weights) for t in texts[first : first + len(got)]])


def test_normal_equations_against_a_dense_solve(docs, labels):
    figures = C.with_statistics(docs)
    model = C.train(figures, labels)
    votes = {}
    for r in labels.where("doc_id is not null and quality is not null").collect():
        votes.setdefault(r.doc_id, []).append(r.quality)
    known = [(r.x, float(np.mean(votes[r.doc_id]) >= 0.5), r.part) for r in figures.selectExpr("doc_id", "x", f"pmod(xxhash64({C.SEED}, doc_id), 5) part").collect()
             if r.doc_id in votes and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    x = np.array([k[0] for k in known])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.spread, np.maximum(x.std(0), 1e-6))
    u = np.clip((x - x.mean(0)) / np.maximum(x.std(0), 1e-6), -8, 8)
    z = np.array([[math.sqrt(2 / C.N_FEATURES) * math.cos(row @ model.directions[:, j] + model.phases[j]) for j in range(C.N_FEATURES)] + [1.0] for row in u])
    near = np.exp(-((u[:, None] - u[None]) ** 2).sum(2) / (2 * C.WIDTH**2))
    assert np.abs(z[:, :-1] @ z[:, :-1].T - near).mean() < 0.1
    fit = np.array([k[2] > 0 for k in known])
    y, ridge = np.array([k[1] for k in known])[fit], np.eye(C.N_FEATURES + 1)
    ridge[-1, -1] = 1e-6
    want = np.linalg.solve(z[fit].T @ z[fit] + C.RIDGE * fit.sum() * ridge, z[fit].T @ y)
    assert np.allclose(z @ model.weights, z @ want, atol=1e-6)


@pytest.fixture(scope="module")
def stages(spark, docs, labels, tmp_path_factory):
    """The tables' folder, and the rows that go into each stage and out of the last."""
    sf_dir = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    labels.write.parquet(f"{sf_dir}/labels.parquet")
    df, found = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (_, stage) in enumerate(P.STAGES):
        found.append(df)
        df = saved(stage(spark, df, sf_dir), f"test-stage-{k}")
    return sf_dir, [f.cache() for f in (*found, df)]


def test_quality_stage(spark, stages):
    sf_dir, (docs, kept, *_) = stages
    model = R.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = Counter()
    for r in docs.collect():
        n, _, _, _, again = base(r.text)
        if n >= 50 and 100 * again <= 50 * n and model.probability(np.array([plain_margin(r.text, model.weights)]))[0] >= R.LEAST_PROBABILITY:
            want[r] += 1
    assert Counter(kept.collect()) == want and kept.columns == docs.columns and 0 < sum(want.values()) < docs.count()


def test_near_dedup_stage(stages):
    before, after = stages[1][1].collect(), Counter(stages[1][2].collect())
    prints = [fingerprint(r.text) for r in before]
    root = list(range(len(before)))
    for a in range(len(before)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                old, new = root[a], root[b]
                root = [new if x == old else x for x in root]
    groups = {}
    for k, r in enumerate(before):
        groups.setdefault(root[k], []).append(r)
    assert sum(after.values()) == len(groups) < len(before)
    assert all(sum(after[r] for r in set(group)) == 1 for group in groups.values())


def test_secrets_stage(stages):
    before, after = stages[1][2], stages[1][3]
    ratio = test_secrets.learned(before)
    want = Counter()
    for r in before.collect():
        text, end = "", 0
        for a, _, b in test_secrets.spans(r.text, ratio):
            text += r.text[end:a] + S.MASK if a >= end else ""
            end = max(end, b)
        want[tuple(text + r.text[end:] if c == "text" else r[c] for c in before.columns)] += 1
    assert Counter(tuple(r) for r in after.collect()) == want


def test_mixing_stage(stages):
    before, after = stages[1][3].collect(), stages[1][4].collect()
    sizes, texts = Counter(), {}
    for r in before:
        sizes[r.source] += len(words(r.text))
        texts.setdefault((r.doc_id, r.source), []).append(r.text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, M.targets(pd.DataFrame({"size": [sizes[s] for s in order]}), 1.5, 2, M.WEIGHTS)))
    got = Counter()
    for r in after:
        got[r.source] += len(words(r.text))
        own = texts[r.doc_id, r.source]
        assert r.text in own or any(_in_order(words(r.text), words(t)) for t in own)
    assert all(abs(got[s] - target[s]) <= 1 for s in order)


def _in_order(part, whole):
    rest = iter(whole)
    return all(w in rest for w in part)


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    before, pieces = stages[1][4].collect(), stages[1][5].collect()
    ids = [(r.doc_id, [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in before]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    whole = Counter((d, len(x), crc(x)) for d, x in ids)
    uncut = Counter((r.doc_id, r.doc_tokens, r.ids_crc32) for r in pieces if r.length == r.doc_tokens)
    assert not uncut - whole and sum(r.length for r in pieces) == sum(len(x) for _, x in ids)
    assert Counter((r.doc_id, r.doc_tokens) for r in pieces if r.start == 0) == Counter((d, n) for d, n, _ in whole.elements())
    ends = Counter()
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends[r.sequence_id]
        ends[r.sequence_id] += r.length
    assert all(n == 4096 for s, n in ends.items() if s < max(ends)) and max(ends) == len(ends) - 1


def test_run_is_its_stages(spark, stages):
    sf_dir, (*_, last) = stages
    rows = lambda df: Counter((r.doc_id, r.doc_tokens) for r in df.collect() if r.start == 0)
    assert rows(P.run(spark, sf_dir)) == rows(last)


def test_run_on_empty_tables(spark, no_docs, no_labels, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    no_labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
