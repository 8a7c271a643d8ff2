import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from sonora.llm import mixing as M


def brute_sainte_lague(weights, seats, caps):
    got = [0] * len(weights)
    for _ in range(seats):
        open_ = [k for k in range(len(weights)) if got[k] < caps[k] and weights[k] > 0]
        if not open_:
            break
        got[max(open_, key=lambda k: (weights[k] / (2 * got[k] + 1), -k))] += 1
    return got


def test_sainte_lague():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = int(rng.integers(1, 9))
        weights, caps = rng.integers(0, 40, n), rng.integers(0, 30, n)
        seats = int(rng.integers(0, 80))
        assert M.sainte_lague(weights, seats, caps).tolist() == brute_sainte_lague(weights.tolist(), seats, caps.tolist())


def test_targets_share_the_excess():
    got = M.targets(pd.DataFrame({"size": [10, 100, 1000]}), 1.5, 2, (3.0, 1.0, 2.0)).tolist()
    assert got[0] == 20 and got[1] == 200 and math.isclose(got[2], 1665 - 220)
    assert M.targets(pd.DataFrame({"size": [0, 0]}), 1.5, 2, (3.0, 1.0)).tolist() == [0, 0]


def test_mix_matches_its_documents(docs, rows):
    out = M.mix(docs).collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = dict(zip(order, M.targets(pd.DataFrame({"size": [sizes[s] for s in order]}), 1.5, 2, M.WEIGHTS)))
    source = {(r[0], len((r[1] or "").encode().split())): r[3] for r in rows if r[0] != 3}
    taken = dict.fromkeys(order, 0)
    for r in out:
        assert 0 <= r.taken <= 2 * r.size
        if r.doc_id != 3:
            s = source[r.doc_id, r.size]
            assert r.source_size == sizes[s] and math.isclose(r.target, expected[s])
            taken[s] += r.taken
    for s in ("b", "c"):
        assert abs(taken[s] - expected[s]) <= max(3, 0.03 * expected[s])
    assert sorted(map(str, out)) == sorted(map(str, M.mix(docs.repartition(5)).collect()))
    words = M.mixed_documents(docs).withColumn("n", M.word_count(F.col("text")))
    assert words.drop("n").columns == docs.columns
    got = {r.doc_id: r.n for r in words.groupBy("doc_id").agg(F.sum("n").alias("n")).collect()}
    by_id = {}
    for r in out:
        by_id[r.doc_id] = by_id.get(r.doc_id, 0) + r.taken
    assert {k: n for k, n in by_id.items() if n} == got


def test_partial_copies_are_the_documents_words():
    text = " ".join(f"w{k}" for k in range(100))
    for take, blocks, start, at in [(13, 20, 4, 7), (20, 20, 0, 0), (31, 20, 19, 55), (0, 20, 3, 10)]:
        got = M._copies(text, at, 100, 10, blocks, take, start)
        extra = [j for j in range(blocks) if (j + start + 1) * (take % blocks) // blocks > (j + start) * (take % blocks) // blocks]
        assert len(extra) == take % blocks
        part = [f"w{k}" for k in range(100) if (k + at) // 10 in extra]
        assert [t.split() for t in got] == [text.split()] * (take // blocks) + ([part] if part else [])


def test_a_small_source_changes_no_other_sources_blocks(spark):
    text = lambda k, n: " ".join(f"w{k}x{i}" for i in range(n))
    big = [(k, text(k, n + k % 7), s) for k in range(240) for s, n in (("b", 150), ("c", 190))]
    docs = lambda small: spark.createDataFrame(big + [(900, text(900, small), "a")], "doc_id long, text string, source string")
    for small in (5, 37, 300):
        places = M.placed(docs(small)).collect()
        assert {r.block for r in places} == {M.BLOCK_WORDS}
        target, got, whole = {}, {}, {(k, s): t.split() for k, t, s in big + [(900, text(900, small), "a")]}
        for r in M.mix(docs(small)).collect():
            target[r.source_size] = r.target
            got[r.source_size] = got.get(r.source_size, 0) + r.taken
        assert all(abs(got[s] - target[s]) <= 1 for s in target)
        cut = {}
        for r in M.mixed_documents(docs(small)).collect():
            words, all_words = r.text.split(), whole[r.doc_id, r.source]
            cut[r.source] = cut.get(r.source, 0) + len(words)
            at = [all_words.index(w) for w in words]
            assert at == sorted(set(at))
            # Runs begin and end with a block, the document, or the one cut of their shard.
            assert sum(b != a + 1 for a, b in zip(at, at[1:])) <= len(all_words) // M.BLOCK_WORDS + 1
        sizes = {s: sum(len(w) for (_, t), w in whole.items() if t == s) for s in "abc"}
        expected = dict(zip("abc", M.targets(pd.DataFrame({"size": list(sizes.values())}), 1.5, 2, M.WEIGHTS)))
        assert all(abs(cut[s] - expected[s]) <= 1 for s in "abc")


def test_quotas_of_shards_are_met_to_the_word():
    rng = np.random.default_rng(1)
    for words in [1, 5, 63, 64, 65, 100, 129, 640, 1000]:
        for quota in {0, 1, words - 1, words, words + 1, 2 * words, *rng.integers(0, 2 * words + 1, 5).tolist()}:
            group = pd.DataFrame({"number": [0], "shard": [0], "quota": [quota], "words": [words], "seeded": [int(rng.integers(-(1 << 60), 1 << 60))]})
            q = M._shard_quotas(2, 64)(group).iloc[0]
            take = int(q.copies * q.blocks + q.extra)
            ends = [0, *sorted(rng.integers(0, words + 1, 3).tolist()), words]
            got = [M._copies(" ".join(f"w{i}" for i in range(a, b)), a, b - a, 64, int(q.blocks), take, int(q.start), int(q.extra), int(q.once)) for a, b in zip(ends, ends[1:])]
            assert sum(len(t.split()) for ts in got for t in ts) == quota


def test_seats_of_shards_are_blocks():
    rng = np.random.default_rng(2)
    for _ in range(40):
        sizes = rng.integers(0, 60_000, int(rng.integers(1, 7)))
        plan = M.plan_sources(pd.DataFrame({"source": [chr(97 + k) for k in range(len(sizes))], "size": sizes}))
        assert np.abs(plan["quota"] - plan["target"]).max() <= 0.5 and (plan["quota"] <= 2 * sizes).all()
    for _ in range(60):
        words = rng.integers(0, 3000, int(rng.integers(1, 9)))
        total = int(rng.integers(0, 2 * words.sum() + 1))
        quota = M.in_blocks(words, total, 2 * words, 64)
        dealt = np.minimum(64 * np.array(brute_sainte_lague(words.tolist(), total // 64, (-(-2 * words // 64)).tolist())), 2 * words)
        assert quota.sum() == total and (0 <= quota).all() and (quota <= 2 * words).all()
        short = total - dealt.sum()
        assert np.abs(quota - dealt).sum() == abs(short) <= 64 * (1 + (dealt % 64 > 0).sum())
        if short < 64 and not (dealt % 64).any():
            assert ((quota % 64 > 0) & (quota < 2 * words)).sum() <= 1 + (quota == 2 * words).sum()


def test_shards_of_a_large_source_take_whole_blocks(spark):
    docs = spark.range(400).selectExpr("id doc_id", "repeat(concat('w', id, ' '), 300) text", "if(id < 380, 'a', 'b') source")
    rows = M.placed(docs, budget=0.4).where("source_size > 100000").select("shard", "extra", "once", "copies").distinct().collect()
    assert len(rows) > 1 and all(r.copies == 0 for r in rows)
    assert sum(r.once % 64 > 0 for r in rows) <= 1


def test_no_words(spark, no_docs):
    assert M.mix(no_docs).count() == 0 and M.mixed_documents(no_docs).count() == 0
    docs = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in M.mix(docs).collect()] == [(0, 0.0, 0)] * 2
    assert M.mixed_documents(docs).count() == 0


@pytest.mark.parametrize("texts", [["", "a", " a  b\n\tc ", None, "é x y"], [None], []])
def test_word_counts(texts):
    import pyarrow as pa
    from sonora.llm import words as W

    assert W.count_words(pa.array(texts, pa.string())).tolist() == [len((t or "").encode().split()) for t in texts]


def test_columns_of_any_type(spark):
    from sonora.llm.simhash_dedup import one_of_each

    docs = spark.createDataFrame([(1, "a b c " * 30, "s", {"k": 1}, [1.0]), (2, "d e f " * 30, None, None, None)], "doc_id long, text string, source string, `m.x` map<string,int>, v array<double>")
    docs = docs.unionByName(docs)
    assert M.mixed_documents(docs).columns == docs.columns and one_of_each(docs).count() == 2
    assert {r.doc_id for r in M.mixed_documents(docs, budget=1.0).collect()} == {1, 2}
