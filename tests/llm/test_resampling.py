import hashlib
import math
import random
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F
from sonora.llm import target_resampling as R
from sonora.llm.shared import saved

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    return len(words), [crc32(" ".join(words[k : k + n]).encode()) % 10000 for n in (1, 2, 3) for k in range(len(words) - n + 1)]


def resampled(docs, target, percent=5):
    cut = [(d, *features(t)) for d, t in docs]
    counts = []
    for lists in ([f for *_, f in cut], [features(t)[1] for t in target]):
        n = [0] * 10000
        for f in lists:
            for b in f:
                n[b] += 1
        counts.append(n)
    s, t = counts
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    out = []
    for d, n, f in cut:
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    order = sorted((k for k, o in enumerate(out) if o[1] >= 20), key=lambda k: (-out[k][4], out[k][0] is None, out[k][0] or 0, out[k][2]))
    rank = {k: i + 1 for i, k in enumerate(order[: percent * len(order) // 100])}
    return sorted(((o[0], *o[2:], rank.get(k)) for k, o in enumerate(out)), key=str)


@pytest.mark.parametrize("percent", [5, 40, 100, 0])
def test_documents(spark, docs, rows, percent):
    target = [rows[7][1], rows[9][1][:200], None, ""]
    want = resampled([r[:2] for r in rows], target, percent)
    got = R.resampled(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_empty_tables(spark, docs, rows, no_docs):
    assert R.resampled(no_docs, docs).count() == 0
    got = R.resampled(docs, no_docs)
    assert sorted((tuple(r) for r in got.collect()), key=str) == resampled([r[:2] for r in rows], [])


@pytest.mark.parametrize("wanted", [1, 333, 501])
def test_ranks_by_bisection(spark, wanted):
    """Many ties: in the first column, in the second, and between whole rows."""
    rng = random.Random(1)
    rows = [(rng.choice([-(1 << 40), -7, 0, 0, 0, 5]), rng.choice([3, 3, (1 << 63) - 1]), k) for k in range(500)]
    table = saved(spark.createDataFrame(rows, "a long, b long, c long").repartition(5), "ranks")
    got = {r.c: r["rank"] for r in R.ranked(table, F.col("c") >= 0, wanted, ["a", "b", "c"]).collect()}
    want = {r[2]: k + 1 if k < wanted else None for k, r in enumerate(sorted(rows))}
    assert got == want


def test_op13(spark, sf001):
    docs, target = ([tuple(r) for r in spark.read.parquet(f"{sf001}/{t}.parquet").select(*c).collect()] for t, c in (("documents", ["doc_id", "text"]), ("benchmark", ["text"])))
    got = sorted((tuple(r) for r in R.op13_target_resampling(spark, sf001).collect()), key=str)
    assert got == resampled(docs, [t for t, in target])
    assert sum(r[-1] is not None for r in got) == 5 * sum(features(t)[0] >= 20 for _, t in docs) // 100
