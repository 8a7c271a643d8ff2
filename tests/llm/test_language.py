import zlib
from collections import Counter

from sonora.llm import language_id as L


def brute_counts(text):
    found = Counter()
    for w in L._LETTERS.findall((text or "").lower()):
        marked = f" {w} "
        found.update(w)
        found.update(marked[k : k + n] for n in (2, 3) for k in range(len(marked) - n + 1))
    return found


def code(gram):
    return sum(ord(c) << (42 - 21 * k) for k, c in enumerate(gram))


def ranked(counts, size=L.PROFILE_SIZE):
    return [c for c, _ in sorted(((code(g), n) for g, n in counts.items()), key=lambda x: (-x[1], x[0]))[:size]]


def test_matches_brute_force(docs, rows):
    learned = {}
    for doc_id, text, lang, *_ in rows:
        if doc_id is not None and lang is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5:
            learned.setdefault(lang, Counter()).update(brute_counts(text))
    profiles = {lang: {c: k for k, c in enumerate(ranked(n))} for lang, n in sorted(learned.items())}
    out = L.language_id(docs).collect()
    assert len(out) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        own = ranked(brute_counts(texts[r.doc_id]))
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        away = {lang: sum(abs(p[c] - k) if c in p else L.PROFILE_SIZE for k, c in enumerate(own)) for lang, p in profiles.items()}
        best = min(away, key=away.get)
        assert r.lang_pred == best and abs(r.score - (1 - away[best] / len(own) / L.PROFILE_SIZE)) < 1e-12


def test_nothing_learned(docs, no_docs):
    from pyspark.sql import functions as F

    out = L.language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("und", 0.0)}
    assert L.language_id(no_docs).count() == 0


def test_letters(spark):
    assert L.count_words("x² ½ Ⅷ ① ²b³c² 12 一二 x") == Counter({"x": 2, "b": 1, "c": 1, "一二": 1})
    docs = spark.createDataFrame([(1, "plain words here", "en"), (2, "² ½ Ⅷ ① 12 _", "en")], "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in L.language_id(docs).collect()}[2] == "und"


def test_profile_of_many_grams(spark):
    """More n-grams than a profile holds: the commonest, ties by code, whatever part they fall in."""
    docs = spark.createDataFrame([(k, " ".join(chr(0x4E00 + j) for j in range(k, 700)), "zh") for k in range(1, 12)], "doc_id long, text string, lang string")
    found = Counter()
    for k in range(1, 12):
        if zlib.crc32(str(k).encode()) % 5:
            found.update(brute_counts(" ".join(chr(0x4E00 + j) for j in range(k, 700))))
    assert L.train(docs)["zh"].tolist() == ranked(found)


def test_held_out_accuracy(spark, sf001):
    out = L.op4_language_id(spark, sf001).join(spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in out) / len(out) > 0.9
