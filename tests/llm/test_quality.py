from collections import Counter

import numpy as np
import pytest
from sonora.llm import quality_classifier as C
from sonora.llm import quality_rules as R


def base(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    again = set()
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            again |= {k, k + 1, k + 2}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again)


def test_base_figures_and_verdicts(docs, labels, rows):
    model = R.train(docs, labels, sample_rows=500)
    out = R.quality_rules(docs.select("doc_id", "text"), model).select("doc_id", "text", "quality_rules.*").collect()
    assert len(out) == len(rows)
    for r in out:
        n, chars, symbols, dup, again = base(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, again)
        assert r.base_failed == (n < 50 or 100 * again > 50 * n)
        assert r.kept == (not r.base_failed and r.probability >= R.LEAST_PROBABILITY)
    kept = {r.doc_id: r.kept for r in out}
    assert not any(kept[k] for k in range(0, 60, 7))
    assert sum(kept[k] for k in range(60) if k % 7) >= 48


def test_rules_without_labels_or_rows(docs, no_docs, no_labels, labels):
    model = R.train(docs, no_labels)
    out = R.quality_rules(docs.select("doc_id", "text"), model).select("quality_rules.*").collect()
    assert all(r.kept == (not r.base_failed) for r in out)
    assert R.quality_rules(no_docs.select("doc_id", "text"), R.train(no_docs, labels)).count() == 0


def test_repeated_rows_do_not_fill_the_sample(spark):
    texts = [f"good clean words number w{k} " * 15 if k % 2 else f"### bad $$$ junk {k} " * 15 for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], "doc_id long, quality int, toxic int")
    docs = lambda times: spark.createDataFrame([(k, t) for k, t in enumerate(texts) for _ in range(times if k == 7 else 1)], "doc_id long, text string").repartition(3)
    once, often = (R.train(docs(times), labels, sample_rows=60) for times in (1, 400))
    assert np.allclose(once.weights, often.weights) and np.isclose(once.bias, often.bias) and np.isclose(once.slope, often.slope)
    rows = spark.createDataFrame([(1, 1.0, 0, "b"), (1, 1.0, 0, "a"), (1, 1.0, 0, None), (2, 0.0, 1, None)], "doc_id long, y double, fold long, text string")
    assert sorted((r.doc_id, r.text) for r in R.one_text_each(rows).collect()) == [(1, "a"), (2, None)]


def test_rules_keep_clashing_columns(docs, labels):
    out = R.quality_rules(docs, R.train(docs, labels, sample_rows=500), into="verdict")
    assert out.columns == [*docs.columns, "verdict"] and out.where("kept = 'y'").count() == docs.count()


def test_held_out_quality(spark, sf001):
    out = C.op10_quality_classifier(spark, sf001).join(spark.read.parquet(f"{sf001}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in out]) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_classifier_cases(docs, no_docs, labels, no_labels, rows):
    out = C.quality_classifier(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add((r.score, r.predicted, r.held_out))
    assert len(by[3]) == 1 and not any(h for _, _, h in by[None])
    assert {r.score for r in C.quality_classifier(docs, no_labels).collect()} == {0.5}
    assert C.quality_classifier(no_docs, labels).count() == 0


def test_pooling_is_isotonic():
    x = np.arange(6.0)
    at, level = C.pool_adjacent(x, np.array([0.0, 2, 1, 1, 4, 4]), np.full(6, 4.0))
    assert (np.diff(level) > 0).all() and level[0] == 0 and level[-1] == 1 and (np.diff(at) > 0).all()


def test_logistic_separates():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 200).astype(float)
    rows = np.array([[0, 1 + int(k)] for k in y], np.int32)
    w, b = R.fit_logistic(rows.ravel(), np.ones(400, np.float32), np.full(200, 2), y, 3)
    margin = w[rows].sum(1) + b
    assert ((margin > 0) == (y > 0)).all()
    assert R.fit_platt(margin, y)[0] > 0


@pytest.mark.parametrize("text", ["a b a b a b", "a b c", "", "x " * 9, "p q r p q r s"])
def test_repeated_windows(text):
    from sonora.llm import words as W

    words = text.encode().split()
    names = W.Vocabulary()
    ids = names.ids(words)
    assert W.repeated_window_words(ids, len(names)) == base(text)[4]
    assert W.repeated_window_words(ids, 1 << 40) == base(text)[4]
