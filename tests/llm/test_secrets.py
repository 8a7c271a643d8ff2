import base64
import hashlib
import math
import random
import re
import string
import uuid
import zlib
from collections import Counter
from functools import lru_cache

import pytest
from pyspark.sql import functions as F
from sonora.llm import secret_scan as S

ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]


def names(word):
    number = str(zlib.crc32(word.encode()) % 10000)
    return [*(sep + word + sep for sep in "_-/="), word + word.capitalize(), f"_{word.upper()}_", f"{word}_{number}-", f"{number}_{word}"]


def table(samples, identifiers):
    """The log ratio of two characters: random against the likeliest ordinary model."""
    pairs = {}
    for kind, token in [*(("random" if random else "word", t) for t, random in samples), *(("name", n) for t, random in samples if not random for n in names(t)), *(("id", t) for t in identifiers)]:
        of = pairs.setdefault(kind, {})
        for a, b in zip(token, token[1:]):
            of.setdefault(a, Counter())[b] += 1

    def log(kind, a, b):
        row = pairs[kind].get(a, Counter())
        return math.log((row[b] + S.PRIOR / S.ALPHABET**2) / (sum(row.values()) + S.PRIOR))

    return lru_cache(None)(lambda a, b: log("random", a, b) - max(log(kind, a, b) for kind in pairs if kind != "random"))


def learned(docs):
    return table([(r.token, r.random) for r in S.labelled_samples(docs).collect()], [r.token for r in S.identifier_samples(docs).collect()])


def stretches(run, ratio):
    """Each stretch from the last fresh start to the peak of its sum."""
    found, start, total, peak, end = [], 0, 0.0, 0.0, 0
    for i in range(len(run)):
        x = ratio(run[i], run[i + 1]) if i + 1 < len(run) else -math.inf
        if total + x <= 0 or peak - (total + x) >= S.LEAST_RATIO:
            if peak >= S.LEAST_RATIO and end - start >= S.LEAST_KEY:
                found.append((start, end))
            start, total, peak = i + 1, 0.0, 0.0
        else:
            total += x
            if total > peak:
                peak, end = total, i + 2
    return found


def spans(text, ratio):
    found = base(text)
    for m in re.finditer("[A-Za-z0-9+/_=-]{16,}", text):
        for a, b in stretches(m[0], ratio):
            a, b = m.start() + a, m.start() + b
            while not text[a].isalnum():
                a += 1
            while not text[b - 1].isalnum():
                b -= 1
            while a > m.start() and text[a - 1].isalnum():
                a -= 1
            while b < m.end() and text[b].isalnum():
                b += 1
            while b < m.end() and text[b] == "=":
                b += 1
            found.append((a, 3, b))
    return sorted({s for s in found if s[1] == 3} | set(found))


@pytest.fixture(scope="module")
def samples(docs):
    return S.labelled_samples(docs).cache()


def test_matches_brute_force(docs):
    ratio = learned(docs)
    out = S.secret_scan(docs, S.trained(docs)).collect()
    assert len(out) == docs.count()
    kinds = set()
    for r in out:
        expected = spans(r.text or "", ratio)
        assert [(s["start"], s["place"], s["end"]) for s in r.secrets] == expected
        kinds |= {s["kind"] for s in r.secrets}
    assert kinds == set(S.KINDS)


LETTERS = string.ascii_letters + string.digits


def planted(rng, words):
    """Keys that no pattern names, alone and inside names, and ordinary identifiers; each in a sentence of its own."""
    key = lambda n: "".join(rng.choice(LETTERS) for _ in range(n))
    word = lambda: rng.choice(words)
    alone = [key(rng.randint(20, 44)) for _ in range(100)] + [base64.b64encode(rng.randbytes(24)).decode() for _ in range(50)]
    inside = [(f"{word()}/{word()}_", key(rng.randint(24, 40)), f"/{word()}-{word()}") for _ in range(100)]
    ordinary = [f"{rng.getrandbits(n)}" for n in (60, 64, 80, 128) for _ in range(25)] + ["0" * 24]
    ordinary += [str(uuid.UUID(int=rng.getrandbits(128))) for _ in range(100)]
    ordinary += [sep.join(word() for _ in range(5)) for sep in "_-/" for _ in range(40)] + ["_".join(word().upper() for _ in range(4)) for _ in range(40)]
    ordinary += ["".join(word().capitalize() for _ in range(4)) for _ in range(40)]
    ordinary += [f"{word()}/{word()}/20{rng.randint(10, 30)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}/{word()}_{rng.randint(1, 99999)}" for _ in range(40)]
    return alone, inside, ordinary


def test_planted_keys_and_ordinary_identifiers(spark, sf001):
    docs = spark.read.parquet(f"{sf001}/documents.parquet").select("doc_id", "text")
    rng = random.Random(9)
    words = sorted({w.lower() for r in docs.limit(200).collect() for w in re.findall("[A-Za-z]{4,9}", r.text or "")})
    alone, inside, ordinary = planted(rng, words)
    cases = [(k, "see ", "", x, "", True) for k, x in enumerate(alone)] + [(1000 + k, "see ", a, x, b, True) for k, (a, x, b) in enumerate(inside)]
    cases += [(2000 + k, "see ", "", x, "", False) for k, x in enumerate(ordinary)]
    texts = spark.createDataFrame([(k, lead + a + x + b + " for more", x) for k, lead, a, x, b, _ in cases], "doc_id long, text string, x string")
    found = {r.doc_id: [s for s in r.secrets if s["kind"] == "markov"] for r in S.secret_scan(texts, S.trained(docs)).collect()}
    covered = lambda k, lead, a, x: any(s["start"] <= len(lead + a) and s["end"] >= len(lead + a + x) for s in found[k])
    recall = {part: [covered(k, lead, a, x) for k, lead, a, x, _, _ in cases if k // 1000 == part] for part in (0, 1)}
    tight = [len(lead + a) - 1 <= s["start"] and s["end"] <= len(lead + a + x) + 1 for k, lead, a, x, _, _ in cases if k // 1000 == 1 for s in found[k]]
    false = [x for k, _, _, x, _, key in cases if not key and found[k]]
    print("recall", {p: sum(v) / len(v) for p, v in recall.items()}, "tight", sum(tight) / len(tight), "false", len(false) / len(ordinary), false[:10])
    assert all(sum(v) >= 0.9 * len(v) for v in recall.values())
    assert sum(tight) >= 0.8 * len(tight)  # the name around a key stays
    assert len(false) <= 0.02 * len(ordinary), false


def test_digest_columns(spark, sf001):
    out = S.op2_secret_scan(spark, sf001).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    for r in out:
        expected = sorted(base(texts[r.doc_id] or ""))
        joined = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in expected)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, k, _ in expected) for kind in range(3))
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_many_matches_and_masking(spark):
    text = "é " + " ".join(f"token={k:09d} {k:032x}" for k in range(400)) + " end"
    docs = spark.createDataFrame([(1, text, "keep"), (2, "nothing", None), (3, None, "z")], "doc_id long, text string, _text string")
    found = {r.doc_id: r.secrets for r in S.secret_scan(docs, None).collect()}
    assert [(s["start"], s["place"], s["end"]) for s in found[1]] == sorted(base(text)) and found[2] == found[3] == []
    out = {r.doc_id: r for r in S.masked(docs, None).collect()}
    merged, end = "", 0
    for a, _, b in sorted(base(text)):
        merged += text[end:a] + S.MASK if a >= end else ""
        end = max(end, b)
    assert out[1].text == merged + text[end:] and out[1]["_text"] == "keep"
    assert out[2].text == "nothing" and out[3].text is None
    assert S.masked(docs, None).columns == docs.columns


def test_running_totals(spark):
    values = [[], [3], list(range(300)), [5] * 1000, list(range(40000))]
    got = spark.createDataFrame([(v,) for v in values], "v array<int>").select(S._running(F.col("v"), lambda a, b: a + b, F.lit(0)).alias("s")).collect()
    import itertools

    assert [r.s for r in got] == [list(itertools.accumulate(v)) for v in values]


def test_all_documents_train_the_model(spark):
    rows = [(k % 1500, f"rare{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}zq word") for k in range(3000)] + [(None, "ofnoid")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    samples = S.labelled_samples(docs).collect()
    assert Counter(r.token for r in samples if not r.random) == Counter(w for _, t in rows for w in t.split())
    assert sum(r.random for r in samples) == 4 * 1501


def test_no_python_on_the_main_path(docs, samples):
    plan = S.masked(S.secret_scan(docs, S.train(samples)).drop("secrets"), None)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_nothing_to_learn(no_docs):
    assert S.train(S.labelled_samples(no_docs)) is None and S.secret_scan(no_docs, None).count() == 0
