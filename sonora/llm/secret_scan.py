"""Secret scans with DataFrame functions only: fixed patterns, and Markov models of random strings.

Three kinds are found by pattern: assignments to a secret's name, access keys, and long hexadecimal runs. The
kind ``markov`` is found by first-order character models of random strings and of ordinary identifiers. Each
pair of neighbouring characters has a log-likelihood ratio, random against the likelier of three ordinary
models (words, names built from words, identifiers). In a run of 16 or more token characters every stretch is
reported whose ratios add up to ``LEAST_RATIO`` before they fall by as much again, if it has ``LEAST_KEY``
characters; separators at its ends are left out, and it is widened to the letters and digits that it touches and
to ``=`` behind them. So a key inside a long path or name is found, and the rest of the name mostly stays.

The models are counted from labelled samples, by default of all documents. Ordinary are their words of 4 to 15
characters, digits included (longer ones are what is to be judged), names joined from these words (``_``, ``-``,
``/``, ``=``, capitals, numbers), and numbers, dates and UUIDs of their distinct ids. Random are digests of the
ids, and the values that the fixed patterns find. Lower-case hexadecimal runs are as likely in a UUID as in a
key, so the kind ``hex`` decides on them, not the models.

A span is ``kind:start:end`` in code points, the end exclusive. Spans are sorted by start, then in the order of
the kinds. Patterns match leftmost and do not overlap within a kind; spans of different kinds may, and so may
widened ``markov`` spans. Whole texts are scanned, however long they are.

Defined cases: a null text counts as empty and has no spans (and stays null when masked). Repeated rows are
scanned each on its own. A null doc_id is carried, and counts as one id in training. Without samples no ``markov`` span is found. An empty
table gives an empty result; extra columns pass through or are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonora.llm.shared import table

KINDS = ["assign", "access", "hex", "markov"]
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{32,}",
    "markov": r"[A-Za-z0-9+/_=-]{16,}",
}
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16
#: The alphabet's size, the least ratio in nats, the least characters of a key, and the prior's weight in counts.
ALPHABET, LEAST_RATIO, LEAST_KEY, PRIOR, SEED = 67, 10.0, 12, 10.0, 3
MASK = "[SECRET]"
#: Values that one running total adds up before totals of blocks take over.
_BLOCK = 128


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), 0)


def _running(values: Column, combine: Callable[[Column, Column], Column], zero: Column, levels: int = 2) -> Column:
    """All inclusive running totals of an array: within blocks, and over the blocks' totals likewise.

    A value costs at most ``_BLOCK`` steps, plus n / 128**2 for each of the n / 128**2 totals of the last level.
    """
    total = lambda xs: F.aggregate(xs, zero, lambda a, b: combine(a, b))
    if not levels:
        return _let(values, lambda v: F.transform(v, lambda _, i: total(F.slice(v, F.lit(1), i + 1))))

    def blocks(v: Column) -> Column:
        n = F.floor((F.size(v) + (_BLOCK - 1)) / _BLOCK).cast("int")
        return F.when(F.size(v) == 0, F.array().cast("array<array<int>>")).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.slice(v, b * _BLOCK + 1, F.lit(_BLOCK))))

    def inside(cut: Column, before: Column) -> Column:
        base = lambda b: F.when(b > 0, F.get(before, b - 1)).otherwise(zero)
        return F.flatten(F.transform(cut, lambda xs, b: F.transform(xs, lambda _, i: combine(base(b), total(F.slice(xs, F.lit(1), i + 1))))))

    return _let(_let(values, blocks), lambda cut: _let(_running(F.transform(cut, total), combine, zero, levels - 1), lambda before: inside(cut, before)))


def _matches(rows: DataFrame, kind: str, may: Column) -> DataFrame:
    """``rows`` with all matches of a kind's pattern in ``kind``: start, kind's place, kind, end and the match."""
    pattern = F.lit(PATTERNS[kind])
    text, none = F.col("_text"), F.array().cast("array<string>")
    rows = rows.withColumn("_hit", F.when(may & F.rlike(text, pattern), F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"), F.split(text, PATTERNS[kind], -1).alias("p"))))
    rows = rows.withColumns({"_m": F.coalesce(F.col("_hit.m"), none), "_p": F.coalesce(F.col("_hit.p"), none)})
    rows = rows.withColumn("_step", F.transform("_m", lambda m, i: F.char_length(F.get("_p", i)) + F.when(i > 0, F.char_length(F.get("_m", i - 1))).otherwise(0)))
    rows = rows.withColumn("_at", _running(F.col("_step"), lambda a, b: a + b, F.lit(0)))
    span = lambda m, at: F.struct(at.alias("start"), F.lit(KINDS.index(kind)).alias("place"), F.lit(kind).alias("kind"), (at + F.char_length(m)).alias("end"), m.alias("match"))
    return rows.withColumn(kind, F.zip_with("_m", "_at", span)).drop("_hit", "_m", "_p", "_step", "_at")


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), F.ascii)


def _ids(docs: DataFrame, tokens: Callable[[Column, Column], list[Column]], seed: int) -> DataFrame:
    """``token`` of each distinct id, made from the id and its digest. Ids are few bytes but much work, so they are
    spread over all of the session's shuffle partitions."""
    ids = docs.select(F.col("doc_id").cast("string").alias("id")).distinct()
    ids = ids.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return ids.select(F.explode(F.array(*tokens(F.col("id"), F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("id")), 256)))).alias("token"))


def labelled_samples(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``token`` and ``random``: words and pattern matches of all documents, and digests of each distinct id."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    ordinary = texts.select(F.explode(F.regexp_extract_all("text", F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{4,15}(?![A-Za-z0-9+/_=-])"), F.lit(0))).alias("token"), F.lit(False).alias("random"))
    plain = lambda digest: F.base64(F.unhex(digest))
    random = _ids(docs, lambda _, digest: [digest, plain(digest), F.regexp_replace(plain(digest), "[+/=]", ""), F.upper(F.sha1(digest))], seed).withColumn("random", F.lit(True))
    found = texts.select(F.explode(F.concat(F.regexp_extract_all("text", F.lit(PATTERNS["hex"]), F.lit(0)), F.regexp_extract_all("text", F.lit(PATTERNS["access"].replace("+", "{12,}")), F.lit(0)))).alias("token"), F.lit(True).alias("random"))
    return ordinary.unionByName(random).unionByName(found)


def identifier_samples(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``token``: the id of each distinct id, and a long number, a date and a UUID made from it."""

    def forms(doc_id: Column, digest: Column) -> list[Column]:
        cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
        number = F.shiftrightunsigned(F.xxhash64(digest), 1)
        day = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), (number % 30000).cast("int")), "yyyy-MM-dd")
        return [F.coalesce(doc_id, F.lit("0")), number.cast("string"), day, F.concat_ws("-", *(F.substr(digest, F.lit(a), F.lit(n)) for a, n in cuts))]

    return _ids(docs, forms, seed)


def _names(word: Column) -> list[Column]:
    """Parts of names joined from words: separators on both sides, capitals, numbers beside separators."""
    number = (F.crc32(word.cast("binary")) % 10000).cast("string")
    joined = [F.concat(F.lit(sep), word, F.lit(sep)) for sep in "_-/="]
    return [*joined, F.concat(word, F.initcap(word)), F.concat(F.lit("_"), F.upper(word), F.lit("_")), F.concat(word, F.lit("_"), number, F.lit("-")), F.concat(number, F.lit("_"), word)]


def train(samples: DataFrame, identifiers: DataFrame | None = None) -> Column | None:
    """The log ratio of each pair of characters (128 x first + second) as an array literal; None without samples.

    A pair's probability under a model is (its count + ``PRIOR`` / ``ALPHABET``**2) over (the first character's count
    + ``PRIOR``), so that a model says next to nothing for characters that it has not met. Words are counted first, so that pairs are made of distinct words only; the
    driver gets at most four counts for each pair of the alphabet's characters.
    """
    words = samples.where(~F.col("random")).groupBy("token").count()
    form = lambda kind, token: F.struct(F.lit(kind).alias("kind"), token.alias("token"))
    tokens = words.select(F.explode(F.array(form("word", F.col("token")), *(form("name", t) for t in _names(F.col("token"))))).alias("f"), "count").select("f.kind", "f.token", "count")
    tokens = tokens.unionByName(samples.where("random").select(F.lit("random").alias("kind"), "token", F.lit(1).cast("long").alias("count")))
    if identifiers is not None:
        tokens = tokens.unionByName(identifiers.select(F.lit("id").alias("kind"), "token", F.lit(1).cast("long").alias("count")))
    two = F.transform(F.sequence(F.lit(1), F.char_length("token") - 1), lambda i: F.substr("token", i, F.lit(2)))
    pairs = tokens.where(F.char_length("token") > 1).select("kind", "count", F.explode(two).alias("two")).groupBy("kind", "two").agg(F.sum("count").alias("n"))
    code = lambda at: F.ascii(F.substr("two", F.lit(at), F.lit(1)))
    counts: dict[str, dict[int, int]] = {}
    for kind, pair, n in pairs.where((code(1) < 128) & (code(2) < 128)).select("kind", (code(1) * 128 + code(2)).alias("pair"), "n").collect():
        counts.setdefault(kind, {})[pair] = n
    if not counts.get("random") or not counts.get("word"):
        return None
    log = {kind: _log_probabilities(found) for kind, found in counts.items()}
    random = log.pop("random")
    return F.split(F.lit(",".join(repr(r - max(o)) for r, *o in zip(random, *log.values()))), ",").cast("array<double>")


def _log_probabilities(counts: dict[int, int]) -> list[float]:
    first = [0] * 128
    for pair, n in counts.items():
        first[pair >> 7] += n
    return [math.log((counts.get(k, 0) + PRIOR / ALPHABET**2) / (first[k >> 7] + PRIOR)) for k in range(128 * 128)]


def _stretches(ratios: Column, least: float) -> Column:
    """Stretches (a, b), characters from a to before b, in one pass over the ratios of neighbouring characters.

    A sum starts anew where it is not positive, or has fallen by ``least`` from its peak; a stretch ends at the peak.
    """
    state = "struct<sum:double,peak:double,a:int,b:int,at:int,found:array<struct<a:int,b:int>>>"
    zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("peak"), F.lit(0).alias("a"), F.lit(0).alias("b"), F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("found"))
    found = lambda s: F.when((s["peak"] >= least) & (s["b"] - s["a"] >= LEAST_KEY), F.concat(s["found"], F.array(F.struct(s["a"].alias("a"), s["b"].alias("b"))))).otherwise(s["found"])

    def step(s: Column, x: Column) -> Column:
        total, after = s["sum"] + x, s["at"] + 1
        anew = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("peak"), after.alias("a"), after.alias("b"), after.alias("at"), found(s).alias("found"))
        higher = total > s["peak"]
        on = F.struct(total.alias("sum"), F.greatest(total, s["peak"]).alias("peak"), s["a"].alias("a"), F.when(higher, after + 1).otherwise(s["b"]).alias("b"), after.alias("at"), s["found"].alias("found"))
        return F.when((total <= 0) | (s["peak"] - total >= least), anew).otherwise(on).cast(state)

    return F.aggregate(ratios, zero.cast(state), step, found)


def trained(docs: DataFrame) -> Column | None:
    """The models of all documents."""
    return train(labelled_samples(docs), identifier_samples(docs))


def secret_scan(docs: DataFrame, model: Column | None, into: str = "secrets", least_ratio: float = LEAST_RATIO) -> DataFrame:
    """``docs`` with the sorted spans of each text in the column ``into``: start, place of the kind, kind, end."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce("text", F.lit("")).alias("_text"))
    rows = _matches(rows, "assign", F.lit(True))
    rows = _matches(rows, "access", F.contains("_text", F.lit("AKIA")))
    rows = _matches(rows, "hex", F.lit(True))
    assigned = F.filter("assign", lambda s: F.char_length(F.regexp_extract(s["match"], PATTERNS["assign"], 1)) >= LEAST_ASSIGNED)
    kept = [assigned, F.filter("access", lambda s: F.char_length(s["match"]) >= LEAST_ACCESS), F.col("hex")]
    if model is not None:
        rows = _matches(rows, "markov", F.lit(True))
        ratios = lambda c: F.zip_with(F.slice(c, F.lit(1), F.size(c) - 1), F.slice(c, F.lit(2), F.size(c) - 1), lambda a, b: F.get(model, a * 128 + b))
        rows = rows.withColumn("_runs", F.transform("markov", lambda s: F.struct(s.alias("run"), _stretches(_let(_codes(s["match"]), ratios), least_ratio).alias("found"))))
        kept_of = lambda m, f: F.struct((f["a"] + F.char_length(F.regexp_extract(F.substr(m, f["a"] + 1, f["b"] - f["a"]), "^[^A-Za-z0-9]*", 0))).alias("a"), (f["b"] - F.char_length(F.regexp_extract(F.substr(m, f["a"] + 1, f["b"] - f["a"]), "(?<![^A-Za-z0-9])[^A-Za-z0-9]*+$", 0))).alias("b"))
        left = lambda m, a: F.char_length(F.regexp_extract(F.substr(m, F.lit(1), a), "(?<![A-Za-z0-9])[A-Za-z0-9]*+$", 0))
        right = lambda m, b: F.char_length(F.regexp_extract(F.substr(m, b + 1), "^[A-Za-z0-9]*=*", 0))
        edges = lambda r, f: F.struct((r["start"] + f["a"] - left(r["match"], f["a"])).alias("start"), r["place"], r["kind"], (r["start"] + f["b"] + right(r["match"], f["b"])).alias("end"))
        wide = lambda r, f: _let(kept_of(r["match"], f), lambda g: edges(r, g))
        kept.append(F.array_distinct(F.flatten(F.transform("_runs", lambda t: F.transform(t["found"], lambda f: wide(t["run"], f))))))
    plain = F.concat(*(F.transform(spans, lambda s: F.struct(s["start"], s["place"], s["kind"], s["end"])) for spans in kept))
    return rows.withColumn("_spans", F.array_sort(plain)).select("row.*", F.col("_spans").alias(into))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(docs: DataFrame, model: Column | None, mask: str = MASK) -> DataFrame:
    """``docs`` with every span of ``text`` (overlapping ones together) replaced by ``mask``."""
    found = secret_scan(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"), "text"), model, "spans")
    found = found.withColumn("ends", _running(F.transform("spans", lambda s: s["end"]), F.greatest, F.lit(0)))
    text = F.col("text")
    before = lambda i: F.when(i > 0, F.get("ends", i - 1)).otherwise(0)
    parts = F.transform("spans", lambda s, i: F.when(s["start"] >= before(i), F.concat(F.substr(text, before(i) + 1, s["start"] - before(i)), F.lit(mask))).otherwise(""))
    clean = F.when(F.size("spans") == 0, text).otherwise(F.concat(F.array_join(parts, ""), F.substr(text, F.get("ends", F.size("ends") - 1) + 1)))
    found = found.select("whole", clean.alias("clean"))
    return found.select(*(F.col("clean").alias(c) if c == "text" else F.col(f"whole.`{c}`").alias(c) for c in docs.columns))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan(docs, trained(docs))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.sha2(_joined(F.filter("secrets", lambda s: s["kind"] != "markov")), 256)
    return found.select("doc_id", *(count(k) for k in KINDS), base.alias("base_sha256"), _joined(F.col("secrets")).alias("spans"))
