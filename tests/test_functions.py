"""Literal cases for the Column expressions."""
import pytest
from pyspark.sql import functions as F

from sonora.functions.mood import classify_mood, estimate_features
from sonora.functions.playtime import coerce_unix, parse_play_time, time_of_day
from sonora.functions.text import clean_artist, normalize_text, strip_topic_suffix, unescape_entities
from sonora.functions.vectors import cosine_similarity, percent_of_rounded


def one_col(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


@pytest.mark.parametrize("e,v,label", [
    (0.6, 0.6, "energetic"), (0.6, 0.39, "intense"), (0.6, 0.4, "neutral"),
    (0.39, 0.39, "melancholic"), (0.39, 0.6, "peaceful"), (0.39, 0.4, "neutral"),
    (0.5, 0.9, "neutral"), (None, 0.5, "neutral"),
])
def test_classify_mood(spark, e, v, label):
    assert one_col(spark, [(e, v)], "e double, v double", classify_mood("e", "v")) == [label]


@pytest.mark.parametrize("track,artist,energy,valence", [
    ("Heartbeat", "X", 0.75, 0.6), ("Goodbye", "X", 0.3, 0.25), ("Calm", "X", 0.25, 0.65),
    ("Wedding", "X", 0.7, 0.8), ("Plain", "The Weeknd", 0.65, 0.45), ("Plain", "X", 0.5, 0.5),
    ("Plain", "Anirudh R", 0.72, 0.65), ("Plain", "Aditya Music", 0.6, 0.6),
])
def test_estimate_features(spark, track, artist, energy, valence):
    r = spark.createDataFrame([(track, artist)], "t string, a string") \
        .select(estimate_features("t", "a").alias("f")).first().f
    assert (r.energy, r.valence) == (energy, valence)
    assert r.acousticness == pytest.approx(1 - energy)


def test_time_of_day_bounds(spark):
    hours = [4, 5, 11, 12, 17, 18, 21, 22]
    got = one_col(spark, [(h,) for h in hours], "h int", time_of_day(F.col("h")))
    assert got == ["night", "morning", "morning", "afternoon", "afternoon",
                   "evening", "evening", "night"]


def test_clean_artist(spark):
    masked = ["Top 50 Melody Songs", "Hit Songs Vol 1", "Best Songs", "A Collection",
              "NON STOP mix", "Tamil Hits 2020", "Telugu Songs", "Jukebox"]
    got = one_col(spark, [(a,) for a in masked + [" Sid Sriram "]], "a string", clean_artist("a"))
    assert got == ["Unknown Artist"] * 8 + ["Sid Sriram"]


def test_normalize_text_unicode_whitespace(spark):
    rows = [("\u00a0 Song\t\n",), (None,), ("\u202fA B\u3000",)]
    assert one_col(spark, rows, "s string", normalize_text("s")) == ["Song", "", "A B"]


def test_unescape_and_topic(spark):
    assert one_col(spark, [("&amp;quot;Hi&quot;",)], "s string", unescape_entities("s")) == ['&quot;Hi"']
    got = one_col(spark, [("Sid - Topic",), ("A - Topic - Topic",), ("Plain",)], "s string",
                  strip_topic_suffix("s"))
    assert got == ["Sid", "A", "Plain"]


@pytest.mark.parametrize("text,epoch", [
    ("May 31, 2026, 5:13:56 PM CDT", 1780265636),
    ("May 31, 2026, 5:13:56\u202fPM CDT", 1780265636),
    ("31 May 2026, 22:13", 1780265580),
    ("May 31, 2026, 5:13:56 PM UTC", 1780247636),
    ("May 31, 2026, 5:13:56 PM GMT", 1780247636),
    ("May 31, 2026, 5:13:56 PM BST", 1780247636),
    ("", None), ("garbage", None), ("10:30", None),
])
def test_parse_play_time(spark, text, epoch):
    assert one_col(spark, [(text,)], "t string", parse_play_time("t")) == [epoch]


def test_coerce_unix_prefers_truthy_epoch(spark):
    rows = [("123", "May 31, 2026, 5:13:56 PM CDT"), ("0", "31 May 2026, 22:13"),
            (None, None), ("0", None), ("abc", "31 May 2026, 22:13")]
    got = one_col(spark, rows, "u string, t string", coerce_unix("u", "t"))
    assert got == [123, 1780265580, None, None, 1780265580]


def test_cosine(spark):
    rows = [([1.0, 2.0], [1.0, 2.0]), ([1.0, 0.0], [0.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])]
    got = one_col(spark, rows, "a array<double>, b array<double>", cosine_similarity("a", "b"))
    assert got == [1.0, 0.0, 0.0]


def test_percent_of_rounded_ties(spark):
    rows = [(0.8765,), (-0.8765,), (0.12344,), (1.0,)]
    got = one_col(spark, rows, "c double", percent_of_rounded(F.col("c")))
    assert got == [87.7, -87.7, 12.3, 100.0]


def test_play_time_layouts(spark):
    from sonora.functions.playtime import coerce_unix, parse_play_time

    at = 1780247636  # 2026-05-31 17:13:56 UTC
    cases = {
        "2026-05-31T17:13:56": at, "2026-05-31T17:13:56Z": at, "2026-05-31T17:13:56+00:00": at, "2026-05-31T19:13:56+0200": at,
        "2026-05-31 12:13:56-05:00": at, "2026-05-31T17:13:56.123": at, "2026-05-31 17:13:56.123456Z": at, "2026-05-31 17:13": at - 56,
        "2026-05-31": at - at % 86400, "May 31, 2026, 5:13 PM CDT": at - 56 + 18000, "May 31, 2026, 5:13:56 PM CDT": at + 18000,
        "Sun, 31 May 2026 17:13:56 GMT": at, "31 May 2026, 17:13": at - 56, "31 May 2026, 17:13:56": at, "31 May 2026, 17:13 -0100": at - 56 + 3600,
        "10:30": None, "": None, "soon": None,
    }
    rows = spark.createDataFrame(list(cases), "string").select("value", parse_play_time("value").alias("got")).collect()
    assert {r.value: r.got for r in rows} == cases
    texts = [("NaN", "2026-05-31", at - at % 86400), ("0", "2026-05-31", at - at % 86400), ("12.0", None, 12), ("x", None, None)]
    frame = spark.createDataFrame([t[:2] for t in texts], "unix string, text string")
    assert [r.got for r in frame.select(coerce_unix("unix", "text").alias("got")).collect()] == [t[2] for t in texts]


def test_an_epoch_is_coerced_once_a_row(spark):
    from sonora.operators.load import clean_incoming
    text = F.col("id").cast("string")
    rows = spark.range(3).select(*[text.alias(c) for c in ("track_name", "artist", "album", "timestamp", "unix_timestamp")])
    plan = clean_incoming(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?U)") == 1 and plan.count("h:mm[:ss] a") == 1


@pytest.mark.parametrize("text", [None, "", "CDT", " CDT", "2026-05-31 10:00:00+05:30", "Fri, May 31, 2026, 5:13:56 PM UTC CDT"])
def test_zones_at_the_end(spark, text):
    from datetime import datetime, timezone
    from sonora.operators.load import clean_incoming
    expected = {"2026-05-31 10:00:00+05:30": datetime(2026, 5, 31, 4, 30, tzinfo=timezone.utc).timestamp()}.get(text)
    rows = spark.createDataFrame([("a", None, " b ", text, "0")], "track_name string, artist string, album string, timestamp string, unix_timestamp string")
    assert [r.unix_timestamp for r in clean_incoming(rows).collect()] == ([] if expected is None else [int(expected)])
