"""Operator semantics on literal tables (FIXTURES.md section 3)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from sonora.operators import daily, load, profile, quality, staging
from sonora.operators.upsert import upsert

RAW = "file string, pos int, track_name string, artist string, album string, timestamp string, unix_timestamp string"


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_dedup_first_file_wins(spark):
    rows = [("tracks_2.json", 0, "B", "b", "", None, "100"),
            ("takeout_music_1.json", 3, "A", "a", "", None, "100"),
            ("tracks_2.json", 1, "C", "c", "", None, "200")]
    got = load.dedup_events(load.clean_incoming(raw_df(spark, rows)), ["file", "pos"])
    out = {r.unix_timestamp: r.track_name for r in got.collect()}
    assert out == {100: "A", 200: "C"}


def test_load_is_idempotent_and_audited(spark):
    rows = [("f1", 0, " x ", None, None, None, "10"), ("f1", 1, "y", "a", "b", None, "0"),
            ("f1", 2, "z", "a", "b", "31 May 2026, 22:13", None), ("f1", 3, "w", "a", "b", "garbage", None)]
    incoming = raw_df(spark, rows)
    empty = spark.createDataFrame([], "track_name string, artist string, album string, timestamp string, "
                                      "unix_timestamp bigint, loaded_at timestamp_ntz")
    first = load.load_events(empty, incoming, ["file", "pos"]).cache()
    assert sorted(r.unix_timestamp for r in first.collect()) == [10, 1780265580]
    assert [r.track_name for r in first.filter("unix_timestamp = 10").collect()] == ["x"]
    assert first.filter("unix_timestamp = 10").first().artist == ""
    again = load.load_events(first, incoming, ["file", "pos"])
    assert again.count() == 0
    audit = load.load_audit(first, incoming).first().asDict()
    assert audit == {"before": 2, "after": 2, "inserted": 0, "already_present": 2, "skipped": 2}


def _counts(spark, e, m, p, i, n):
    return spark.createDataFrame([(e, m, p, i, n)], "energetic_count long, melancholic_count long, "
                                 "peaceful_count long, intense_count long, neutral_count long")


@pytest.mark.parametrize("counts,label", [
    ((2, 2, 0, 0, 0), "energetic"), ((0, 1, 1, 1, 1), "melancholic"), ((0, 0, 0, 1, 1), "intense"),
    ((0, 0, 0, 0, 3), "neutral"), ((0, 0, 2, 1, 2), "peaceful"),
])
def test_dominant_mood_ties(spark, counts, label):
    assert _counts(spark, *counts).select(daily.dominant_mood()).first()[0] == label


def _daily(spark, valences, user=1):
    rows = [(user, dt.datetime(2024, 1, i + 1), 10, 0.5, v, 10.0, 0.0, 0.0, 90.0, "neutral")
            for i, v in enumerate(valences)]
    return spark.createDataFrame(rows, "user_id long, played_date timestamp_ntz, total_plays long, "
                                 "avg_energy double, avg_valence double, pct_energetic double, "
                                 "pct_melancholic double, pct_peaceful double, pct_neutral double, "
                                 "dominant_mood string")


def test_mood_trend_half_split(spark):
    st = profile.profile_stats(_daily(spark, [0.2, 0.4, 0.9]), ["user_id"]).first()
    assert st.trend_v == pytest.approx(0.45)
    assert profile.profile_stats(_daily(spark, [0.3]), ["user_id"]).first().trend_v == 0.0


def test_zero_energy_counts_as_missing(spark):
    d = _daily(spark, [0.0, 0.7])
    assert profile.profile_stats(d, ["user_id"]).first().mean_v == pytest.approx(0.6)


def test_upsert_replaces_whole_rows(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, version int")
    new = spark.createDataFrame([(2, "B", 2), (3, "C", 2)], "k long, v string, version int")
    got = sorted(tuple(r) for r in upsert(old, new, ["k"]).collect())
    assert got == [(1, "a", 1), (2, "B", 2), (3, "C", 2)]


def test_duplicate_ids_report(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "play_id long")
    assert [tuple(r) for r in quality.duplicate_ids(df, "play_id").collect()] == [(1, 2)]


def test_fanout_join_matches_weighted_rollup(spark):
    """The roll-up's weighted plan equals aggregating the materialised fan-out."""
    ev = spark.createDataFrame(
        [(1, "Song", "A", 1704106800), (2, "Song", "A", 1704110400), (3, "Other", "B", 1704114000)],
        "event_id long, track_name string, artist string, unix_timestamp long") \
        .withColumn("album", F.lit("")).withColumn("timestamp", F.lit(None).cast("string")) \
        .withColumn("loaded_at", F.lit(None).cast("timestamp_ntz"))
    stg = staging.stg_listening_events(ev)
    feats = spark.createDataFrame(
        [("Song", "A", 0.75, 0.6, 128.0, 0.7, "energetic"), ("Song", "Z", 0.3, 0.25, 72.0, 0.3, "melancholic"),
         ("Other", "B", 0.5, 0.5, 100.0, 0.5, "neutral")],
        "track_name string, artist string, energy float, valence float, tempo float, "
        "danceability float, mood_label string")
    d = daily.stg_daily_mood(stg, feats).first()
    joined = daily.events_with_features(stg, feats)
    assert d.total_plays == joined.count() == 5
    assert (d.energetic_count, d.melancholic_count, d.neutral_count) == (2, 2, 1)
    assert d.avg_energy == round((0.75 * 2 + 0.3 * 2 + 0.5) / 5, 3)
    assert d.dominant_mood == "energetic"
