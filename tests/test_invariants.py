"""Invariants of the derived tables (single listener and per listener)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from sonora.functions.vectors import cosine_similarity
from sonora.operators import artists, features, timeofday
from sonora.plans.warehouse import Warehouse
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse(spark, SF_SMALL)


@pytest.fixture(scope="module")
def wh_user(spark):
    return Warehouse(spark, SF_SMALL, ("user_id",))


def test_mood_counts_sum_to_total(wh):
    bad = wh.daily.filter(
        F.col("energetic_count") + F.col("melancholic_count") + F.col("peaceful_count")
        + F.col("intense_count") + F.col("neutral_count") != F.col("total_plays")).count()
    assert bad == 0


def test_fanout_total_equals_joined_rows(wh):
    assert wh.daily.agg(F.sum("total_plays")).first()[0] == wh.joined.count()


def test_shares_sum_to_100(wh_user):
    sums = timeofday.time_of_day_share(wh_user.stg, ["user_id"]).groupBy("user_id").agg(F.sum("pct").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 100) > 0.02 * 4).count() == 0


def test_cosine_bounds_and_self(wh_user):
    p = wh_user.profiles.alias("a")
    got = p.select(cosine_similarity("embedding", "embedding").alias("self")).distinct().collect()
    assert [r.self for r in got] == [1.0]
    for r in wh_user.profiles.select(F.size("embedding").alias("n")).distinct().collect():
        assert r.n == 20


def test_second_load_adds_nothing(spark, wh):
    from sonora.operators.load import load_events
    assert load_events(wh.raw, wh.incoming, ["event_id"]).count() == 0


def test_not_in_is_null_aware(spark):
    stg = spark.createDataFrame([("a", "X"), ("b", "Y"), (None, "Z")], "track_name string, artist_clean string")
    existing = spark.createDataFrame([("a",)], "track_name string")
    assert sorted(r.track_name for r in features.new_tracks(stg, existing).collect()) == ["b"]
    with_null = spark.createDataFrame([("a",), (None,)], "track_name string")
    assert features.new_tracks(stg, with_null).count() == 0
    pairs = spark.createDataFrame([("a", "Q")], "track_name string, artist string")
    by_pair = features.new_tracks(stg.filter("track_name is not null"), pairs, by="pair")
    assert sorted(r.track_name for r in by_pair.collect()) == ["a", "b"]


def test_trailing_window_spans_eight_dates(spark):
    days = [dt.datetime(2024, 1, d) for d in range(1, 11)]
    stg = spark.createDataFrame([(d, f"A{d.day}") for d in days], "played_date timestamp_ntz, artist_clean string")
    got = {r.artist_clean for r in artists.top_artists_trailing(stg, n=100).collect()}
    assert got == {f"A{d}" for d in range(3, 11)}
