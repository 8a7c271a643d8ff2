"""Stored tables changed in place: loads, upserts, backfills, and what is left when a run breaks off."""
import datetime
import os
import tempfile

import pytest

from pyspark.sql import functions as F
from sonora.operators.daily import stg_daily_mood
from sonora.operators.load import on_days_of
from sonora.operators.staging import stg_listening_events
from sonora.operators.stored import BAD_TIME, NO_TIME, DailyTable, FeatureTable, KeyedTable, PlayTable

DAY = 86400
COLUMNS = "pos long, track_name string, artist string, album string, timestamp string, unix_timestamp long"


def new_dir():
    return tempfile.mkdtemp(prefix="sonora-stored-")


def plays(spark, seconds, text="a"):
    return spark.createDataFrame([(k, f" {text}{k} ", None, "x", None, s) for k, s in enumerate(seconds)], COLUMNS)


def audit(df):
    return tuple(df.first())


def test_loads_append_only_what_is_new(spark):
    table = PlayTable(spark, new_dir())
    assert audit(table.load(plays(spark, [100, 100, 5 * DAY, 90 * DAY]), ["pos"])) == (0, 3, 3, 0, 0)
    assert audit(table.load(plays(spark, [100, 100, 5 * DAY, 90 * DAY]), ["pos"])) == (3, 3, 0, 3, 0)
    assert audit(table.load(plays(spark, [5 * DAY + 1, 5 * DAY], "b"), ["pos"])) == (3, 4, 1, 1, 0)
    rows = {r.unix_timestamp: (r.track_name, r.artist, r.load, str(r.play_date)) for r in table.rows().collect()}
    assert rows == {100: ("a0", "", 1, "1970-01-01"), 5 * DAY: ("a2", "", 1, "1970-01-06"), 5 * DAY + 1: ("b0", "", 3, "1970-01-06"), 90 * DAY: ("a3", "", 1, "1970-04-01")}
    assert sorted(d for d in os.listdir(f"{table.path}/plays") if d.startswith("play_date")) == ["play_date=1970-01-01", "play_date=1970-01-06", "play_date=1970-04-01"]


def test_listeners_apart(spark):
    table = PlayTable(spark, new_dir(), ("user_id",))
    both = plays(spark, [100, 200]).withColumn("user_id", F.explode(F.array(F.lit(1), F.lit(2)).cast("array<bigint>")))
    assert audit(table.load(both.where("user_id = 1"), ["pos"])) == (0, 2, 2, 0, 0)
    assert audit(table.load(both, ["pos"])) == (2, 4, 2, 2, 0)


def test_empty_load(spark):
    table = PlayTable(spark, new_dir())
    assert audit(table.load(plays(spark, [1]).where("false"), ["pos"])) == (0, 0, 0, 0, 0)
    assert audit(table.load(plays(spark, [1]), ["pos"])) == (0, 1, 1, 0, 0)


def test_only_the_loads_days_are_scanned(spark):
    table = PlayTable(spark, new_dir())
    table.load(plays(spark, [k * DAY + 1 for k in range(30)]), ["pos"])
    stray = spark.createDataFrame([(datetime.date(1970, 1, 1),), (datetime.date(1970, 1, 30),)], "play_date date")
    near = on_days_of(table.rows(), stray)
    assert "dynamicpruning" in near._jdf.queryExecution().executedPlan().toString()
    assert near.count() == 2
    # With the files of all other days gone, a scan of more than the two days would fail.
    for day in os.listdir(f"{table.path}/plays"):
        if day.startswith("play_date=") and day[-2:] not in ("01", "30"):
            for f in os.listdir(f"{table.path}/plays/{day}"):
                os.remove(f"{table.path}/plays/{day}/{f}")
    assert near.select("unix_timestamp").count() == 2


def test_rejects_have_reasons_and_are_not_loaded(spark):
    rows = [(0, "a", "b", "c", "garbage", None), (1, "a", " b", "c", None, None), (2, None, None, None, "", 0), (3, "ok", "b", "c", "31 May 2026, 22:13", None), (4, "ok", "b", "c", None, 7)]
    table = PlayTable(spark, new_dir())
    assert audit(table.load(spark.createDataFrame(rows, COLUMNS), ["pos"])) == (0, 2, 2, 0, 3)
    assert {(r.pos, r.artist, r.reason, r.load) for r in table.rejects("pos long").collect()} == {(0, "b", BAD_TIME, 1), (1, " b", NO_TIME, 1), (2, None, NO_TIME, 1)}


def test_a_load_that_broke_off(spark):
    table = PlayTable(spark, new_dir())
    table.load(plays(spark, [1, 2]), ["pos"])
    table._write_log(2, "begun", 2, None, None, 0)  # before its append: nothing there
    assert audit(table.load(plays(spark, [2, 3]), ["pos"])) == (2, 3, 1, 1, 0)
    # After its append, before its log: the rows are there and counted.
    plays_dir = f"{table.path}/plays"
    table.rows().where("unix_timestamp = 3").withColumns({"unix_timestamp": F.lit(4).cast("long"), "load": F.lit(4).cast("long")}).write.mode("append").partitionBy("play_date").parquet(plays_dir)
    table._write_log(4, "begun", 3, None, None, 0)
    assert audit(table.load(plays(spark, [4, 5]), ["pos"])) == (4, 5, 1, 1, 0)


PROFILE = "name string, n long, updated_at long"


def files(table):
    return {(d, f) for d in os.listdir(f"{table.path}/rows") if d.startswith("bucket") for f in os.listdir(f"{table.path}/rows/{d}") if f.endswith(".parquet")}


def test_upsert_rewrites_only_its_buckets(spark):
    table = KeyedTable(spark, new_dir(), ["name"], PROFILE, buckets=8)
    assert table.rows().count() == 0
    first = table.upsert(spark.createDataFrame([(f"u{k}", k, 1) for k in range(40)], PROFILE))
    assert first == list(range(8))
    before = files(table)
    touched = table.upsert(spark.createDataFrame([("u3", -3, 2), ("u3", -4, 3), ("new", 9, 1), (None, 1, 1)], PROFILE))
    assert 0 < len(touched) < 8
    assert {f for f in before if int(f[0].split("=")[1]) not in touched} <= files(table)
    assert not {f for f in before if int(f[0].split("=")[1]) in touched} & files(table)
    rows = {r["name"]: r.n for r in table.rows().collect()}
    assert rows == {**{f"u{k}": k for k in range(40)}, "u3": -4, "new": 9, None: 1}
    assert table.upsert(spark.createDataFrame([], PROFILE)) == [] and table.rows().count() == 42


def test_upsert_writes_one_file_for_each_bucket(spark):
    table = KeyedTable(spark, new_dir(), ["name"], PROFILE, buckets=4)
    for n in (1, 2):
        table.upsert(spark.createDataFrame([(f"u{k}", k, n) for k in range(40)], PROFILE).repartition(8))
        for step in ("updates", "next", "rows"):
            names = [f for _, _, found in os.walk(f"{table.path}/{step}") for f in found if f.endswith(".parquet")]
            assert len(names) == 4, step


def test_batches_share_the_adapted_rows(spark):
    from sonora.plans.warehouse import warehouse
    from tests.conftest import SF_SMALL
    whole, batches = warehouse(spark, SF_SMALL), [warehouse(spark, SF_SMALL, ("user_id",), batch=b).incoming for b in ("first", "second")]
    assert all("Join" not in b._jdf.queryExecution().optimizedPlan().toString() for b in batches)
    timed = whole.landed.where("unix_timestamp IS NOT NULL")
    both = batches[0].unionByName(batches[1])
    assert both.exceptAll(timed).count() == timed.exceptAll(both).count() == 0


def pairs(spark, n):
    return spark.createDataFrame([(f"t{k // 2:03d}", f"a{k % 2}") for k in range(n)] + [("x", "Unknown Artist")], "track_name string, artist_clean string")


def test_backfill_goes_on_where_it_broke_off(spark):
    table = FeatureTable(spark, new_dir(), limit=7, by="pair")
    stg = pairs(spark, 30)
    assert table.backfill(stg, most_batches=2) == 3 and table.rows().count() == 14
    os.remove(f"{table.path}/batch/batch=1/_SUCCESS")  # as if the second batch had broken off
    assert table.rows().count() == 7
    more = stg.unionByName(spark.createDataFrame([("late", "a0")], stg.schema))
    assert table.backfill(more) == 0  # the rest of the old work list
    rows = [(r.track_name, r.artist) for r in table.rows().collect()]
    assert len(rows) == len(set(rows)) == 30
    assert table.backfill(more) == 0 and table.rows().count() == 31  # a new list, for what came late
    assert table.backfill(more) == 0 and table.rows().count() == 31
    assert table._folders("batch") == [0, 1, 2, 3, 4, 5]


@pytest.mark.parametrize("by, count", [("pair", 10), ("track_name", 8)])
def test_batch_border_within_a_name(spark, by, count):
    """By name, an artist behind the border is skipped, as in the original; by pair nothing is."""
    table = FeatureTable(spark, new_dir(), limit=3, by=by)
    table.backfill(pairs(spark, 6), most_batches=1)
    table.backfill(pairs(spark, 10))  # the rest of the open work list
    table.backfill(pairs(spark, 10))
    assert table.rows().count() == count


FEATURES = "track_name string, artist string, energy float, valence float, tempo float, danceability float, mood_label string"


def test_daily_sums_of_loads_add_up(spark):
    plays, days = PlayTable(spark, new_dir()), DailyTable(spark, new_dir())
    features = spark.createDataFrame([(f"a{k}", a, 0.1 * k, 0.5, 100.0 + k, None if k == 2 else 0.25, m) for k in range(6) for a, m in (("x", "energetic"), ("y", "peaceful"))][:-3], FEATURES)
    loads = [[k * 7000 + 1 for k in range(30)], [5, 40000, 40001, 9 * DAY], [3]]
    for n, seconds in enumerate(loads, 1):
        plays.load(plays_of(spark, seconds), ["pos"])
        before = day_files(days)
        days.add(n, stg_listening_events(plays.rows().where(F.col("load") == n)), features)
        touched = {f"play_date={r.play_date}" for r in plays.rows().where(F.col("load") == n).select("play_date").distinct().collect()}
        assert {f for f in before if f[0] not in touched} <= day_files(days)
    full = sorted(map(str, stg_daily_mood(stg_listening_events(plays.rows()), features).collect()))
    assert sorted(map(str, days.rows().collect())) == full
    days.add(3, stg_listening_events(plays.rows().where("load = 3")), features)  # again
    assert sorted(map(str, days.rows().collect())) == full
    assert "dynamicpruning" in on_days_of(days.stored(), days.stored().limit(1))._jdf.queryExecution().executedPlan().toString()
    # A track is featured later: its days are rolled up again.
    late = features.unionByName(spark.createDataFrame([("a5", "z", 0.9, 0.9, 90.0, 0.9, "intense")], FEATURES))
    again = plays.rows().where("track_name = 'a5'").select("play_date").distinct()
    days.refresh(again, plays.rows(), stg_listening_events, late, 3)
    assert sorted(map(str, days.rows().collect())) == sorted(map(str, stg_daily_mood(stg_listening_events(plays.rows()), late).collect()))


def plays_of(spark, seconds):
    return spark.createDataFrame([(k, f"a{k % 7}", "x", "", None, s) for k, s in enumerate(seconds)], COLUMNS)


def day_files(table):
    days = f"{table.path}/days"
    return {(d, f) for d in (os.listdir(days) if os.path.exists(days) else []) if d.startswith("play_date") for f in os.listdir(f"{days}/{d}") if f.endswith(".parquet")}
