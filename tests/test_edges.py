"""Edges: bad files, repeated loads, empty inputs, duplicate keys, batch limits."""
import json
import os
import re
import tempfile

import pytest

from pyspark.sql import functions as F
from sonora.operators import profile, serving, similarity
from sonora.operators.features import new_tracks
from sonora.operators.load import append_events, fresh_events
from sonora.operators.upsert import upsert
from sonora.plans.warehouse import Warehouse
from sonora.session import checkpoint_dir
from sonora.sources import raw_json, reports
from sonora.sources.testdata import adapted_events
from sonora.streaming.incremental_load import existing_events
from tests.conftest import SF_SMALL

GOOD = '[{"track_name": "a", "artist": "x", "album": "", "unix_timestamp": 10}]'


@pytest.mark.parametrize("bad", [GOOD[:-1], '[{"track_name": "a"}, {"track', "plain text", '{"track_name": "a"}', ""])
def test_bad_files_are_loud_or_listed(spark, bad):
    folder = tempfile.mkdtemp(prefix="sonora-bad-")
    for name, text in (("1.json", GOOD + "\n"), ("2.json", bad), ("3.json", " []")):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    if bad:
        with pytest.raises(Exception, match="not a JSON array of plays.*2.json"):
            raw_json.scan_raw_json(spark, folder).collect()
        assert [r.file_name for r in raw_json.rejected_files(spark, folder).collect()] == ["2.json"]
    assert [r.track_name for r in raw_json.scan_raw_json(spark, folder, on_error="skip").collect()] == ["a"]


@pytest.mark.parametrize("bad", [GOOD[:-1], '[{"track_name": "a"}, {"track', "plain text", '[{"track_name": "a"} {"track_name": "b"}]'])
def test_bad_large_arrays_are_loud(spark, bad):
    folder = tempfile.mkdtemp(prefix="sonora-bad-arrays-")
    for name, text in (("1.json", "\n" + GOOD + "\n"), ("2.json", ""), ("3.json", " []")):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    assert [(r.file_name, r.track_name, r.unix_timestamp) for r in raw_json.scan_large_arrays(spark, folder).collect()] == [("1.json", "a", "10")]
    with open(os.path.join(folder, "4.json"), "w") as f:
        f.write(bad)
    with pytest.raises(Exception, match="4.json"):
        raw_json.scan_large_arrays(spark, folder).collect()


def test_large_arrays_are_read_once(spark):
    folder = tempfile.mkdtemp(prefix="sonora-large-")
    with open(f"{folder}/1.json", "w") as f:
        json.dump([{"track_name": "a", "unix_timestamp": 1700000000 + i} for i in range(3000)], f)
    files = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    before = files.getLong("bytesRead")
    assert raw_json.scan_large_arrays(spark, folder).where("unix_timestamp >= '1700000000'").count() == 3000
    assert files.getLong("bytesRead") - before < 4 * os.path.getsize(f"{folder}/1.json")


def test_large_arrays_give_the_rows_of_the_plain_scan_in_order(spark):
    folder = tempfile.mkdtemp(prefix="sonora-arrays-")
    odd = ["a } b", "x ], [ y", 'quote " and \\ slash', "line\nbreak", "é \u2028", None, ""]
    for name in ("b.json", "a.json"):
        plays = [{"track_name": odd[k % len(odd)], "artist": f"{name}{k}", "unix_timestamp": k if k % 2 else str(k), "extra": [{"k": k}]} for k in range(5000)]
        with open(os.path.join(folder, name), "w") as f:
            json.dump(plays, f, indent=None if name == "a.json" else 1)
    order = lambda df: [tuple(r) for r in df.orderBy("file_name", "pos").drop("pos").collect()]
    assert order(raw_json.scan_large_arrays(spark, folder)) == order(raw_json.scan_raw_json(spark, folder))
    plan = raw_json.scan_large_arrays(spark, folder).select("artist")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<artist:string>" in plan


def test_json_lines_keep_their_order(spark):
    folder = tempfile.mkdtemp(prefix="sonora-lines-")
    rows = [("f", 2, "a", "x", "", None, "5"), ("f", 1, "b", None, "", "t", None)]
    raw_json.land_json_lines(spark.createDataFrame(rows, "file_name string, pos long, track_name string, artist string, album string, timestamp string, unix_timestamp string"), folder)
    assert sorted((r.file_name, r.pos, r.track_name) for r in raw_json.scan_json_lines(spark, folder).collect()) == [("f", 1, "b"), ("f", 2, "a")]
    with open(os.path.join(folder, "bad.json"), "w") as f:
        f.write('{"track_name": ')
    with pytest.raises(Exception):
        raw_json.scan_json_lines(spark, folder).collect()


def test_append_twice_and_prune(spark):
    table = tempfile.mkdtemp(prefix="sonora-table-") + "/t"
    events = adapted_events(spark, SF_SMALL)
    for n in (1, 2):
        append_events(existing_events(spark, table), table, events, ["event_id"])
        counts = spark.read.parquet(table).count()
        first = counts if n == 1 else first
    assert counts == first == events.select("unix_timestamp").distinct().count()
    plan = fresh_events(existing_events(spark, table), events, ["event_id"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*play_date", plan)


def test_unset_shared_folder_is_refused():
    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self): return None
        def getConf(self): return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_no_days_no_profile(spark):
    w = Warehouse(spark, SF_SMALL)
    daily, stg = w.daily.limit(0), w.stg
    assert profile.user_fingerprint(daily, stg).count() == 0
    from sonora.operators.artists import top10_concentration
    from sonora.operators.timeofday import time_of_day_pivot
    vector = profile.fingerprint_vector(profile.profile_stats(daily), time_of_day_pivot(stg), top10_concentration(stg))
    assert vector.first()["embedding"] == [0.5] * 20


def test_totals_beyond_32_bits(spark):
    w = Warehouse(spark, SF_SMALL)
    large = w.daily.withColumn("total_plays", F.lit(1 << 40))
    assert profile.user_fingerprint(large, w.stg).first()["total_plays"] == large.count() << 40


def test_dashboard_without_profile_or_report(spark):
    w = Warehouse(spark, SF_SMALL)
    none = w.profiles.limit(0)
    empty = reports.latest_report(spark, tempfile.mkdtemp() + "/none")
    rows = serving.dashboard_sections(
        serving.mood_timeline(w.daily), spark.createDataFrame([], "artist_clean string, plays long"),
        spark.createDataFrame([("night", None)], "time_of_day string, plays long"),
        similarity.fingerprint_card(none, F.lit("listener")), empty, similarity.match_list(none, F.lit("listener"))).collect()
    by = {}
    for r in rows:
        by.setdefault(r.section, []).append(r.json)
    assert by["fingerprint"] == ["{}"] and by["weekly_report"] == ['{"text":""}'] and "taste_tribe" not in by
    assert by["time_distribution"] == ['{"time":"night","plays":null}'] and len(by["mood_timeline"]) == min(14, w.daily.count())
    assert list(__import__("json").loads(by["mood_timeline"][0])) == [
        "date", "total_plays", "dominant_mood", "avg_energy", "avg_valence", "pct_energetic", "pct_melancholic", "time_of_day"]


def test_reports_keep_their_keys(spark):
    path = tempfile.mkdtemp(prefix="sonora-reports-") + "/r"
    rows = spark.createDataFrame([(1, "one"), (2, "two")], "user_id long, brief string")
    reports.write_reports(rows, path, F.lit("20240101"), ["user_id"])
    reports.write_reports(rows.where("user_id = 1").withColumn("brief", F.lit("newer")), path, F.lit("20240201"), ["user_id"])
    got = reports.latest_report(spark, path, ["user_id"]).collect()
    assert {r.user_id: r.latest_report for r in got} == {1: "newer", 2: "two"}


def test_upsert_keeps_one_row_for_each_key(spark):
    schema = "username string, v array<double>, updated_at timestamp"
    old = spark.createDataFrame([("a", [1.0], None), ("b", [2.0], None)], schema)
    import datetime as d
    new = spark.createDataFrame([("b", [9.0], d.datetime(2024, 1, 1)), ("b", [3.0], d.datetime(2024, 1, 2)), ("c", None, None)], schema)
    assert sorted((r.username, r.v) for r in upsert(old, new, ["username"]).collect()) == [("a", [1.0]), ("b", [3.0]), ("c", None)]


def test_limited_batches_reach_every_pair(spark):
    w = Warehouse(spark, SF_SMALL)
    every = new_tracks(w.stg).count()
    seen = spark.createDataFrame([], "track_name string, artist string")
    first = new_tracks(w.stg, existing=seen, by="pair", limit=7).collect()
    assert [(r.track_name, r.artist) for r in first] == sorted((r.track_name, r.artist) for r in first) and len(first) == 7
    rest = new_tracks(w.stg, existing=spark.createDataFrame(first, "track_name string, artist string"), by="pair")
    assert rest.count() == every - 7


def test_last_report_reads_no_other_text(spark):
    path = tempfile.mkdtemp(prefix="sonora-reports-") + "/r"
    for day, brief in (("20240101", "old"), ("20240301", "newest\n\nélan\n"), ("20240201", "middle")):
        reports.write_reports(spark.createDataFrame([(brief,)], "brief string"), path, F.lit(day))
    last = reports.latest_report(spark, path)
    assert [r.latest_report for r in last.collect()] == ["newest\n\nélan\n"]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*report", plan)
