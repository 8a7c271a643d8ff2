"""Incremental lake loading with Structured Streaming."""
import json
import os
import tempfile

from sonora.streaming.incremental_load import start_incremental_load


def _land(folder, name, rows):
    with open(os.path.join(folder, name), "w") as f:
        json.dump(rows, f)


def test_stream_load_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="sonora-stream-")
    landing, table, ckpt = (os.path.join(root, d) for d in ("landing", "table", "ckpt"))
    os.makedirs(landing)
    _land(landing, "takeout_music_1.json", [
        {"track_name": "A", "artist": "x", "album": "", "timestamp": "31 May 2026, 22:13", "unix_timestamp": None},
        {"track_name": "B", "artist": "y", "album": "", "timestamp": None, "unix_timestamp": 100},
        {"track_name": "bad", "artist": "y", "album": "", "timestamp": "garbage", "unix_timestamp": None}])
    q = start_incremental_load(spark, landing, table, ckpt)
    q.awaitTermination(120)
    first = {r.unix_timestamp: r.track_name for r in spark.read.parquet(table).collect()}
    assert first == {1780265580: "A", 100: "B"}
    # A later file repeats one second and adds one: only the new second lands.
    _land(landing, "tracks_2.json", [
        {"track_name": "B2", "artist": "y", "album": "", "timestamp": None, "unix_timestamp": 100},
        {"track_name": "C", "artist": "z", "album": "", "timestamp": None, "unix_timestamp": 200}])
    q = start_incremental_load(spark, landing, table, ckpt)
    q.awaitTermination(120)
    got = {r.unix_timestamp: r.track_name for r in spark.read.parquet(table).collect()}
    assert got == {1780265580: "A", 100: "B", 200: "C"}
