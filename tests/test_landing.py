"""Landing parsers on hand-written inputs."""
import json
import os
import tempfile

from sonora.operators.load import with_epoch
from sonora.sources import raw_json, scrobble_pages, watch_history

NBSP, NNBSP = "\u00a0", "\u202f"


def _block(marker, title, channel, date):
    chan = f'<a href="https://www.youtube.com/channel/UC1">{channel}</a><br>' if channel else ""
    return (f'<div class="outer-cell mdl-cell"><p>{marker}<br></p>Watched{NBSP}'
            f'<a href="https://music.youtube.com/watch?v=abc">{title}</a><br>{chan}{date}<br></div>')


def test_parse_watch_history_rules(spark):
    html = "<html><body>" + "".join([
        _block("YouTube Music", " Song One ", "Sid - Topic", f"May 31, 2026, 5:13:56{NNBSP}PM CDT"),
        _block("YouTube", "Not Music", "Chan", "May 31, 2026, 5:13:56 PM CDT"),
        _block("YouTube Music", "No Channel", None, "Jan 2, 2024, 1:02:03 AM UTC"),
        _block("YouTube Music", "No Date", "A - Topic - Topic", ""),
    ]) + "</body></html>"
    folder = tempfile.mkdtemp(prefix="sonora-export-")
    with open(os.path.join(folder, "watch-history.html"), "w", encoding="utf-8") as f:
        f.write(html)
    got = with_epoch(watch_history.parse_watch_history(watch_history.read_blocks(spark, folder))).collect()
    rows = {r.track_name: r for r in got}
    assert set(rows) == {"Song One", "No Channel", "No Date"}
    assert rows["Song One"].artist == "Sid"
    assert rows["Song One"].unix_timestamp == 1780265636
    assert rows["Song One"].url == "https://music.youtube.com/watch?v=abc"
    assert rows["No Channel"].artist == "Unknown Artist"
    assert rows["No Date"].timestamp is None and rows["No Date"].unix_timestamp is None
    assert rows["No Date"].artist == "A"


def test_scan_raw_json_keeps_file_and_position(spark):
    folder = tempfile.mkdtemp(prefix="sonora-lake-")
    with open(os.path.join(folder, "tracks_1.json"), "w") as f:
        json.dump([{"track_name": "a", "unix_timestamp": 5, "extra": 1},
                   {"track_name": "b", "unix_timestamp": "6", "artist": None}], f)
    got = sorted((r.file_name, r.pos, r.track_name, r.unix_timestamp)
                 for r in raw_json.scan_raw_json(spark, folder).collect())
    assert got == [("tracks_1.json", 0, "a", "5"), ("tracks_1.json", 1, "b", "6")]


def test_flatten_pages_drops_now_playing(spark):
    page = {"recenttracks": {"@attr": {"page": "1", "totalPages": "1", "total": "2"}, "track": [
        {"name": "Live", "artist": {"#text": "X"}, "album": {"#text": ""}, "@attr": {"nowplaying": "true"}},
        {"name": "Old", "artist": {"#text": "Y"}, "album": {"#text": "Z"},
         "date": {"#text": "31 May 2026, 22:13", "uts": "1780265580"}},
        {"name": "NoDate", "artist": {"#text": "Y"}, "album": {"#text": "Z"}}]}}
    folder = tempfile.mkdtemp(prefix="sonora-pages-")
    with open(os.path.join(folder, "page1.json"), "w") as f:
        f.write(json.dumps(page) + "\n")
    got = scrobble_pages.flatten_pages(scrobble_pages.read_pages(spark, folder)).collect()
    assert [(r.track_name, r.artist, r.album, r.timestamp, r.unix_timestamp) for r in got] == [
        ("Old", "Y", "Z", "31 May 2026, 22:13", 1780265580), ("NoDate", "Y", "Z", None, None)]
