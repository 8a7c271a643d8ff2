"""The fixed lists, stated once more: a changed constant must not pass because its SQL twin reads it too."""
from sonora import fixed_values as V


def test_lists():
    assert V.PLAYLIST_ARTIST_PATTERNS == [
        "%top%songs%", "%hit songs%", "%best songs%", "%collection%", "%non stop%", "%tamil hits%", "%telugu songs%", "%jukebox%"]
    assert {k: v // 3600 for k, v in V.ZONE_OFFSETS.items()} == {
        "CDT": -5, "CST": -6, "EDT": -4, "EST": -5, "MDT": -6, "MST": -7, "PDT": -7, "PST": -8}
    assert V.TIME_OF_DAY_BUCKETS == [("morning", 5, 11), ("afternoon", 12, 17), ("evening", 18, 21)]
    assert V.MOOD_LABELS == ["energetic", "melancholic", "peaceful", "intense", "neutral"]


def test_feature_rules():
    words = ["dance beat party fire power rock fast run fight war pump hype intro bgm|background score|action theme",
             "sad cry tears miss alone pain hurt broken lost empty goodbye farewell nuvvani kaadhal|love failure|heart",
             "sleep calm peace soft gentle lullaby rain night dream slow acoustic unplugged",
             "happy joy celebrate love wedding birthday fun good shine bright smile laugh wow yay", "weeknd", "anirudh", "aditya"]
    values = [(0.75, 0.6, 128, 0.7), (0.3, 0.25, 72, 0.3), (0.25, 0.65, 68, 0.25), (0.7, 0.8, 118, 0.75),
              (0.65, 0.45, 110, 0.65), (0.72, 0.65, 120, 0.72), (0.60, 0.60, 108, 0.62)]
    assert [sorted(r[1]) for r in V.FEATURE_RULES] == [sorted(w for part in line.split("|") for w in ([part] if part in ("background score", "love failure") else part.split())) for line in words]
    assert [tuple(r[2:]) for r in V.FEATURE_RULES] == values
    assert [r[0] for r in V.FEATURE_RULES] == ["track"] * 4 + ["artist"] * 3 and V.DEFAULT_FEATURES == (0.5, 0.5, 100.0, 0.5)


def test_personas():
    assert list(V.PERSONAS) == ["late_night_melancholic", "high_energy_morning", "eclectic_explorer", "focused_neutral", "weekend_warrior"]
    assert [round(sum(c), 2) for c in V.PERSONAS.values()] == [5.84, 9.05, 7.53, 7.23, 7.96] and all(len(c) == 20 for c in V.PERSONAS.values())
