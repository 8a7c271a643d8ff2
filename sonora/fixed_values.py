"""Fixed values that must equal the analysed pipeline's for results to match.

Everything in this module is data, stated as plain text in its natural order.
The code that uses it lives in ``sonora.functions`` and ``sonora.operators``.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES -- playlist-style artist names that are masked as unknown.
# Each entry is a SQL LIKE pattern tested on the lower-cased artist name.
# ---------------------------------------------------------------------------
UNKNOWN_ARTIST = "Unknown Artist"
PLAYLIST_ARTIST_PATTERNS = [
    "%top%songs%",
    "%hit songs%",
    "%best songs%",
    "%collection%",
    "%non stop%",
    "%tamil hits%",
    "%telugu songs%",
    "%jukebox%",
]

# ---------------------------------------------------------------------------
# FIXED VALUES -- time-of-day buckets by hour of day (inclusive bounds).
# Hours outside every range are "night".
# ---------------------------------------------------------------------------
TIME_OF_DAY_BUCKETS = [
    ("morning", 5, 11),
    ("afternoon", 12, 17),
    ("evening", 18, 21),
]
NIGHT = "night"
TIME_OF_DAY_LABELS = ["morning", "afternoon", "evening", "night"]

# ---------------------------------------------------------------------------
# FIXED VALUES -- mood labels and thresholds of the energy/valence classifier.
# ---------------------------------------------------------------------------
MOOD_LABELS = ["energetic", "melancholic", "peaceful", "intense", "neutral"]
# Labels that get a share column and take part in the profile's top mood.
PROFILE_MOODS = ["energetic", "melancholic", "peaceful", "neutral"]
MOOD_HIGH = 0.6
MOOD_LOW = 0.4

# ---------------------------------------------------------------------------
# FIXED VALUES -- keyword cascade of the audio-feature estimator.
# Tested in this order; the first rule that matches wins.  Track rules test
# the lower-cased track name, artist rules the lower-cased artist name.
# Columns: (tested field, keywords, energy, valence, tempo, danceability)
# ---------------------------------------------------------------------------
FEATURE_RULES = [
    ("track", ["dance", "beat", "party", "fire", "power", "rock",
               "fast", "run", "fight", "war", "pump", "hype", "intro",
               "bgm", "background score", "action", "theme"],
     0.75, 0.6, 128.0, 0.7),
    ("track", ["sad", "cry", "tears", "miss", "alone", "pain",
               "hurt", "broken", "lost", "empty", "goodbye", "farewell",
               "nuvvani", "kaadhal", "love failure", "heart"],
     0.3, 0.25, 72.0, 0.3),
    ("track", ["sleep", "calm", "peace", "soft", "gentle", "lullaby",
               "rain", "night", "dream", "slow", "acoustic", "unplugged"],
     0.25, 0.65, 68.0, 0.25),
    ("track", ["happy", "joy", "celebrate", "love", "wedding",
               "birthday", "fun", "good", "shine", "bright",
               "smile", "laugh", "wow", "yay"],
     0.7, 0.8, 118.0, 0.75),
    ("artist", ["weeknd"], 0.65, 0.45, 110.0, 0.65),
    ("artist", ["anirudh"], 0.72, 0.65, 120.0, 0.72),
    ("artist", ["aditya"], 0.60, 0.60, 108.0, 0.62),
]
DEFAULT_FEATURES = (0.5, 0.5, 100.0, 0.5)
FEATURE_SOURCE = "estimated"

# ---------------------------------------------------------------------------
# FIXED VALUES -- fixed UTC offsets (seconds) for US zone abbreviations in
# free-text play times.  UTC and GMT are zero; any other name counts as UTC.
# ---------------------------------------------------------------------------
ZONE_OFFSETS = {
    "CDT": -5 * 3600, "CST": -6 * 3600,
    "EDT": -4 * 3600, "EST": -5 * 3600,
    "MDT": -6 * 3600, "MST": -7 * 3600,
    "PDT": -7 * 3600, "PST": -8 * 3600,
}

# Datetime patterns tried, in order, on the zone-less play time text
# (watch-history export style first, scrobble style second, then ISO forms).
PLAY_TIME_FORMATS = [
    "MMM d, yyyy, h:mm[:ss] a",
    "d MMM yyyy[,] HH:mm[:ss]",
    "yyyy-MM-dd[['T'][ ]HH:mm[:ss[.SSSSSS][.SSS]]]",
]

# ---------------------------------------------------------------------------
# FIXED VALUES -- watch-history export markers and patterns.
# ---------------------------------------------------------------------------
EXPORT_BLOCK_DELIMITER = 'class="outer-cell'
EXPORT_MUSIC_MARKER = ">YouTube Music<br>"
EXPORT_TITLE_PATTERN = (
    r"Watched\x{00A0}<a href=[\"']?(https://music\.youtube\.com/watch\?v=[^\"'>\s]+)[\"']?>([^<]+)</a>"
)
EXPORT_CHANNEL_PATTERN = r'<a href="https://www\.youtube\.com/channel/[^"]+">([^<]+)</a>'
EXPORT_DATE_PATTERN = (
    r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
    r"\s+\d+,\s+\d{4},\s+\d+:\d+:\d+\s+[AP]M\s+\w+"
)
EXPORT_TOPIC_SUFFIX = " - Topic"
EXPORT_SOURCE = "youtube_music_takeout"

# ---------------------------------------------------------------------------
# FIXED VALUES -- fingerprint vector layout.
# ---------------------------------------------------------------------------
FINGERPRINT_DIM = 20
PLAYS_PER_DAY_SCALE = 50.0
DAYS_ACTIVE_SCALE = 30.0
WEEKEND_PLACEHOLDER = 0.5
TOP_ARTISTS_FOR_CONCENTRATION = 10
CONCENTRATION_WHEN_NO_ARTIST = 50.0

# ---------------------------------------------------------------------------
# FIXED VALUES -- persona centroids
# (20 dimensions each, same layout as the fingerprint).
# ---------------------------------------------------------------------------
PERSONAS = {
    "late_night_melancholic": [
        0.08, 0.45, 0.12, 0.35, 0.32, 0.28, 0.08, 0.12, 0.02, 0.08,
        0.25, 0.65, 0.45, 0.35, 0.60, 0.25, 0.35, 0.40, 0.09, 0.55,
    ],
    "high_energy_morning": [
        0.55, 0.05, 0.08, 0.32, 0.78, 0.72, 0.06, 0.08, 0.55, 0.30,
        0.12, 0.03, 0.65, 0.70, 0.80, 0.40, 0.65, 0.70, 0.56, 0.95,
    ],
    "eclectic_explorer": [
        0.22, 0.18, 0.15, 0.45, 0.52, 0.55, 0.18, 0.20, 0.20, 0.30,
        0.28, 0.22, 0.15, 0.55, 0.75, 0.50, 0.52, 0.50, 0.29, 0.82,
    ],
    "focused_neutral": [
        0.12, 0.08, 0.05, 0.75, 0.50, 0.50, 0.03, 0.03, 0.10, 0.50,
        0.30, 0.10, 0.55, 0.40, 0.70, 0.35, 0.50, 0.50, 0.25, 0.92,
    ],
    "weekend_warrior": [
        0.35, 0.10, 0.08, 0.47, 0.65, 0.60, 0.12, 0.10, 0.05, 0.20,
        0.35, 0.40, 0.50, 0.25, 0.45, 0.80, 0.58, 0.62, 0.39, 0.90,
    ],
}

# ---------------------------------------------------------------------------
# FIXED VALUES -- serving layer.
# ---------------------------------------------------------------------------
TIMELINE_DAYS = 14          # dashboard: last 14 active days
WEEKLY_DAYS = 7             # weekly brief: last 7 active days
WEEKLY_TOP_ARTISTS = 5      # weekly brief: top 5 artists ...
TRAILING_WINDOW_DAYS = 7    # ... of days >= max day - 7 days
TOP_ARTISTS = 10            # dashboard: top 10 artists
RELATIVE_SHARE_ROWS = 8     # dashboard page: first 8 artists shown as bars
SIMILAR_USERS_TOP_N = 5
