"""Text cleanup expressions."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from sonora.fixed_values import (
    EXPORT_TOPIC_SUFFIX,
    PLAYLIST_ARTIST_PATTERNS,
    UNKNOWN_ARTIST,
)

# The characters ``str.strip()`` removes: every code point whose
# ``str.isspace()`` is true (derived from that rule, not listed by hand).
WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove Unicode whitespace at both ends (null stays null).

    ``btrim`` with an explicit character set: a plain scan from both ends,
    no regular expression per row.
    """
    return F.btrim(col_(c), F.lit(WHITESPACE))


def normalize_text(c: Column | str) -> Column:
    """``(x or '').strip()``: null becomes '' and edge whitespace goes."""
    return strip_ws(F.coalesce(col_(c), F.lit("")))


def is_playlist_artist(artist: Column | str) -> Column:
    low = F.lower(col_(artist))
    return reduce(lambda a, b: a | b, [low.like(p) for p in PLAYLIST_ARTIST_PATTERNS])


def clean_artist(artist: Column | str) -> Column:
    """Mask playlist-style channel names as the unknown artist, else trim."""
    a = col_(artist)
    return F.when(is_playlist_artist(a), F.lit(UNKNOWN_ARTIST)).otherwise(F.trim(a))


def is_known_artist(artist_clean: Column | str) -> Column:
    """``artist_clean != 'Unknown Artist'`` -- null is not known either."""
    return col_(artist_clean) != F.lit(UNKNOWN_ARTIST)


def unescape_entities(c: Column | str) -> Column:
    """``&quot;`` -> ``"`` first, then ``&amp;`` -> ``&`` (in that order)."""
    once = F.replace(col_(c), F.lit("&quot;"), F.lit('"'))
    return F.replace(once, F.lit("&amp;"), F.lit("&"))


def strip_topic_suffix(artist: Column | str) -> Column:
    """Channel names ending in " - Topic" lose every occurrence of it."""
    a = col_(artist)
    return F.when(a.endswith(EXPORT_TOPIC_SUFFIX),
                  F.replace(a, F.lit(EXPORT_TOPIC_SUFFIX), F.lit(""))).otherwise(a)
