"""Mood classification and keyword-based audio-feature estimation."""
from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from sonora.fixed_values import DEFAULT_FEATURES, FEATURE_RULES, MOOD_HIGH, MOOD_LOW
from sonora.functions.text import col_


def classify_mood(energy: Column | str, valence: Column | str) -> Column:
    """Valence/arousal quadrant; anything in the middle band is neutral."""
    e, v = col_(energy), col_(valence)
    return (F.when(e.isNull() | v.isNull(), F.lit("neutral"))
            .when((e >= MOOD_HIGH) & (v >= MOOD_HIGH), F.lit("energetic"))
            .when((e >= MOOD_HIGH) & (v < MOOD_LOW), F.lit("intense"))
            .when((e < MOOD_LOW) & (v < MOOD_LOW), F.lit("melancholic"))
            .when((e < MOOD_LOW) & (v >= MOOD_HIGH), F.lit("peaceful"))
            .otherwise(F.lit("neutral")))


def _values(energy: float, valence: float, tempo: float, dance: float) -> Column:
    return F.struct(
        F.lit(energy).alias("energy"),
        F.lit(valence).alias("valence"),
        F.lit(tempo).alias("tempo"),
        F.lit(dance).alias("danceability"),
    )


def estimate_features(track_name: Column | str, artist: Column | str) -> Column:
    """Estimated (energy, valence, tempo, danceability, acousticness), doubles.

    The first keyword rule whose words occur in the lower-cased track name
    (or, for artist rules, artist name) decides; acousticness = 1 - energy.
    """
    fields = {"track": F.lower(col_(track_name)), "artist": F.lower(col_(artist))}
    chosen = None
    for field, words, e, v, t, d in FEATURE_RULES:
        hit = fields[field].rlike("|".join(re.escape(w) for w in words))
        chosen = (F.when(hit, _values(e, v, t, d)) if chosen is None
                  else chosen.when(hit, _values(e, v, t, d)))
    s = chosen.otherwise(_values(*DEFAULT_FEATURES))
    return F.struct(
        s["energy"].alias("energy"),
        s["valence"].alias("valence"),
        s["tempo"].alias("tempo"),
        s["danceability"].alias("danceability"),
        (F.lit(1.0) - s["energy"]).alias("acousticness"),
    )


def largest(counts: dict[str, Column]) -> Column:
    """The label with the largest count; equal counts go to the label listed first."""
    top = F.greatest(*counts.values())
    return F.coalesce(*[F.when(n == top, F.lit(label)) for label, n in counts.items()])
