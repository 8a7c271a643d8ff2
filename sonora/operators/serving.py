"""Serving datasets: timelines, weekly brief text, dashboard document."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from sonora.fixed_values import TIMELINE_DAYS, WEEKLY_DAYS
from sonora.functions.playtime import date_text
from sonora.operators.profile import attach


def latest_days(daily: DataFrame, n: int, keys: Sequence[str] = ()) -> DataFrame:
    """The ``n`` most recent active days (rows, not calendar days), per key."""
    if not keys:
        return daily.orderBy(F.col("played_date").desc()).limit(n)
    w = Window.partitionBy(*keys).orderBy(F.col("played_date").desc())
    return daily.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def mood_timeline(daily: DataFrame, keys: Sequence[str] = (), n: int = TIMELINE_DAYS) -> DataFrame:
    """Dashboard timeline: last ``n`` active days, newest first."""
    return latest_days(daily, n, keys).select(
        *keys,
        date_text("played_date").alias("date"),
        "total_plays",
        "dominant_mood",
        F.round("avg_energy", 3).alias("avg_energy"),
        F.round("avg_valence", 3).alias("avg_valence"),
        F.round("pct_energetic", 1).alias("pct_energetic"),
        F.round("pct_melancholic", 1).alias("pct_melancholic"),
        F.col("dominant_time_of_day").alias("time_of_day"),
    )


def weekly_mood(daily: DataFrame, keys: Sequence[str] = (), n: int = WEEKLY_DAYS) -> DataFrame:
    """Weekly brief input: last ``n`` active days."""
    return latest_days(daily, n, keys).select(
        *keys, "played_date", "total_plays", "dominant_mood", "avg_energy", "avg_valence",
        "pct_energetic", "pct_melancholic", "pct_peaceful", "pct_neutral",
        "dominant_time_of_day")


def _text(c) -> F.Column:
    """Python-style text of a value (doubles in shortest form, null as None)."""
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def weekly_brief(week: DataFrame, artists: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The weekly brief's data text per key: one line per recent day (newest
    first) and the top artists as ``"name (n plays)"`` joined by ", ".

    Inputs are already bounded per key (7 days, 5 artists), so collecting
    them per key is safe.
    """
    line = F.format_string(
        "- %s: %s songs, dominant mood: %s, energy: %s, valence: %s, listened mostly: %s",
        date_text("played_date"), _text("total_plays"), _text("dominant_mood"),
        _text("avg_energy"), _text("avg_valence"), _text("dominant_time_of_day"))
    days = (week.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct(F.col("played_date").alias("d"), line.alias("l"))))
                 .alias("_days"))
            .select(*keys, F.array_join(F.transform(F.reverse("_days"), lambda x: x["l"]), "\n")
                    .alias("days_summary")))
    item = F.format_string("%s (%s plays)", F.col("artist_clean"), F.col("plays").cast("string"))
    arts = (artists.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct((-F.col("plays")).alias("o"),
                                                      F.col("artist_clean").alias("a"),
                                                      item.alias("t")))).alias("_a"))
            .select(*keys, F.array_join(F.transform("_a", lambda x: x["t"]), ", ").alias("artists_summary")))
    out = attach(days, arts, keys)
    return out.select(
        *keys, "days_summary", F.coalesce("artists_summary", F.lit("")).alias("artists_summary"),
        F.concat(F.lit("Daily mood breakdown:\n"), F.col("days_summary"),
                 F.lit("\n\nTop artists this week:\n"),
                 F.coalesce("artists_summary", F.lit(""))).alias("brief"))


def dashboard_metrics(timeline: DataFrame, card: DataFrame) -> DataFrame:
    """Display figures: per timeline day the energy bar width
    (``min(avg_energy*100, 100)``), and the card's energy percent
    (``Math.round(avg_energy*100)`` = floor(x + 0.5))."""
    pct = card.select(F.floor(F.col("avg_energy").cast("double") * 100 + 0.5).cast("bigint")
                      .alias("energy_pct")).scalar()
    return timeline.select(
        "date",
        F.least(F.col("avg_energy") * 100.0, F.lit(100.0)).alias("energy_bar_width"),
        pct.alias("card_energy_pct"))


def _sections(rows: DataFrame, name: str, fields: dict, order: Sequence[F.Column] | None) -> DataFrame:
    """Rows (section, position, json) of one section; without an order the
    position is null (an unbounded section, ordered by its own fields)."""
    body = F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})
    position = F.row_number().over(Window.orderBy(*order)) if order else F.lit(None)
    return rows.select(F.lit(name).alias("section"), position.cast("bigint").alias("position"), body.alias("json"))


def dashboard_sections(timeline: DataFrame, top_artists: DataFrame, time_counts: DataFrame,
                       card: DataFrame, report: DataFrame, matches: DataFrame) -> DataFrame:
    """The dashboard document as rows (section, position, json), so that no
    section is cut and none is gathered in one string.

    Positions number the bounded sections (14 days, 10 artists, 4 buckets, one
    card, one report).  ``taste_tribe`` holds every match; its consumers order
    it by similarity (descending) and username.  Without a profile the card
    is ``{}`` and there are no matches; without a report its text is ''.
    """
    c = F.col
    fields = F.struct("top_mood", c("avg_energy").cast("double").alias("avg_energy"),
                      c("avg_valence").cast("double").alias("avg_valence"), "total_plays", "days_active")
    cards = card.agg(F.coalesce(F.max(F.to_json(fields, {"ignoreNullFields": "false"})), F.lit("{}")).alias("json"))
    return (_sections(timeline, "mood_timeline", {k: c(k) for k in (
                "date", "total_plays", "dominant_mood", "avg_energy", "avg_valence", "pct_energetic",
                "pct_melancholic", "time_of_day")}, [c("date").desc()])
            .unionByName(_sections(top_artists, "top_artists", {"artist": c("artist_clean"), "plays": c("plays")},
                                   [c("plays").desc(), c("artist_clean")]))
            .unionByName(_sections(time_counts, "time_distribution", {"time": c("time_of_day"), "plays": c("plays")},
                                   [c("plays").desc(), c("time_of_day")]))
            .unionByName(cards.select(F.lit("fingerprint").alias("section"), F.lit(1).cast("bigint").alias("position"), "json"))
            .unionByName(_sections(report, "weekly_report", {"text": c("latest_report")}, [c("latest_report")]))
            .unionByName(_sections(matches, "taste_tribe", {k: c(k) for k in (
                "username", "similarity", "top_mood", "avg_energy", "days_active")}, None)))


DASHBOARD_FIELDS = (
    "date string, total_plays bigint, dominant_mood string, avg_energy double, avg_valence double, "
    "pct_energetic double, pct_melancholic double, time_of_day string, artist string, plays bigint, time string, "
    "top_mood string, days_active bigint, text string, username string, similarity double")


def write_dashboard(sections: DataFrame, path: str) -> None:
    """The document's sink: JSON lines in one folder per section."""
    sections.write.mode("overwrite").partitionBy("section").json(path)


def read_dashboard(spark, path: str) -> DataFrame:
    """The written sections with their fields as columns (null where a section lacks one)."""
    rows = spark.read.schema("position bigint, json string, section string").json(path)
    return rows.select("section", "position", F.from_json("json", DASHBOARD_FIELDS).alias("f")).select("section", "position", "f.*")
