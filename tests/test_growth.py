"""Growth by track on literal plays."""
import datetime as dt
import re

from sonora.operators.growth import track_growth

DAY0 = dt.datetime(2024, 2, 25)


def staged(spark, plays):
    rows = [(u, t, DAY0 + dt.timedelta(days=d) if d is not None else None) for u, t, d in plays]
    return spark.createDataFrame(rows, "user_id long, track_name string, played_date timestamp_ntz")


def brute(plays, days):
    last = max(d for _, t, d in plays if t is not None and d is not None)
    out = {}
    for track in {t for _, t, _ in plays if t is not None}:
        on = [d for _, t, d in plays if t == track and d is not None]
        for day in range(min(on), min(max(on) + 2 * days - 1, last) + 1) if on else ():
            recent = sum(day - days < d <= day for d in on)
            before = sum(day - 2 * days < d <= day - days for d in on)
            out[track, day] = (on.count(day), recent, before, recent - before, round(recent / before, 4) if before else None)
    return out


def test_growth_matches_brute_force(spark):
    plays = [(1, "a", 0), (1, "a", 0), (2, "a", 4), (2, "a", 5), (1, "a", 30), (1, "", 2), (1, "", 40), (2, None, 3), (2, "b", 41), (2, "c", None)]
    for days in (1, 3, 7):
        got = {(r.track_name, (r.day - DAY0.date()).days): (r.plays, r.recent, r.before, r.growth, r.ratio)
               for r in track_growth(staged(spark, plays), days=days).collect()}
        assert got == brute(plays, days)


def test_listeners_apart_and_empty(spark):
    plays = [(1, "a", 0), (2, "a", 1), (2, "a", 2)]
    got = {(r.user_id, (r.day - DAY0.date()).days): r.recent for r in track_growth(staged(spark, plays), ("user_id",), 2).collect()}
    assert got == {(1, 0): 1, (1, 1): 1, (1, 2): 0, (2, 1): 1, (2, 2): 2}
    assert track_growth(staged(spark, plays).limit(0)).count() == 0


def test_no_join_and_counts_combine_first(spark):
    plan = track_growth(staged(spark, [(1, "a", 0)]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Join|Cartesian", plan) and "partial_count" in plan


def test_filled_days_are_not_shuffled(spark):
    plan = track_growth(staged(spark, [(1, "a", 0), (1, "a", 40)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange")  # the plan reads from the result down


def test_null_listener_and_long_gaps(spark):
    plays = [(None, "a", 0), (None, "a", 0), (None, "a", 9), (1, "a", 3), (None, "a", 60)]
    got = track_growth(staged(spark, plays), ("user_id",)).collect()
    for user in (None, 1):
        own = [p for p in plays if p[0] == user]
        found = {("a", (r.day - DAY0.date()).days): (r.plays, r.recent, r.before, r.growth, r.ratio) for r in got if r.user_id == user}
        assert found == {k: v for k, v in brute(own + [(0, "b", 60)], 7).items() if k[0] == "a"}
