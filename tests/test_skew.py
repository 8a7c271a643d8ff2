"""Joins with a hot key, and the nearest of many listeners at once."""
import random

import pytest
from pyspark.sql import functions as F

from sonora.operators import daily, similarity as sim
from sonora.operators.skew import hot_keys, split_join


@pytest.fixture()
def shuffled(spark):
    """Sort-merge joins over 32 partitions, none divided or merged at run time."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def plays(spark, n=30_000):
    """Plays of which every third has no title."""
    name = F.when(F.col("id") % 3 == 0, "").otherwise(F.concat(F.lit("track "), F.col("id") % 5000))
    return spark.range(n).select(F.col("id").alias("play_id"), name.alias("track_name"))


def test_a_third_of_plays_without_title_is_divided(shuffled):
    left = plays(shuffled)
    right = left.select("track_name").distinct().crossJoin(shuffled.range(2).select(F.col("id").alias("artist")))
    tasks = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
    sizes, plain = tasks(split_join(left, right, "track_name", ["play_id"])), tasks(left.join(right, "track_name"))
    assert sum(sizes) == sum(plain) == 60_000
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
    assert plain[-1] > 3 * plain[len(plain) // 2]


def test_hot_keys_are_few_and_bounded(spark):
    hot = {r.track_name: r._parts for r in hot_keys(plays(spark), "track_name").collect()}
    assert hot == {"": 334}
    assert hot_keys(plays(spark).limit(0), "track_name").count() == 0


def test_split_join_is_the_plain_join(spark):
    rng = random.Random(3)
    names = [None, "", "", "", "a", "b", "c", "never"]
    left = spark.createDataFrame([(k, rng.choice(names)) for k in range(300)], "play_id long, track_name string")
    right = spark.createDataFrame([(n, k) for n in [None, "", "a", "b", "z"] for k in range(3)], "track_name string, f int")
    rows = lambda df: sorted(df.select("play_id", "track_name", "f").collect())
    for share in (1 / 1000, 0.2, 1.0):
        assert rows(split_join(left, right, "track_name", ["play_id"], share)) == rows(left.join(right, "track_name"))
    assert split_join(left.limit(0), right, "track_name", ["play_id"]).count() == 0
    assert split_join(left, right.limit(0), "track_name", ["play_id"]).count() == 0


def test_events_with_features_divides_hot_names(spark):
    stg = plays(spark, 300).withColumns({c: F.lit("x") for c in ("artist_clean", "played_date", "time_of_day", "played_day_of_week")})
    stg = stg.withColumn("played_hour", F.lit(1))
    rows = [("", 0.1, "neutral"), ("", 0.2, None), ("track 1", 0.3, "intense")]
    features = spark.createDataFrame(rows, "track_name string, energy double, mood_label string")
    features = features.withColumns({c: F.lit(0.5) for c in ("valence", "tempo", "danceability")})
    out = daily.events_with_features(stg, features)
    assert "_part" in out._jdf.queryExecution().executedPlan().toString() and "_part" not in out.columns
    counts = {(r.track_name, r.mood_label): r["count"] for r in out.groupBy("track_name", "mood_label").count().collect()}
    assert counts == {("", "neutral"): 100, ("track 1", "intense"): 1}


def profiles(spark, n=60):
    rng = random.Random(5)
    rows = [(f"u{k:03d}", [round(rng.random(), 1) for _ in range(4)]) for k in range(n)]
    rows += [("zero", [0.0] * 4), ("none", None), ("hole", [0.5, None, 0.5, 0.5]), ("twin a", rows[0][1]), ("twin b", rows[0][1])]
    df = spark.createDataFrame(rows, "username string, embedding array<double>")
    return df.withColumns({"top_mood": F.lit("x"), "avg_energy": F.lit(0.1), "avg_valence": F.lit(0.1), "days_active": F.lit(1)})


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_all_targets_equal_each_target(spark, block_rows):
    p = profiles(spark).cache()
    asked = p.filter(F.col("username").isin("u000", "u007", "zero", "none", "hole", "twin a"))
    found = {}
    for r in sim.similar_users_of(asked, p, block_rows=block_rows).collect():
        found.setdefault(r.target, []).append((r.rank, r.username, r.similarity))
    assert len(found) == 6
    for target, got in found.items():
        want = sim.similar_users(p, F.lit(target)).collect()
        assert sorted(got) == [(k, r.username, r.similarity) for k, r in enumerate(want, 1)]


def test_all_targets_edges(spark):
    p = profiles(spark, 3)
    assert sim.similar_users_of(p.limit(0), p).count() == 0
    assert sim.similar_users_of(p, p.limit(0)).count() == 0
    one = p.filter("username = 'u001'")
    assert sim.similar_users_of(one, one).count() == 0


def test_ties_round_as_one_target_rounds(spark):
    import numpy as np

    cos = np.array([[0.98765, 0.12345, -0.00005, 0.5, 1.0, 0.99995, 0.00004999]])
    want = spark.createDataFrame([(float(c),) for c in cos[0]], "c double").select((F.round("c", 4) * 10000).cast("decimal(10,0)").cast("int").alias("n"))
    assert sim._rounded4(cos)[0].tolist() == [r.n for r in want.collect()]


def best_by_pairs(targets, rows, top_n):
    """The rows of a cell, by a loop over all pairs."""
    from decimal import ROUND_HALF_UP, Decimal

    found = []
    for target, a in targets:
        scored = []
        for name, b in rows:
            if name == target:
                continue
            dots = [0.0, 0.0, 0.0]
            if a is not None and b is not None and None not in (*a, *b):
                for x, y in zip(a, b):
                    dots = [dots[0] + x * y, dots[1] + x * x, dots[2] + y * y]
            norms = dots[1] ** 0.5 * dots[2] ** 0.5
            cos = dots[0] / norms if norms > 0 else 0.0
            n = int((Decimal(repr(abs(cos))) * 10000).quantize(Decimal(1), ROUND_HALF_UP))
            scored.append((-((n + 5) // 10) if cos > 0 else (n + 5) // 10, name))
        found += [(target, name, -minus) for minus, name in sorted(scored)[:top_n]]
    return sorted(found)


@pytest.mark.parametrize("top_n", [1, 5, 40])
@pytest.mark.parametrize("tile, first", [((7, 11), 6), ((512, 1024), 512)])
def test_cell_equals_all_pairs(monkeypatch, tile, first, top_n):
    import pandas as pd

    monkeypatch.setattr(sim, "TILE", tile)
    monkeypatch.setattr(sim, "FIRST_TILE", first)
    rng = random.Random(8)
    vectors = [[round(rng.random(), 1) for _ in range(3)] for _ in range(40)]
    vectors += [[1 + 0.01 * rng.random() for _ in range(3)] for _ in range(40)] + [[rng.random() - 0.5 for _ in range(3)] for _ in range(20)]
    vectors += [[x * 10.0 ** rng.choice([-161, -158, -120, 110, 140]) for x in v] for v in vectors[:12]]  # squares that lose digits, or are near the largest number
    vectors += [None, None, [0.0] * 3, [0.5, None, 0.5]] + vectors[:15]
    for names in (range(len(vectors)), [rng.randrange(90) for _ in vectors]):  # single names, repeated names
        rows = [(f"u{k}", v) for k, v in zip(names, vectors)]
        asked = rng.sample(rows, len(rows) // 2)
        frame = lambda pairs: pd.DataFrame({"name": [n for n, _ in pairs], "v": [v for _, v in pairs]})
        got = sim._best_of_cell(top_n)(frame(asked), frame(rng.sample(rows, len(rows))))
        assert sorted(zip(got["target"], got["username"], got["tenths"].tolist())) == best_by_pairs(asked, rows, top_n)


def test_cell_holds_no_matrix_of_its_pairs():
    import tracemalloc

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(4)
    block = pd.DataFrame({"name": [f"u{k}" for k in range(4000)], "v": list(rng.random((4000, 4)))})
    tracemalloc.start()
    out = sim._best_of_cell(5)(block, block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 20_000
    assert peak < 4000 * 4000 * 4  # one 32-bit number for each pair


def test_block_without_any_vector(spark):
    p = profiles(spark, 8).cache()
    none = p.filter("username = 'none'")
    key = lambda df: [(r.target, r.rank, r.username, r.similarity) for r in df.orderBy("target", "rank").collect()]
    assert key(sim.similar_users_of(none, p)) == [("none", k, r.username, r.similarity) for k, r in enumerate(sim.similar_users(p, F.lit("none")).collect(), 1)]
    assert {r[2:] for r in key(sim.similar_users_of(p.filter("username <> 'none'"), none))} == {("none", 0.0)}
