"""Plan shape: the properties the operators are designed to have at scale."""
import re

import pytest

from pyspark.sql import functions as F
from sonora.operators.artists import top_artists_trailing
from sonora.operators.daily import stg_daily_mood
from sonora.operators.load import clean_incoming, dedup_events
from sonora.operators.staging import stg_listening_events
from sonora.plans.catalog import QUERIES
from sonora.plans.warehouse import Warehouse
from sonora.sources.testdata import adapted_events
from tests.conftest import SF_SMALL

SKIP = {"incremental_load_stream"}  # runs a stream while building


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: executed(fn(spark, SF_SMALL)) for name, fn in QUERIES.items() if name not in SKIP}


@pytest.fixture(scope="module")
def built(spark):
    """Plans of the stored tables' builders, over views that are not stored."""
    out = {}
    for keys in ((), ("user_id",)):
        w = Warehouse(spark, SF_SMALL, keys)
        raw = w.build_raw()
        stg = stg_listening_events(raw, keys)
        features = w.build_features(stg)
        daily = w.build_daily(stg, features)
        out |= {(n, keys): executed(df) for n, df in (("raw", raw), ("features", features), ("daily", daily),
                                                      ("profiles", w.build_profiles(daily, stg)))}
    return out


def test_builders_have_no_nested_loop_and_no_python(built):
    assert [k for k, p in built.items() if re.search("BroadcastNestedLoopJoin|CartesianProduct|EvalPython|InPandas", p)] == []


def test_builders_read_the_events(built):
    assert [k for k, p in built.items() if "events.parquet" not in p] == []


def test_a_nested_loop_join_would_be_seen(spark):
    w = Warehouse(spark, SF_SMALL)
    stg = stg_listening_events(w.build_raw(), ())
    joined = stg.join(w.build_features(stg).withColumnRenamed("track_name", "t"), F.col("track_name") > F.col("t"))
    assert "BroadcastNestedLoopJoin" in executed(joined) or "CartesianProduct" in executed(joined)


def test_trailing_ranking_has_no_window_over_all_counts(spark):
    w = Warehouse(spark, SF_SMALL, ("user_id",))
    plan = executed(top_artists_trailing(stg_listening_events(w.build_raw(), ("user_id",)), ("user_id",)))
    assert "max(played_date" in plan and not re.search(r"Window \[max\(", plan)


def test_no_nested_loop_or_cartesian_joins(plans):
    bad = [n for n, p in plans.items() if "BroadcastNestedLoopJoin" in p or "CartesianProduct" in p]
    assert bad == []


def test_no_python_evaluation(plans):
    bad = [n for n, p in plans.items() if re.search(r"(Arrow|Batch)EvalPython|FlatMap(Co)?GroupsInPandas", p)]
    assert bad == ["similar_users_all"]  # NumPy products of blocks


def test_dedup_combines_before_the_shuffle(spark):
    df = dedup_events(clean_incoming(adapted_events(spark, SF_SMALL)), ["event_id"])
    plan = executed(df)
    below_exchange = plan.split("Exchange hashpartitioning", 1)[1]
    assert "partial_min_by" in below_exchange


def test_daily_rollup_combines_plays_before_the_join(spark):
    w = Warehouse(spark, SF_SMALL)
    plan = executed(stg_daily_mood(w.stg, w.features))
    # plays are counted per (day, track, day part) map-side before any join
    assert re.search(r"HashAggregate\(keys=\[played_date#\d+L?, track_name#\d+, time_of_day#\d+\], "
                     r"functions=\[partial_count", plan)


def test_event_scan_reads_only_needed_columns(spark):
    plan = executed(adapted_events(spark, SF_SMALL))
    scan = re.search(r"FileScan parquet \[([^\]]*)\].*?events\.parquet", plan)
    assert scan and set(scan.group(1).split(",")) == {
        f"{c}#{n}" for c, n in re.findall(r"(\w+)#(\d+L?)", scan.group(1))}
    cols = {c for c, _ in re.findall(r"(\w+)#(\d+)", scan.group(1))}
    assert cols == {"event_id", "ts", "user_id", "props"}


def test_similarity_has_no_join(plans):
    for name in ("similar_users", "match_list", "cosine_similarity"):
        assert "Join" not in plans[name], name
