"""Plan guards over every registered query (sf0.001): no Cartesian or
nested-loop joins, no Python UDF operators, filters reaching the scan."""

import os

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_pairs_no_python(spark, name):
    plan = plan_text(queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def test_trend_runs_has_no_join_and_pushes_dates(spark):
    plan = plan_text(queries()["trend_runs"](spark, SF))
    assert "Join" not in plan
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan


def test_cooccurrence_never_self_joins_the_bridge(spark):
    # the only joins are bridge rows to per-group / per-node aggregates
    plan = plan_text(queries()["neighbor_smoothing"](spark, SF))
    assert "CartesianProduct" not in plan


@pytest.mark.parametrize("name,needles", [
    ("moving_average", ["EqualTo(l_suppkey,1)", "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)",
                        "LessThan(l_shipdate,1999-01-01T00:00)"]),
    ("top_volume", ["GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)", "LessThan(l_shipdate,1999-01-01T00:00)"]),
])
def test_filters_reach_the_scan(spark, name, needles):
    df = queries()[name](spark, SF)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    pushed = " ".join(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    for needle in needles:
        assert needle in pushed, (name, needle)


@pytest.mark.parametrize("name", ["entity_stats", "top_items", "group_sums", "entity_features"])
def test_point_lookups_filter_below_distinct_and_aggregate(spark, name, monkeypatch):
    """The target's key filter stands below the distinct of the bridge and the
    roll-up of the lines, in every frame that is written on the way."""
    from rawhouse.operators import entity
    from rawhouse.plans import queries as Q

    plans = []

    def spy(original):
        def materialize(df, label="materialized"):
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
            return original(df, label)

        return materialize

    monkeypatch.setattr(Q, "materialize", spy(Q.materialize))
    monkeypatch.setattr(entity, "materialize", spy(entity.materialize))
    out = queries()[name](spark, SF)
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    bridge = plans[0]
    assert "Supplier#000000001" in bridge and "LeftSemi" in bridge
    assert bridge.index("Aggregate") < bridge.index("Join LeftSemi")
    for plan in plans[1:]:
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Aggregate [l_orderkey" in line:
                below = []
                depth = len(line) - len(line.lstrip(" :+-"))
                for other in lines[i + 1 :]:
                    if len(other) - len(other.lstrip(" :+-")) <= depth:
                        break
                    below.append(other)
                assert any("LeftSemi" in x for x in below), plan


def test_peers_are_found_once(spark, monkeypatch):
    from rawhouse.operators import entity

    calls = []
    original = entity.cluster_peers
    monkeypatch.setattr(entity, "cluster_peers", lambda *a, **k: calls.append(1) or original(*a, **k))
    queries()["similar_entities"](spark, SF).collect()
    assert calls == [1]
