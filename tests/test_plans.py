"""Plan checks: the physical plans keep the properties the design relies on."""

import contextlib
import io
import os

import pytest

import __spark_entry__ as E
from aerolith.plans.catalog import ORACLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_cartesian_products(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_scan_pruned_and_filters_pushed(spark):
    p = plan(E.queries()["silver_measures"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in p
    assert "GreaterThanOrEqual(value,0.0)" in p and "LessThan(value,1000.0)" in p


def test_partial_aggregation_before_shuffle(spark):
    p = plan(E.queries()["daily_fact"](spark, SF), mode="simple")
    assert "partial_sum" in p and "partial_count" in p
    assert p.index("Exchange hashpartitioning") < p.rindex("partial_sum")


def test_feature_windows_are_partitioned_and_joins_broadcast(spark):
    from aerolith.plans import features as FE
    from aerolith.plans.catalog import _daily_base
    df = FE.ml_features(_daily_base(spark, SF), ["magnitud"])   # the derivation behind feature_table
    df.collect()                                   # final adaptive plan
    p = plan(df, mode="simple")
    assert "Exchange SinglePartition" not in p
    assert "Window [" in p and "[magnitud#" in p
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_station_means_aggregates_before_join(spark):
    p = plan(E.queries()["station_means"](spark, SF), mode="simple")
    join = p.index("Join [l_suppkey")
    per_key = p.index("HashAggregate(keys=[l_suppkey")
    partial = p.index("partial_sum(", per_key)
    scan = p.index("FileScan parquet [l_suppkey")
    # printed top-down: join, then the per-station aggregate (final, partial), then the scan
    assert join < per_key < partial < scan


def test_scalar_subquery_instead_of_join(spark):
    p = plan(E.queries()["table_total"](spark, SF), mode="simple")
    assert "Subquery" in p and "Join" not in p


STAR = ["hourly_profile", "wind_means", "rain_means", "weekend_mean", "month_context",
        "corr_matrix", "finding_ratio", "coverage", "feature_table"]


def tree(text):
    """(depth, operator) of the lines of a plan."""
    out = []
    for line in text.splitlines():
        body = line.lstrip(" :+-*(0123456789)")
        if body:
            out.append((len(line) - len(line.lstrip(" :+-")), body))
    return out


def final_plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", STAR)
def test_star_joins_sum_the_fact_before_it_moves(spark, name):
    """With no static broadcast, every row of the fact that reaches an exchange is
    a partial sum by the join key, and the joins end as broadcast joins."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = E.queries()[name](spark, SF.replace("0.001", "0.01"))
        df.collect()
        lines = tree(final_plan(df))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert any("BroadcastHashJoin" in b for _, b in lines) or name in ("hourly_profile",)
    assert not any("SortMergeJoin" in b for _, b in lines)
    scans = [i for i, (_, b) in enumerate(lines) if b.startswith("FileScan")]
    assert scans
    for i in scans:
        depth, between = lines[i][0], []
        for d, b in reversed(lines[:i]):
            if d < depth:
                depth = d
                if b.startswith("Exchange"):
                    break
                between.append(b)
        assert any(b.startswith("HashAggregate") for b in between), lines[i]


def test_target_keys_reach_the_scan(spark):
    p = plan(E.queries()["wind_means"](spark, SF))
    assert "EqualTo(event_type,click)" in p or "In(event_type, [click" in p


def test_medians_hold_no_group(spark):
    df = E.queries()["station_medians"](spark, SF)
    df.collect()
    p = plan(df)
    assert "percentile" not in p and "median" not in p.replace("mediana", "")


def test_newest_cut_is_a_pushed_literal(spark):
    """The cut is found from counts per range: no window over the data's values."""
    from aerolith.operators.topn import cut_off
    from aerolith.sources.tables import read_table
    o = read_table(spark, SF, "orders", ["o_orderkey", "o_orderdate"])
    cut = cut_off(o, 200, "o_orderdate", True)
    near = o.where(o.o_orderdate >= cut)
    assert "GreaterThanOrEqual(o_orderdate" in plan(near)
    assert 200 <= near.count() < o.count()
    assert cut_off(o, o.count() + 1, "o_orderdate", True) is None
