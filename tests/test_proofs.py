"""Every proof is compared with its oracle here.

``TALLYLOOM_QUICK_PROOFS=1`` compares a part of them (``tools/check_proofs.py`` gives the differences).
"""

import importlib.util
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
QUICK = """agg_count_distinct_if agg_percentile_exact jn_wildcard_rule jn_band jn_temporal_validity win_lag_lead win_running_total
win_topn_quota fn_normalize_numeric_text set_unpivot x_scd2_build x_scd2_apply x_scd2_presence x_running_balance x_fifo_aging
x_rolling_cost x_overlap_trim x_price_waterfall x_basket_counts x_seasonality_index dq_json_contract dq_column_profile wr_upsert
str_valid_invalid_split win_running_total_nulls
win_lag_lead_nulls win_share_nulls win_best_nulls win_topn_wide_quota agg_percentile_nulls agg_percentile_approx
dq_json_contract_nested dq_reconcile_doubles wr_replace_where_empty""".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def checker():
    path = os.path.join(os.path.dirname(__file__), "..", "tools", "check_proofs.py")
    spec = importlib.util.spec_from_file_location("check_proofs", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def duck(checker):
    con = duckdb.connect()
    for name in checker.NAMES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def test_names_and_oracles():
    queries, oracles = entry_point.queries(), entry_point.oracle_sql()
    assert set(oracles) <= set(queries)
    own = {n for n in queries if not re.match(r"op\d+_|pipeline$", n)}
    assert own == set(entry_point.PLANS)
    assert own <= set(oracles)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["l_suppkey", "calday", "balance"]


@pytest.mark.parametrize("name", QUICK if os.environ.get("TALLYLOOM_QUICK_PROOFS") else list(entry_point.PLANS))
def test_matches_oracle(spark, duck, checker, name):
    df = entry_point.queries()[name](spark, SF)
    got = checker.canon(df.collect(), df.columns)
    assert got
    sql = entry_point.oracle_sql().get(name)
    if sql:
        res = duck.execute(sql)
        names = [c[0] for c in res.description]
        assert sorted(names) == sorted(df.columns)
        assert got == checker.canon(res.fetchall(), names)


@pytest.mark.parametrize("name", ["jn_range_trailing", "jn_band", "jn_wildcard_rule", "jn_interval_carry_forward", "x_rolling_cost", "x_expand_exclusions", "x_price_waterfall", "x_running_balance"])
def test_no_nested_loops(spark, name):
    plan = entry_point.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = entry_point.queries()["flt_day_slice"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "props" not in plan.split("ReadSchema:")[1]


@pytest.mark.parametrize(
    "name, table, scans",
    [
        ("x_price_waterfall", "lineitem", 1),
        ("x_margin_detail", "lineitem", 1),
        ("x_margin_detail", "part", 1),
        ("x_wide_daily_mart", "lineitem", 1),
        ("x_wide_daily_mart", "orders", 1),
        ("jn_full_multiway", "lineitem", 1),
        ("x_replenishment_demand", "lineitem", 1),
        ("x_least_positive_cost", "events", 1),
        ("x_seasonality_index", "lineitem", 3),  # the weekly sums, and the first and the last day of the calendar
        ("x_fifo_aging", "lineitem", 2),  # stock and receipts are two inputs
    ],
)
def test_scans_of_a_fact(spark, name, table, scans):
    df = entry_point.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan()
    files = [str(plan.collectLeaves().apply(i).toString()) for i in range(plan.collectLeaves().size())]
    column = {"lineitem": "l_", "orders": "o_", "part": "p_", "events": "event"}[table]
    assert sum(f.startswith("Relation [") and f.split("[")[1].startswith(column) or f.startswith("Relation") and f"[{column}" in f for f in files) <= scans


def test_percentile_proof_sorts_no_code(spark, tmp_path):
    """The answers are broadcast: no task sorts all rows of a code."""
    rows = [(flag, float(v)) for v in range(100) for flag in ("A", "N", None)]
    spark.createDataFrame(rows, "l_returnflag string, l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry_point.queries()["agg_percentile_approx"](spark, str(tmp_path))
        assert "Sort" not in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r) for r in df.collect()) == [("A", True, True, True), ("N", True, True, True)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
