"""Properties and hand-made rows of the composite plans."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallyloom.operators.joins import full_merge
from tallyloom.plans import balance as B
from tallyloom.plans import demand, incremental, marts, pricing, quality, scd
from tallyloom.sinks import tables as W
from tallyloom.sinks.versions import VersionedTable


def d(text):
    return F.lit(text).cast("date")


@pytest.fixture
def history(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-20')) AS day").crossJoin(spark.range(6))
    kept = days.where("pmod(xxhash64(day, id), 5) > 1")
    return kept.select(F.col("id").alias("key"), "day", (F.pmod(F.xxhash64("id", "day"), F.lit(3))).cast("string").alias("attr"))


def check_tiling(versions, key="key"):
    """Periods of a key follow each other without gap or overlap, the newest is open."""
    by_key = {}
    for r in versions.collect():
        by_key.setdefault(r[key], []).append((r.start_date, r.end_date))
    for periods in by_key.values():
        periods.sort()
        for (s1, e1), (s2, _) in zip(periods, periods[1:]):
            assert s1 <= e1 and (s2 - e1).days == 1
        assert periods[-1][1] == date(2400, 1, 1)


def test_scd2_periods_tile_time(history):
    check_tiling(scd.scd2_build(history, ["key"], ["attr"], "day"))


@pytest.mark.parametrize("split", ["2024-01-01", "2024-01-07", "2024-01-13", "2024-01-19"])
def test_scd2_apply_equals_one_build(history, rows, split):
    columns = ["key", "attr", "start_date", "end_date", "hash_id"]
    build = lambda df: scd.scd2_build(df, ["key"], ["attr"], "day").select(*columns)
    applied = scd.scd2_apply(build(history.where(F.col("day") <= d(split))), build(history.where(F.col("day") > d(split))), ["key"])
    assert rows(applied) == rows(build(history))
    check_tiling(applied)


def test_scd2_first_row_of_a_day_counts(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-01 05:00:00", "a"), (1, "2024-01-01 09:00:00", "b"), (1, "2024-01-02 01:00:00", "a")], "k int, t string, v string")
    got = scd.scd2_build(df.withColumn("t", F.col("t").cast("timestamp")), ["k"], ["v"], "t")
    assert rows(got, "v", "start_date", "end_date") == [("a", date(2024, 1, 1), date(2400, 1, 1))]


def test_presence_periods_tile_time(history):
    check_tiling(scd.scd2_presence(history, ["key"], "day", "2024-01-20"))


def test_soft_delete_and_in_out(spark, rows):
    target = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "k int, is_delete int").withColumn("end_date", d("2400-01-01"))
    got = scd.soft_delete(target, spark.createDataFrame([(1,)], "k int"), ["k"], "2024-01-05")
    assert rows(got, "k", "is_delete", "end_date") == [(1, 0, date(2400, 1, 1)), (2, 1, date(2024, 1, 5)), (3, 1, date(2400, 1, 1))]
    snaps = spark.createDataFrame([(1, "2024-01-01"), (1, "2024-01-02"), (2, "2024-01-01"), (3, "2024-01-02")], "k int, d string")
    snaps = snaps.withColumn("d", F.col("d").cast("date"))
    assert rows(scd.in_out_diff(snaps, ["k"], "d", "2024-01-01", "2024-01-02")) == [(2, "OUT"), (3, "IN")]


def test_balance_is_opening_plus_movements(spark, rows):
    moves = spark.createDataFrame(
        [(1, "2024-01-02", 5.0), (1, "2024-01-02", 1.0), (1, "2024-01-04", -6.0), (1, "2024-01-06", 2.0), (1, "2024-01-07", -2.0)], "k int, d string, q double"
    ).withColumn("d", F.col("d").cast("date"))
    opening = spark.createDataFrame([(1, "2024-01-01", 10.0)], "k int, d string, q double").withColumn("d", F.col("d").cast("date"))
    got = B.balance_from_movements(moves, ["k"], "d", "q", "2024-01-08", opening)
    assert [r[0] for r in rows(got.select(F.concat_ws(":", F.day("calday"), "balance")))] == [f"{i}:{b}" for i, b in zip(range(1, 9), [10.0, 16.0, 16.0, 10.0, 10.0, 12.0, 10.0, 10.0])]
    no_opening = B.balance_from_movements(moves, ["k"], "d", "q", "2024-01-08")
    # zero from the 4th and again from the 7th on: only its first day is kept
    assert [r[0] for r in rows(no_opening.select(F.concat_ws(":", F.day("calday"), "balance")))] == ["2:6.0", "3:6.0", "4:0.0", "6:2.0"]


BANDS = [("1", 0, 30), ("2", 30, 90), ("3", 90, 720)]


def test_fifo_aging_sums_to_stock(spark):
    stock = spark.range(40).select(F.col("id").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(50)) + 1).cast("double").alias("stock_qty"))
    stock = stock.withColumn("stock_value", F.col("stock_qty") * 3)
    receipts = spark.range(200).select(
        F.pmod("id", F.lit(37)).alias("k"),
        F.date_sub(d("2024-06-30"), F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(600)).cast("int")).alias("gr_date"),
        F.pmod(F.xxhash64("id"), F.lit(20)).cast("double").alias("gr_qty"),
    ).withColumn("gr_value", F.col("gr_qty") * 3)
    aged = B.fifo_aging(stock, receipts, ["k"], "2024-06-30", BANDS, "9")
    sums = aged.groupBy("k").agg(F.sum("aging_qty").alias("q"), F.sum("aging_value").alias("v")).join(stock, "k")
    assert sums.count() == 40
    assert sums.where("abs(q - stock_qty) > 1e-6 OR abs(v - stock_value) > 1e-6").count() == 0


def test_fifo_aging_golden(spark, rows):
    stock = spark.createDataFrame([(1, 10.0, 100.0), (2, 5.0, 50.0), (3, 4.0, 90.0)], "k int, stock_qty double, stock_value double")
    receipts = spark.createDataFrame(
        [(1, "2024-06-29", 4.0, 40.0), (1, "2024-05-01", 3.0, 30.0), (3, "2024-06-30", 6.0, 60.0)], "k int, g string, gr_qty double, gr_value double"
    ).withColumn("gr_date", F.col("g").cast("date")).drop("g")
    aged = B.fifo_aging(stock, receipts, ["k"], "2024-06-30", BANDS, "9")
    assert rows(aged, "k", "band_id", "flag", "aging_days", "aging_qty", "aging_value") == [
        (1, "1", 1, 1, 4.0, 40.0),
        (1, "2", 1, 60, 3.0, 30.0),
        (1, "9", 2, 721, 3.0, 30.0),
        (2, "9", 1, 721, 5.0, 50.0),
        (3, "1", 1, 0, 4.0, 60.0),
        (3, "9", 3, 721, 0.0, 30.0),
    ]


def test_rolling_cost_falls_back_to_longer_horizon(spark, rows):
    costs = spark.createDataFrame([(1, "2024-01-01", 20.0, 2.0), (1, "2024-01-05", 9.0, 0.0)], "k int, d string, c double, q double")
    got = B.rolling_cost(costs.withColumn("d", F.col("d").cast("date")), ["k"], "d", "c", "q", [2, 6], "2024-01-06")
    values = {str(r.calday)[-2:]: r.unit_value for r in got.collect()}
    assert values["01"] == 10.0 and values["03"] == 10.0 and values["05"] == 14.5


def today_row(**change):
    base = dict(k=1, first_day=date(2023, 1, 1), base_qty=5.0, promo_qty=0.0, coupon_qty=0.0, stock_qty=3.0, unit_cost=1.0, pct_95=0.0, has_gift=False, is_component=False)
    return Row(**(base | change))


@pytest.mark.parametrize(
    "change, want, note",
    [
        ({}, 5.0, None),
        ({"base_qty": 100.0}, 11.5, None),  # bound: q3 + 1.5 IQR of 1..10
        ({"base_qty": 100.0, "pct_95": 60.0}, 60.0, None),  # the group bound widens it
        ({"base_qty": 100.0, "pct_95": 60.0, "unit_cost": 400_000.0}, 11.5, None),  # not for costly items
        ({"coupon_qty": 3.0}, 5.5, None),  # promotion: mean of 1..10
        ({"has_gift": True}, 5.5, None),
        ({"base_qty": 0.0, "stock_qty": 0.0}, 5.5, None),  # out of stock
        ({"base_qty": -2.0}, 0.0, None),
        ({"first_day": date(2024, 1, 1)}, 0.03, demand.INITIAL_NOTE),
        ({"first_day": date(2024, 1, 1), "is_component": True}, 5.0, None),
    ],
)
def test_correct_day_rules(spark, change, want, note):
    history = spark.createDataFrame([(1, date(2024, 1, i), float(i), 0) for i in range(1, 11)], "k int, calday date, corrected_qty double, is_oos int")
    got = demand.correct_day(spark.createDataFrame([today_row(**change)]), history, ["k"], "2024-01-20").first()
    expected = 14.5 if want == 11.5 else want  # q1 3.25, q3 7.75 -> 7.75 + 1.5 * 4.5
    assert got.corrected_qty == pytest.approx(expected) and got.note == note


def test_correct_day_inactive(spark):
    history = spark.createDataFrame([(1, date(2024, 1, i), 1.0, 1) for i in range(1, 30)], "k int, calday date, corrected_qty double, is_oos int")
    got = demand.correct_day(spark.createDataFrame([today_row(base_qty=0.0, stock_qty=0.0)]), history, ["k"], "2024-01-30").first()
    assert (got.inactive_range, got.corrected_qty, got.note) == (30, 0.0, demand.INACTIVE_NOTE)


def test_outlier_loop_feeds_on_its_own_output(spark, tmp_path):
    table = str(tmp_path / "corrected")
    keys = [1, 2]
    seed = spark.createDataFrame([(date(2024, 1, i), k, 10.0, 0) for i in range(1, 11) for k in keys], "calday date, k int, corrected_qty double, is_oos int")
    W.replace_days(W.align_schema(seed, f"calday DATE, k INT, {demand.CORRECTED_SCHEMA}"), table, "calday")
    rows = [today_row(k=k, base_qty=0.0, stock_qty=0.0).asDict() | {"calday": date(2024, 1, i)} for i in range(11, 14) for k in keys]
    demand.outlier_correct(spark.createDataFrame([Row(**r) for r in rows]), table, ["k"], date(2024, 1, 11), date(2024, 1, 13))
    got = W.read_table(spark, table).where("calday >= DATE'2024-01-11'")
    assert got.count() == 6 and got.where("abs(corrected_qty - 10) > 1e-9").count() == 0


def outlier_input(spark, first, last):
    """Three keys with their own habits, a promotion and days without stock; deterministic."""
    r = random.Random(9)
    rows = []
    for i in range(1, 29):
        for k in (1, 2, 3):
            sold = float(r.choice((0, 3, 5, 8, 60))) if k < 3 else 0.0
            row = today_row(k=k, base_qty=sold, coupon_qty=sold if r.random() < 0.2 else 0.0, stock_qty=0.0 if k == 3 else float(r.choice((0, 4))), first_day=date(2024, 1, 1) if k == 2 else date(2023, 1, 1))
            rows.append(Row(**(row.asDict() | {"calday": date(2024, 2, i)})))
    return spark.createDataFrame(rows).where(F.col("calday").between(F.lit(first), F.lit(last)))


RULES = dict(history_days=9, mean_days=5, settle_days=45, inactive_days=6)


def corrected_by_days(spark, daily, history):
    """The same days one after the other, each by the rule for one day."""
    days = sorted(r.calday for r in daily.select("calday").distinct().collect())
    done = history
    for on in days:
        today = demand.correct_day(daily.where(F.col("calday") == F.lit(on)).drop("calday"), done, ["k"], on, **RULES)
        done = spark.createDataFrame(done.unionByName(today.select("calday", "k", "corrected_qty", "is_oos")).collect(), done.schema)
    return done


def test_folded_days_equal_one_pass_per_day_and_resume(spark, tmp_path):
    daily = outlier_input(spark, date(2024, 2, 11), date(2024, 2, 18))
    seed = outlier_input(spark, date(2024, 2, 1), date(2024, 2, 10)).where("k <> 3 OR calday > DATE'2024-02-04'")
    seed = seed.select("calday", "k", F.col("base_qty").alias("corrected_qty"), F.lit(0).alias("is_oos"))
    want = {(r.calday, r.k): r.corrected_qty for r in corrected_by_days(spark, daily, seed).collect()}
    whole, parts = str(tmp_path / "whole"), str(tmp_path / "parts")
    for table in (whole, parts):
        W.replace_days(W.align_schema(seed, f"calday DATE, k INT, {demand.CORRECTED_SCHEMA}"), table, "calday")
    daily = daily.withColumn("k", F.col("k").cast("int"))
    demand.outlier_correct(daily, whole, ["k"], date(2024, 2, 11), date(2024, 2, 18), **RULES)
    for a, b in ((11, 13), (14, 14), (12, 14), (15, 18)):  # goes on from what is written, and may go over days again
        demand.outlier_correct(daily, parts, ["k"], date(2024, 2, a), date(2024, 2, b), **RULES)
    for table in (whole, parts):
        got = W.read_table(spark, table)
        assert {(r.calday, r.k): pytest.approx(r.corrected_qty) for r in got.collect()} == want
        notes = {r.note for r in got.collect()}
    assert demand.INITIAL_NOTE in notes and demand.INACTIVE_NOTE in notes
    assert len(VersionedTable(spark, whole).numbers()) == 2  # one commit for eight days


def test_seasonality_of_the_week_that_applies(spark, rows):
    rates = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0), (3, None, 4.0)], "id int, g string, sell_rate double")
    index = spark.createDataFrame(
        [("a", "2020.53", 2, 9.0), ("a", "2020.53", 1, 1.5), ("a", "2021.01", 1, 7.0), ("a", "2021.53", 1, 8.0), ("b", "2021.01", 1, 0.5)],
        "g string, year_week_apply string, rn int, seasonality_index double",
    )
    got = {on: {r.id: r.seasonality_index for r in demand.with_seasonality(rates, index, ["g"], on).collect()} for on in ("2020-12-31", "2021-01-03", "2021-01-04")}
    assert got == {"2020-12-31": {1: 1.5, 2: 1.0, 3: 1.0}, "2021-01-03": {1: 1.5, 2: 1.0, 3: 1.0}, "2021-01-04": {1: 7.0, 2: 0.5, 3: 1.0}}
    keys = spark.range(1).select(*[demand.iso_week_key(d).alias(d) for d in ("2024-12-30", "2021-01-01", "2026-12-31", "2024-02-01")]).first()
    assert tuple(keys) == ("2025.01", "2020.53", "2026.53", "2024.05")


def test_balances_of_quantity_and_value(spark):
    moves = [(1, date(2024, 1, 2), "5", "50"), (1, date(2024, 1, 4), "-5", "-40"), (1, date(2024, 1, 6), "0", "-10"), (1, date(2024, 1, 9), "1", "1"), (1, date(2024, 1, 10), "-1", "-1")]
    frame = spark.createDataFrame([(k, on, Decimal(q), Decimal(v)) for k, on, q, v in moves], "k int, d date, q decimal(10,4), v decimal(10,2)")
    opening = spark.createDataFrame([(1, date(2024, 1, 1), Decimal("0.0004"), Decimal("0"))], frame.schema)
    got = B.balances_from_movements(frame.where("d >= '2024-01-02'"), ["k"], "d", {"q": 3, "v": None}, "2024-01-01", "2024-01-12", opening)
    days = {r.calday.day: (float(r.q), float(r.v)) for r in got.collect()}
    # the first day with nothing is kept, later ones are not; a value without quantity is something
    assert days == {1: (0.0, 0.0), 2: (5.0, 50.0), 3: (5.0, 50.0), 4: (0.0, 10.0), 5: (0.0, 10.0), 9: (1.0, 1.0)}


def test_bom_explode(spark, rows):
    sales = spark.createDataFrame([("s", 1, 4.0), ("s", 2, 1.0)], "store string, item int, qty double")
    bom = spark.createDataFrame([(1, 2, 3.0, 2.0)], "item int, component_id int, component_quantity double, base_quantity double")
    assert rows(demand.bom_explode(sales, bom, ["store"], "item", "qty"), "item", "qty") == [(1, 4.0), (2, 7.0)]


def test_bom_explode_sums_once(spark, rows):
    """One aggregate: a task does not hold the sums of the direct sales beside those of sales and components."""
    sales = spark.createDataFrame([("s", 1, 4.0), ("s", 1, 2.0), ("t", 1, None), (None, 2, 1.0), ("s", None, 1.0)], "store string, item int, qty double")
    bom = spark.createDataFrame([(1, 2, 3.0, 2.0), (1, 2, 1.0, 2.0), (1, 1, 1.0, 1.0)], "item int, component_id int, component_quantity double, base_quantity double")
    got = demand.bom_explode(sales, bom, ["store"], "item", "qty")
    want = [("s", 1, 12.0), ("s", 2, 12.0), ("s", None, 1.0), ("t", 1, None), ("t", 2, None), (None, 2, 1.0)]
    assert sorted(rows(got, "store", "item", "qty"), key=str) == sorted(want, key=str)
    assert got._jdf.queryExecution().executedPlan().toString().count("HashAggregate") == 2  # both sides of one aggregate


def test_overlap_trim_leaves_no_overlap(spark):
    periods = spark.range(300).select(
        F.pmod("id", F.lit(7)).alias("short"), F.pmod("id", F.lit(14)).alias("long"), "id",
        F.date_add(d("2024-01-01"), F.pmod(F.xxhash64("id"), F.lit(200)).cast("int")).alias("a"),
    ).withColumn("b", F.date_add("a", 60))
    out = sorted((r.short, r.a, r.b) for r in pricing.overlap_trim(periods, ["short", "long"], ["short"], "a", "b", ["id"]).collect())
    for (k1, a1, b1), (k2, a2, _) in zip(out, out[1:]):
        assert a1 <= b1 and (k1 != k2 or b1 < a2)


def test_priority_merge(spark, rows):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, "z"), (2, "w")], "k int, v string")
    assert rows(marts.priority_merge([(1, a), (2, b)], ["k"], [], [F.asc("v")]), "k", "v") == [(1, "x"), (2, "w")]


def shuffled(df):
    """Shuffles of a plan above its topmost generator, which spreads rows to stores."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    spread = next(i for i, line in enumerate(plan) if "Generate" in line)
    return [line for line in plan[:spread] if "Exchange hashpartitioning" in line]


def test_price_waterfall_against_loops(spark):
    r = random.Random(3)
    pick = lambda *values: r.choice(values)
    stores = [(s, pick(1, 2, None), pick("x", "y")) for s in [*range(40), None, 3, 3]] + [(7, 1, "x"), (7, 2, "y")]
    days = [date(2024, m, 1) for m in range(1, 9)]
    prices = set()
    for _ in range(250):
        level = pick("SITE", "GROUP", "LIST")
        key = {"SITE": str(r.randrange(45)), "GROUP": pick("1", "2", "3"), "LIST": pick("x", "y", None)}[level]
        prices.add((level, key, pick(1, 2, 3, None), float(r.randrange(9)), *sorted(r.sample(days, 2))))
    frame = spark.createDataFrame(sorted(prices, key=str), "level string, level_key string, product_id int, price double, valid_from date, valid_to date")
    dim = spark.createDataFrame(stores, "store_id long, grp int, lst string")
    for order in ({"SITE": "store_id", "GROUP": "grp", "LIST": "lst"}, {"GROUP": "grp", "SITE": "store_id", "LIST": "lst"}):
        names, at = list(order), {"SITE": 0, "GROUP": 1, "LIST": 2}
        best = {}
        for level, key, item, price, since, until in prices:
            if level != names[0] and not since <= date(2024, 4, 15) <= until:
                continue
            for s in stores:
                if key is not None and s[at[level]] is not None and str(s[at[level]]) == key:
                    rank = (names.index(level), -since.toordinal(), -until.toordinal(), price)
                    best[s[0], item] = min(best.get((s[0], item), (rank, level)), (rank, level))
        got = pricing.price_waterfall(dim, frame, order, ["store_id", "product_id"], "2024-04-15")
        found = {(x.store_id, x.product_id): ((x.priority - 1, -x.valid_from.toordinal(), -x.valid_to.toordinal(), x.price), x.sale_price_type) for x in got.collect()}
        assert found == best and got.count() == len(best) and len({v[1] for v in best.values()}) > 1
        assert not shuffled(got)


def test_expand_exclusions_against_loops(spark):
    r = random.Random(4)
    pick = lambda *values: r.choice(values)
    stores = [(s, pick(1, 2, None), pick("a", "b")) for s in [*range(30), None, 3]] + [(7, 1, "a"), (7, 2, "b")]
    things = [(i, pick("c", "d")) for i in [*range(6), None, 2]]
    ends = [date(2024, 3, 1), date(2024, 4, 1)]
    some = lambda n, *first: [(*[f() for f in first], r.choice(ends)) for _ in range(n)]
    item = lambda: pick(0, 1, 2, 3, 4, 5, None)
    lists = [
        (2, "site", some(60, lambda: pick(*range(34), None), item)),
        (3, "region", some(5, lambda: pick(1, 2, 9), item)),
        (2, "unit", some(4, lambda: pick("a", "b"), item)),
        (1, "category", some(1, lambda: pick("a", "b"), lambda: pick("c", "d"))),
    ]
    names = {"site": ["store_id", "product_id"], "region": ["region", "product_id"], "unit": ["business_unit", "product_id"], "category": ["business_unit", "category"]}
    kinds = {"store_id": "long", "product_id": "int", "region": "int", "business_unit": "string", "category": "string"}
    loads = {"site": date(2024, 1, 2), "region": date(2024, 1, 3), "unit": date(2024, 1, 1), "category": date(2024, 1, 4)}
    dim, goods = spark.createDataFrame(stores, "store_id long, region int, business_unit string"), spark.createDataFrame(things, "product_id int, category string")
    for used in (lists, lists[:1], lists[1:], lists[:3]):
        rows, frames = [], []
        for priority, level, given in used:
            ddl = ", ".join(f"{c} {kinds[c]}" for c in names[level]) + ", end_date date"
            frame = spark.createDataFrame(given, ddl).withColumns({"note": F.lit(level), "start_date": d("2024-01-01"), "proc_date": F.lit(loads[level])})
            frames.append((priority, frame, level))
            for a, b, end in given:
                at = {"region": 1, "unit": 2, "category": 2}.get(level)
                places = [a] if level == "site" else [s[0] for s in stores if s[at] == a and a is not None]
                goods_of = [t[0] for t in things if t[1] == b] if level == "category" else [b]
                rows += [(s, i, end, priority, loads[level], level) for s in places for i in goods_of]
        want = {}
        for s, i, end, priority, load, level in rows:
            if priority == min(x[3] for x in rows if x[:2] == (s, i)):
                want[s, i, end] = min(want.get((s, i, end), (load, level)), (load, level))
        got = marts.expand_exclusions(frames, dim, goods, [F.asc("proc_date")])
        found = [((x.store_id, x.product_id, x.end_date), (x.proc_date, x.note)) for x in got.collect()]
        assert len(found) == len(want) and dict(found) == want


def test_exclusions_of_classes_are_not_shuffled_by_store(spark):
    dim = spark.createDataFrame([(s, s % 3, "a") for s in range(30)], "store_id long, region int, business_unit string")
    dates = {"note": F.lit("n"), "start_date": d("2024-01-01"), "end_date": d("2024-02-01"), "proc_date": d("2024-01-01")}
    region = spark.createDataFrame([(1, 5), (2, 6)], "region int, product_id int").withColumns(dates)
    got = marts.expand_exclusions([(1, region, "region")], dim, None, [F.asc("proc_date")])
    assert got.count() == 20 and not shuffled(got)


def test_price_waterfall_takes_members_off_by_place(spark):
    """Stores with a price of their own leave the run of their class by their place; rows that multiply are not joined to few tasks."""
    dim = spark.createDataFrame([(s, 1) for s in range(6)], "store_id long, grp int")
    given = [("SITE", "2", 7, 1.0), ("SITE", "5", 7, 2.0), ("GROUP", "1", 7, 3.0), ("SITE", "0", 8, 4.0)]
    prices = spark.createDataFrame(given, "level string, level_key string, product_id int, price double").withColumns({"valid_from": d("2024-01-01"), "valid_to": d("2024-12-31")})
    got = pricing.price_waterfall(dim, prices, {"SITE": "store_id", "GROUP": "grp"}, ["store_id", "product_id"], "2024-04-15")
    assert sorted((r.product_id, r.store_id, r.price) for r in got.collect()) == [(7, 0, 3.0), (7, 1, 3.0), (7, 2, 1.0), (7, 3, 3.0), (7, 4, 3.0), (7, 5, 2.0), (8, 0, 4.0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "array_except" not in plan and "REPARTITION_BY_NUM" in plan


def test_exclusions_take_members_off_by_place(spark):
    """No list of stores is hashed for a row, rows that multiply are not joined to few tasks, and nothing above the generator keeps rows per store."""
    dim = spark.createDataFrame([(s, s % 3, "a") for s in range(30)], "store_id long, region int, business_unit string")
    dates = {"note": F.lit("n"), "start_date": d("2024-01-01"), "end_date": d("2024-02-01"), "proc_date": d("2024-01-01")}
    region = spark.createDataFrame([(1, 5), (2, 6)], "region int, product_id int").withColumns(dates)
    site = spark.createDataFrame([(1, 5), (28, 5), (99, 5)], "store_id long, product_id int").withColumns(dates)
    got = marts.expand_exclusions([(1, region, "region"), (2, site, "site")], dim, None, [F.asc("proc_date")])
    assert sorted(r.store_id for r in got.where("product_id = 5").collect()) == [*range(1, 30, 3), 99] and got.count() == 21
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "array_except" not in plan and "REPARTITION_BY_NUM" in plan and plan.index("Generate explode") < plan.index("Union")


def test_delivery_calendar_single_day(spark):
    df = spark.createDataFrame([("1",)], "days string")
    got = marts.delivery_calendar(df, F.col("days"), F.lit(0), "2024-01-14").first()  # a Sunday
    assert (got.is_order_date, got.second_delivery_day, got.third_delivery_day) == ("YES", date(2024, 1, 21), date(2024, 1, 28))


def test_promotion_block_offsets(spark, rows):
    df = spark.createDataFrame([("gift", "ZB01", "2024-01-08", "2024-01-12"), ("late", "ZB01", "2024-01-09", "2024-01-12"), ("disc", "ZB10", "2024-01-19", "2024-02-01"), ("near", "ZB10", "2024-01-07", "2024-02-01")], "n string, profile string, s string, e string")
    df = df.select("n", "profile", F.col("s").cast("date").alias("promo_start"), F.col("e").cast("date").alias("promo_end"))
    got = marts.promotion_blocks(df, "2024-01-01")
    assert rows(got, "n", "block_sto", "block_po") == [("disc", 0, 1), ("gift", 1, 1)]


def test_column_sums_golden(spark):
    df = spark.createDataFrame([(1, 25, 85.5, "Alice"), (2, 30, 92.0, "Bob"), (3, 22, 78.5, "Charlie")], "id int, age int, score double, name string")
    assert quality.column_sums(df, "age").first()[0] == '{"age":77}'
    assert quality.column_sums(df, ["age", "score"]).first()[0] == '{"age":77,"score":256.0}'
    assert quality.column_sums(df, "").first()[0] is None


def test_profile_counts_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (None, "bbb"), (1, None)], "n int, s string")
    got = {r.column_name: r for r in quality.column_profile(df).collect()}
    assert (got["n"].null_count, got["n"].distinct_count, got["n"].min_value) == (1, 1, 1)
    assert (got["s"].null_count, got["s"].max_length, got["s"].total_length) == (1, 3, 4)


def test_reconcile_accepts_two_empty_sides(spark):
    empty = spark.createDataFrame([], "a int")
    assert quality.source_target_reconcile(empty, empty, ["a"]).first().status == "Passed"


def test_changed_days_skips_consumed(spark):
    log = spark.createDataFrame(
        [(date(2024, 1, 1), "2024-01-01", "g", "a", date(2024, 1, 1), date(2024, 1, 1)), (date(2024, 1, 3), "2024-01-02,2024-01-03", "g", "a", date(2024, 1, 2), date(2024, 1, 3)), (date(2024, 1, 3), "2024-01-03", "g", "b", date(2024, 1, 3), date(2024, 1, 3))],
        "proc_date date, calday_list string, dataset_affect string, table_affect string, start_date date, end_date date",
    )
    seen = spark.createDataFrame([("m", "t", "g.a", date(2024, 1, 2)), ("m", "t", "g.b", None)], "dataset_affect string, table_affect string, dependency_table string, etl_to date")
    pending = incremental.dependencies(log, seen, "m", "t", "2024-01-04")
    got = incremental.changed_days(log, pending, "2024-01-04").first()
    assert (got.start_date, got.end_date, got.table_etl, got.calday_list) == (date(2024, 1, 2), date(2024, 1, 3), "g.a,g.b", "2024-01-02,2024-01-03")


def test_audit_result_takes_the_target_schema(spark):
    final = spark.createDataFrame([("h", "20240115", 5, 4)], "hub string, proc_date string, streaming_count bigint, landed_count bigint")
    got = quality.audit_result(final, "load_date DATE, source_name STRING, table_name STRING, source_object_count STRING, remark STRING", {"source_name": "EventHub"})
    assert tuple(got.first()) == (date(2024, 1, 15), "EventHub", "h", "5", None)


def test_sell_rate_rules(spark, rows):
    data = [(k, date(2024, 1, i), v, note) for k, v, note in ((1, 2.0, None), (2, 0.0, None), (3, 4.0, demand.INACTIVE_NOTE)) for i in range(1, 11)]
    history = spark.createDataFrame(data, "k int, d date, v double, note string")
    got = demand.sell_rate(history, ["k"], "v", "d", "2024-01-11", (2, 5, 10), note="note")
    assert rows(got, "k", "ma_long", "sell_rate", "sale_trend") == [(1, 2.0, 2.0, 1.0), (2, 0.0, 0.0, 1.0), (3, 4.0, 0.0, 1.0)]


def test_availability_needs_yesterday_for_opening_stock(spark, rows):
    def dated(data, ddl):
        return spark.createDataFrame(data, ddl)

    days = [date(2024, 1, i) for i in (1, 2, 3)]
    listing = dated([(1, d, 5, True, False) for d in days], "k int, calday date, min_stock int, is_active boolean, is_blocked boolean")
    stock = dated([(1, days[0], 6.0), (1, days[2], 2.0)], "k int, calday date, closing_qty double")
    sales = dated([(1, days[0], 1.0, 10.0), (1, days[1], 2.0, 20.0)], "k int, calday date, sale_qty double, revenue double")
    pending = dated([(1, days[2], 3.0)], "k int, calday date, pending_qty double")
    measures = full_merge({"k": stock, "s": sales, "p": pending}, ["k", "calday"])
    got = marts.availability_kpis(listing, measures, ["sale_qty", "revenue"], ["k"], horizon=2)
    assert rows(got, "opening_qty", "sale_qty_2d", "revenue_2d", "dr_count", "dr_sum", "adj_dr") == sorted(
        [(0.0, 1.0, 10.0, 1, 1, 1), (6.0, 3.0, 30.0, 1, 0, 0), (0.0, 2.0, 20.0, 1, 0, 1)], key=str
    )


def test_seasonality_of_groups_without_sales(spark, rows):
    weekly = spark.createDataFrame([("a", 2023, 1, 10.0), ("a", 2023, 2, 30.0)], "k string, calyear int, calweek int, v double")
    weeks = spark.createDataFrame([(2023, w, 52) for w in (1, 2, 3)], "calyear int, calweek int, cnt_isoweek int")
    groups = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    got = demand.seasonality_index(weekly, ["k"], weeks, "v", "2020.01", groups=groups)
    assert rows(got.where("k <> 'a' OR k IS NULL"), "k", "calweek", "seasonality_index") == sorted(
        [(k, w, 1.0) for k in ("b", None) for w in (1, 2, 3)], key=lambda r: tuple((v is None, str(v)) for v in r)
    )
    assert got.where("k = 'a'").count() == 3
