"""Skew-safe forms against the plain ones, and joins against brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators import aggregates as A
from tallyloom.operators import joins as J
from tallyloom.operators import windows as N
from tallyloom.operators.filters import differs


def test_running_sum_equals_one_window(spark, skewed, rows):
    w = Window.partitionBy("key").orderBy("day", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select("id", F.sum("value").over(w).alias("r"))
    got = N.running_sum(skewed, ["key"], "day", ["id"], "value", "r")
    assert rows(got, "id", "r") == rows(want)


def test_neighbours_equal_lag_and_lead(spark, skewed, rows):
    w = Window.partitionBy("key").orderBy("day", "id")
    want = skewed.select("id", F.lag("value").over(w).alias("p"), F.lead("id").over(w).alias("n"))
    got = N.neighbours(skewed, ["key"], "day", ["id"], previous={"p": "value"}, following={"n": "id"})
    assert rows(got, "id", "p", "n") == rows(want)


def test_neighbours_keep_null_neighbour(spark, rows):
    df = spark.createDataFrame([(1, 1, 1, None), (1, 1, 2, 5), (1, 2, 1, None)], "k int, s int, o int, v int")
    got = N.neighbours(df, ["k"], "s", ["o"], previous={"p": "v"}, following={"f": "v"})
    assert rows(got, "s", "o", "p", "f") == [(1, 1, None, 5), (1, 2, None, None), (2, 1, 5, None)]


def test_exact_percentiles_equal_native(spark, skewed):
    wanted = {"a": 0.05, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0, "f": 0.0}
    native = {
        r["key"]: r["p"]
        for r in skewed.groupBy("key").agg(F.percentile("value", F.array(*[F.lit(p) for p in wanted.values()])).alias("p")).collect()
    }
    for few in (False, True):
        for r in A.exact_percentiles(skewed, ["key"], "value", wanted, few_values=few).collect():
            assert all(abs(r[n] - x) < 1e-9 for n, x in zip(wanted, native[r["key"]])), (few, r)
    whole = A.exact_percentiles(skewed, [], "value", {"m": 0.3}).first()["m"]
    assert abs(whole - skewed.agg(F.percentile("value", F.lit(0.3))).first()[0]) < 1e-9


def test_exact_percentiles_of_a_single_value(spark):
    df = spark.createDataFrame([(1, 4.0), (1, 4.0), (2, None), (2, 1.0)], "k int, v double")
    got = {r["k"]: r["m"] for r in A.exact_percentiles(df, ["k"], "v", {"m": 0.5}).collect()}
    assert got == {1: 4.0, 2: 1.0}


def test_distinct_flags_equal_count_distinct(spark, skewed, rows):
    big = F.col("value") > 100
    want = skewed.groupBy("key").agg(F.count_distinct("day").alias("n"), F.count_distinct(F.when(big, F.col("day"))).alias("b"))
    got = A.distinct_flags(skewed, ["key"], ["day"], {"n": F.lit(True), "b": big})
    assert rows(got) == rows(want)


def test_pick_first_cuts_rows_before_the_shuffle(spark, skewed):
    df = N.pick_first(skewed, ["key"], [F.desc("value"), F.asc("id")], n=2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert df.groupBy("key").count().where("count > 2").count() == 0


def test_keep_best_keeps_ties(spark, rows):
    df = spark.createDataFrame([(1, 2, "a"), (1, 1, "b"), (1, 1, "c"), (2, 9, "d")], "k int, p int, v string")
    assert rows(N.keep_best(df, ["k"], "p"), "v") == [("b",), ("c",), ("d",)]


def test_trailing_sum_counts_calendar_days(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-01", 1), (1, "2024-01-03", 2), (1, "2024-01-04", 4)], "k int, d string, v int")
    got = N.trailing_sum(df.withColumn("d", F.col("d").cast("date")), ["k"], "d", "v", "s", 3)
    assert [r[0] for r in rows(got, "s")] == [1, 3, 6]


def test_wildcard_join_equals_brute_force(spark):
    random.seed(5)

    def value(n, nullable):
        return None if nullable and random.random() < 0.5 else str(random.randint(0, n))

    facts = [(i, value(3, random.random() < 0.2), value(2, False), random.randint(0, 2)) for i in range(60)]
    rules = [(f"r{i}", value(3, True), value(2, True), random.choice([None, 0, 1, 2])) for i in range(25)]
    want = sorted(
        (f[0], r[0]) for f in facts for r in rules if all(b is None or a == b for a, b in zip(f[1:], r[1:]))
    )
    df = spark.createDataFrame(facts, "id int, a string, b string, c int")
    rule_df = spark.createDataFrame(rules, "rule string, a string, b string, c int")
    joined = J.wildcard_join(df, rule_df, ["a", "b", "c"])
    got = sorted((r["id"], r["rule"]) for r in joined.select("id", "rule").collect())
    assert got == want
    twice = df.unionAll(df)
    semi = sorted(r["id"] for r in J.wildcard_join(twice, rule_df, ["a", "b", "c"], how="left_semi").collect())
    assert semi == sorted(2 * [*{i for i, _ in want}])
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()


def test_band_join_equals_brute_force(spark):
    bands = [("a", -100.0, 0.0), ("b", 0.0, 3.5), ("c", 3.0, 12.0), ("d", 40.0, 1e9)]
    facts = [(i, v) for i, v in enumerate([-5.0, 0.0, 0.1, 3.0, 3.2, 3.5, 11.9, 12.0, 30.0, 40.0, 41.0, 1e8])]
    hits = [(i, hit) for i, v in facts for hit in ([n for n, lo, hi in bands if lo < v <= hi] or [None])]
    want = sorted(hits, key=str)
    df = spark.createDataFrame(facts, "id int, v double")
    band_df = spark.createDataFrame(bands, "band string, lo double, hi double")
    got = J.band_join(df, F.col("v"), band_df, "lo", "hi", width=2.5, floor_at=-10, ceil_at=50)
    assert sorted(((r["id"], r["band"]) for r in got.collect()), key=str) == want


def test_full_merge_gives_one_row_per_key(spark, rows):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k int, a int")
    b = spark.createDataFrame([(2, 200), (3, 300)], "k int, b int")
    c = spark.createDataFrame([(3, 3000), (4, 4000)], "k int, c int")
    want = [(1, 10, None, None), (2, 20, 200, None), (3, None, 300, 3000), (4, None, None, 4000)]
    assert rows(J.full_merge({"a": a, "b": b, "c": c}, ["k"]), "k", "a", "b", "c") == want


def test_temporal_join_and_not_in(spark, rows):
    facts = spark.createDataFrame([(1, "2024-01-05"), (1, "2024-01-20"), (2, "2024-01-05")], "k int, d string")
    facts = facts.withColumn("d", F.col("d").cast("date"))
    versions = spark.createDataFrame([(1, "x", "2024-01-01", "2024-01-10"), (1, "y", "2024-01-11", "2400-01-01")], "k int, v string, s string, e string")
    versions = versions.select("k", "v", F.col("s").cast("date").alias("start_date"), F.col("e").cast("date").alias("end_date"))
    assert rows(J.temporal_join(facts, versions, ["k"], "d"), "k", "v") == [(1, "x"), (1, "y"), (2, None)]
    listed = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(J.not_in(facts.select("k").distinct(), listed, "k")) == [(2,)]


def test_differs_keeps_null(spark, rows):
    df = spark.createDataFrame([("X",), ("Y",), (None,)], "s string")
    assert rows(df.where(differs(F.col("s"), "X"))) == [("Y",), (None,)]


def test_carry_forward(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-01", "a"), (1, "2024-01-03", "b")], "k int, d string, v string")
    got = J.carry_forward(df.withColumn("d", F.col("d").cast("date")), ["k"], "d", "calday", "2024-01-04")
    assert [r[0] for r in rows(got.select(F.concat(F.day("calday"), "v")))] == ["1a", "2a", "3b", "4b"]


def test_trailing_sums_equal_a_range_join(spark, skewed, rows):
    daily = skewed.groupBy("key", "day").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("v")).where("pmod(hash(key, day), 3) = 0")
    last = F.lit("2024-01-12").cast("date")
    got = N.trailing_sums(daily, ["key"], "day", ["n", "v"], [2, 4], "at", last)
    spine = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-12')) AS at")
    near = daily.join(spine, (F.col("day") > F.date_sub("at", 4)) & (F.col("day") <= F.col("at")))
    short = F.col("day") > F.date_sub("at", 2)
    want = near.groupBy("key", "at").agg(
        F.sum(F.when(short, F.col("n")).otherwise(0)), F.sum(F.when(short, F.col("v")).otherwise(0)), F.sum("n"), F.sum("v")
    )
    filled = got.na.fill(0, ["n_2d"]).withColumn("v_2d", F.coalesce("v_2d", F.lit(0)).cast("decimal(28,2)"))
    assert rows(filled.selectExpr("key", "at", "n_2d", "cast(v_2d as double)", "n_4d", "cast(v_4d as double)")) == rows(want.select("key", "at", *[F.col(f"`{c}`").cast("double" if "v" in c else "bigint") for c in want.columns[2:]]))


def test_exact_percentiles_with_negative_and_far_values(spark):
    data = [(float(v),) for v in (-1e9, -5, -0.25, 0, 0, 0.25, 3, 7, 7, 1e12)]
    df = spark.createDataFrame(data, "v double")
    for p in (0.0, 0.1, 0.33, 0.5, 0.9, 1.0):
        want = df.agg(F.percentile("v", F.lit(p))).first()[0]
        assert abs(A.exact_percentiles(df, [], "v", {"m": p}).first()["m"] - want) <= 1e-9 * max(1.0, abs(want))


def test_exact_sum_of_large_totals(spark):
    from tallyloom.functions.numbers import exact_sum

    big = spark.range(100).select(F.lit(9.0e15).alias("v"))
    assert big.agg(exact_sum(F.col("v"), 2)).first()[0] == 9.0e17
    assert spark.createDataFrame([(0.123,), (0.004,)], "v double").agg(exact_sum(F.col("v"))).first()[0] == 0.127


def test_full_merge_refuses_a_repeated_key(spark):
    a = spark.createDataFrame([(1, 5), (1, 6)], "k int, x int")
    b = spark.createDataFrame([(1, 7), (None, 8)], "k int, y int")
    with pytest.raises(Exception, match="holds a key twice"):
        J.full_merge({"a": a, "b": b}, ["k"]).collect()
    assert sorted(map(tuple, J.full_merge({"a": a.limit(1), "b": b}, ["k"]).collect()), key=str) == [(1, 5, 7), (None, None, 8)]


@pytest.mark.parametrize("accuracy", [10, 100])
def test_percentile_brackets_equal_native_in_concentrated_groups(spark, accuracy):
    # all values within one doubling, many of them equal, one group with most rows, one small, one of NULL
    data = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 8, 1).when(F.col("id") < 60, 2).when(F.col("id") % 10 == 9, 3).alias("k"),
        (100 + F.least(F.pmod(F.xxhash64("id"), F.lit(900)), F.lit(700)) / 10).alias("v"),
    )
    wanted = {"a": 0.0, "b": 0.25, "c": 0.26, "d": 0.5, "e": 0.999, "f": 1.0}
    native = data.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in wanted.values()])).alias("p")).collect()
    got = {r.k: r for r in A.exact_percentiles(data.repartition(6), ["k"], "v", wanted, accuracy=accuracy).collect()}
    assert len(got) == 4
    for r in native:
        assert all(abs(got[r.k][n] - x) < 1e-9 for n, x in zip(wanted, r.p))


def test_percentiles_shuffle_little_of_a_concentrated_group(spark):
    values = spark.range(0, 200_000, 1, 8).select((F.lit(1.0) + F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003).alias("v"))
    df = A.exact_percentiles(values, [], "v", {"p": 0.5}, accuracy=1000)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange") <= 3
    sketch = values.agg(F.percentile_approx("v", [0.5 - 0.003, 0.5 + 0.003], 1000).alias("b")).first().b
    held = values.where(F.col("v").between(*sketch)).count()
    assert held < 2000  # of 200,000 rows these are counted by value, by as many tasks as read them; the others travel as two counts


def test_merged_measures_equal_full_joins(spark, rows):
    fact = spark.createDataFrame(
        [(1, "a", 5, 2, 10), (1, "b", 7, 1, 10), (2, "a", 1, 1, 11), (None, "b", 2, 2, 12), (3, "c", 9, 3, 13), (1, "a", 4, None, 14)], "k int, f string, v int, other int, o int"
    )
    own, far = {"k": F.col("k")}, {"k": F.col("other")}
    sets = [
        A.MeasureSet(own, F.col("f") == "a", {"a_sum": (F.sum, F.col("v")), "a_n": (F.count, F.lit(1))}),
        A.MeasureSet(own, F.col("f") == "b", {"b_sum": (F.sum, F.col("v"))}),
        A.MeasureSet(far, F.col("other").isNotNull(), {"orders": (F.count_distinct, F.col("o"))}),
    ]
    frames = {
        "a": fact.where("f = 'a'").groupBy("k").agg(F.sum("v").alias("a_sum"), F.count("*").alias("a_n")),
        "b": fact.where("f = 'b'").groupBy("k").agg(F.sum("v").alias("b_sum")),
        "c": fact.where("other IS NOT NULL").groupBy(F.col("other").alias("k")).agg(F.count_distinct("o").alias("orders")),
    }
    columns = ["k", "a_sum", "a_n", "b_sum", "orders"]
    assert rows(A.merged_measures(fact, ["k"], sets), *columns) == rows(J.full_merge(frames, ["k"]), *columns)


def test_leveled_rows(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    got = A.leveled(df, {"own": (F.lit(True), F.col("k")), "far": (F.col("v") == "x", F.col("v"))})
    assert rows(got, "k", "level", "level_key") == [(1, "far", "x"), (1, "own", "1"), (2, "own", "2")]


def test_following_days_cross_years_and_gaps(spark, rows):
    days = ["1899-12-31", "1999-12-30", "1999-12-31", "2000-02-01", "2000-02-01", "2005-07-07", "2101-01-01", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d")).repartition(3)
    got = J.following_days(df, "d", "n")
    known = sorted({d for d in days if d})
    assert sorted((str(r.d), r.n and str(r.n)) for r in got.collect()) == [(a, b) for a, b in zip(known, [*known[1:], None])]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and all("windowspecdefinition(_w" in line for line in plan.splitlines() if "Window [" in line)
    with pytest.raises(TypeError, match="not a date"):
        J.following_days(df.select(F.col("d").cast("timestamp").alias("d")), "d", "n")


def test_top_by_quota_runs_nothing_and_spreads_a_hot_key(spark, rows):
    df = spark.range(2000).select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 7).alias("k"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("v"), "id", (F.col("id") % 5).alias("q"))
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    got = N.top_by_quota(df, ["k"], [F.desc("v"), F.asc("id")], "q")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    w = Window.partitionBy("k").orderBy(F.desc("v"), "id")
    assert rows(got, "id") == rows(df.withColumn("n", F.row_number().over(w)).where("n <= q"), "id")


def test_exact_percentiles_do_not_sort_the_rows_of_a_group(spark):
    rows = spark.range(200).select(F.nullif(F.col("id") % 2, F.lit(0)).alias("k"), F.col("id").cast("double").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = A.exact_percentiles(rows, ["k"], "v", {"half": 0.5})
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert {r.k: r.half for r in got.collect()} == {None: 99.0, 1: 100.0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_runs_between_taken_places(spark):
    keys = [None, 3, 5, 8]
    classes = spark.createDataFrame([(("c",), keys)], "class struct<k: string>, members array<int>")
    some = [[p for p in range(1, 5) if mask >> (p - 1) & 1] for mask in range(16)]
    rows = spark.createDataFrame([(i, taken, ("c",)) for i, taken in enumerate([*some, None])], "i int, taken array<int>, class struct<k: string>")
    runs = rows.select("i", "class", F.inline(J.free_runs(F.col("taken"))))
    got = J.with_members(runs, classes, ["i"]).select("i", F.explode_outer("_members").alias("key")).collect()
    want = [(i, keys[p - 1]) for i, taken in enumerate([*some, []]) for p in range(1, 5) if p not in taken]
    assert sorted(((r.i, r.key) for r in got), key=str) == sorted(want, key=str)


def test_members_of_a_class_have_one_order(spark):
    """A place in the list of members is the same wherever the list is worked out, however the rows come."""
    dim = spark.createDataFrame([(k, "x") for k in [9, 4, None, 7, 4, 1]], "k int, a string")
    for frame in (dim, dim.orderBy(F.desc("k")), dim.repartition(3)):
        assert J.entity_classes(frame, "k", ["a"]).first().members == [None, 1, 4, 7, 9]
