"""Proofs of aggregations, ordering and set operations."""

from pyspark.sql import functions as F

from tallyloom.functions.numbers import noise_floor, safe_ratio, signed
from tallyloom.operators import aggregates as A
from tallyloom.operators import sets as S
from tallyloom.plans import demand
from tallyloom.proofs.common import event_day, net_total, order_day, r6, ship_day, sql_total, total
from tallyloom.proofs.registry import proof


@proof(
    "agg_basic",
    f"""SELECT l_returnflag, l_linestatus, {sql_total("l_quantity")} AS sum_qty,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue,
               MIN(l_quantity) AS min_qty, MAX(l_extendedprice) AS max_price,
               ROUND({sql_total("l_quantity")} / COUNT(*), 6) AS avg_qty, COUNT(*) AS n
        FROM lineitem GROUP BY 1, 2""",
)
def agg_basic(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        total("l_quantity").alias("sum_qty"),
        net_total().alias("revenue"),
        F.min("l_quantity").alias("min_qty"),
        F.max("l_extendedprice").alias("max_price"),
        r6(total("l_quantity") / F.count("*")).alias("avg_qty"),
        F.count("*").alias("n"),
    )


@proof(
    "agg_group_all",
    f"""SELECT o_orderstatus, o_orderpriority, year(o_orderdate) AS order_year, {sql_total("o_totalprice")} AS amount
        FROM orders GROUP BY ALL""".replace("year(o_orderdate)", "CAST(year(o_orderdate) AS INTEGER)"),
)
def agg_group_all(t):
    return t.spark.sql(
        """SELECT o_orderstatus, o_orderpriority, year(o_orderdate) AS order_year,
                  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
           FROM {orders} GROUP BY ALL""",
        orders=t.orders,
    )


@proof(
    "agg_conditional_sum",
    f"""SELECT event_type,
               {sql_total("CASE WHEN CAST(ts AS DATE) > DATE '2024-01-23' THEN value ELSE 0 END")} AS value_7d,
               {sql_total("CASE WHEN CAST(ts AS DATE) > DATE '2024-01-16' THEN value ELSE 0 END")} AS value_14d,
               CAST(SUM(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS BIGINT) AS n_large
        FROM events GROUP BY 1""",
)
def agg_conditional_sum(t):
    def since(d):
        return F.when(event_day() > F.lit(d).cast("date"), F.col("value")).otherwise(0)

    return t.events.groupBy("event_type").agg(
        total(since("2024-01-23")).alias("value_7d"),
        total(since("2024-01-16")).alias("value_14d"),
        F.count_if(F.col("value") > 100).alias("n_large"),
    )


@proof(
    "agg_signed_sum",
    f"""SELECT l_partkey, {sql_total("CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * ABS(l_quantity)")} AS net_qty
        FROM lineitem GROUP BY 1""",
)
def agg_signed_sum(t):
    return t.lineitem.groupBy("l_partkey").agg(
        total(signed(F.col("l_returnflag"), F.col("l_quantity"), outgoing="R")).alias("net_qty")
    )


@proof(
    "agg_count_distinct_if",
    """SELECT l_suppkey, COUNT(DISTINCT l_orderkey) AS bills,
              COUNT(DISTINCT CASE WHEN l_returnflag = 'N' THEN l_orderkey END) AS bills_normal,
              COUNT(DISTINCT CASE WHEN l_discount > 0.05 THEN l_orderkey END) AS bills_promo
       FROM lineitem GROUP BY 1""",
)
def agg_count_distinct_if(t):
    flags = {
        "bills": F.lit(True),
        "bills_normal": F.col("l_returnflag") == "N",
        "bills_promo": F.col("l_discount") > 0.05,
    }
    return A.distinct_flags(t.lineitem, ["l_suppkey"], ["l_orderkey"], flags)


@proof(
    "agg_net_bill_count",
    """SELECT date_trunc('week', l_shipdate)::DATE AS week,
              COUNT(DISTINCT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END)
              - COUNT(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS net_bills
       FROM lineitem GROUP BY 1""",
)
def agg_net_bill_count(t):
    flags = {"sold": F.col("l_returnflag") != "R", "returned": F.col("l_returnflag") == "R"}
    weekly = t.lineitem.withColumn("week", F.to_date(F.date_trunc("week", "l_shipdate")))
    counted = A.distinct_flags(weekly, ["week"], ["l_orderkey"], flags)
    return counted.select("week", (F.col("sold") - F.col("returned")).alias("net_bills"))


@proof("agg_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def agg_distinct(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@proof(
    "agg_collect",
    """SELECT l_suppkey, array_to_string(list_sort(list_distinct(list(year(l_shipdate)))), ',') AS years,
              len(list_distinct(list(l_returnflag))) AS n_flags FROM lineitem GROUP BY 1""",
)
def agg_collect(t):
    # sets over bounded domains: calendar years and flag codes
    once = t.lineitem.select("l_suppkey", F.year("l_shipdate").alias("y"), "l_returnflag")
    return once.groupBy("l_suppkey").agg(
        F.array_join(F.sort_array(F.collect_set("y")), ",").alias("years"),
        F.size(F.collect_set("l_returnflag")).cast("bigint").alias("n_flags"),
    )


@proof(
    "agg_string_list",
    f"""SELECT l_suppkey, string_agg(l_returnflag || '-' || l_linestatus || ':' || CAST(n AS VARCHAR), ', '
               ORDER BY l_returnflag, l_linestatus) AS detail
        FROM (SELECT l_suppkey, l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1""",
)
def agg_string_list(t):
    # the list is of code pairs, counted first, so its length is bounded by the code list
    counted = t.lineitem.groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    entry = F.concat(F.concat_ws("-", "l_returnflag", "l_linestatus"), F.lit(":"), F.col("n").cast("string"))
    return counted.groupBy("l_suppkey").agg(F.array_join(F.sort_array(F.collect_list(entry)), ", ").alias("detail"))


@proof(
    "agg_percentile_approx",
    "SELECT DISTINCT l_returnflag, true AS q25_within, true AS q50_within, true AS q75_within FROM lineitem",
)
def agg_percentile_approx(t):
    """The sketch is approximate by definition; what is proved is its bound: the share of values below the answer,
    and of those up to it, enclose the wanted rank within 1 / accuracy and one row."""
    wanted, accuracy = {"q25": 0.25, "q50": 0.5, "q75": 0.75}, 10_000
    answers = t.lineitem.groupBy("l_returnflag").agg(*[F.percentile_approx("l_extendedprice", p, accuracy).alias(n) for n, p in wanted.items()])
    # one row per code: a broadcast, as a sort would hold all rows of a code in one task
    ranked = t.lineitem.select("l_returnflag", "l_extendedprice").join(F.broadcast(answers), "l_returnflag")

    def share(condition):
        return F.avg(condition.cast("int"))

    price, slack = F.col("l_extendedprice"), F.lit(1 / accuracy) + F.lit(1.0) / F.count("*")
    within = [((share(price < F.col(n)) <= p + slack) & (share(price <= F.col(n)) >= p - slack)).alias(f"{n}_within") for n, p in wanted.items()]
    return ranked.groupBy("l_returnflag").agg(*within)


@proof(
    "agg_percentile_nulls",
    """SELECT u, ROUND(quantile_cont(value, 0.5), 6) AS few, ROUND(quantile_cont(value, 0.5), 6) AS many
       FROM (SELECT value, NULLIF(user_id % 7, 0) AS u FROM events) GROUP BY u""",
)
def agg_percentile_nulls(t):
    """Both ways of the operator, with a group under a NULL key."""
    rows = t.events.select(F.nullif(F.col("user_id") % 7, F.lit(0)).alias("u"), "value")
    few = A.exact_percentiles(rows, ["u"], "value", {"few": 0.5}, few_values=True)
    many = A.exact_percentiles(rows, ["u"], "value", {"many": 0.5}).withColumnRenamed("u", "w")
    joined = few.join(many, F.col("u").eqNullSafe(F.col("w")))
    return joined.select("u", r6(F.col("few")).alias("few"), r6(F.col("many")).alias("many"))


@proof(
    "agg_percentile_exact",
    """SELECT l_returnflag, ROUND(quantile_cont(l_extendedprice, 0.25), 6) AS q1, ROUND(quantile_cont(l_extendedprice, 0.5), 6) AS q2,
              ROUND(quantile_cont(l_extendedprice, 0.75), 6) AS q3 FROM lineitem GROUP BY 1""",
)
def agg_percentile_exact(t):
    q = A.exact_percentiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    return q.select("l_returnflag", *[r6(F.col(c)).alias(c) for c in ("q1", "q2", "q3")])


@proof(
    "agg_global_percentiles",
    """SELECT ROUND(quantile_cont(value, 0.05), 6) AS pct_05, ROUND(quantile_cont(value, 0.2), 6) AS pct_20,
              ROUND(quantile_cont(value, 0.8), 6) AS pct_80, ROUND(quantile_cont(value, 0.95), 6) AS pct_95 FROM events""",
)
def agg_global_percentiles(t):
    wanted = {"pct_05": 0.05, "pct_20": 0.2, "pct_80": 0.8, "pct_95": 0.95}
    q = A.exact_percentiles(t.events, [], "value", wanted)
    return q.select(*[r6(F.col(c)).alias(c) for c in wanted])


@proof(
    "agg_leadtime_stats",
    """WITH p AS (SELECT l_suppkey, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS gap
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
       SELECT l_suppkey, CAST(LEAST(10, GREATEST(CEIL(AVG(gap)), 2)) AS BIGINT) AS leadtime, ROUND(AVG(gap), 6) AS avg_leadtime,
              CAST(MIN(gap) AS INTEGER) AS min_leadtime, CAST(MAX(gap) AS INTEGER) AS max_leadtime,
              ROUND(COALESCE(STDDEV_SAMP(gap), 0), 6) AS stddev_leadtime,
              CAST(quantile_disc(gap, 0.25) AS INTEGER) AS q1_leadtime, CAST(quantile_disc(gap, 0.5) AS INTEGER) AS q2_leadtime,
              CAST(quantile_disc(gap, 0.75) AS INTEGER) AS q3_leadtime
       FROM p WHERE gap >= 2 GROUP BY 1""",
)
def agg_leadtime_stats(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    stats = demand.leadtime_stats(lines, ["l_suppkey"], order_day(), ship_day())
    return stats.withColumns({c: r6(F.col(c)) for c in ("avg_leadtime", "stddev_leadtime")})


@proof(
    "agg_safe_ratio",
    f"""SELECT l_suppkey, ROUND({sql_total("l_extendedprice")} / NULLIF({sql_total("l_quantity")}, 0), 6) AS unit_price,
               ROUND({sql_total("CASE WHEN l_returnflag = 'R' AND l_discount > 0.1 THEN 1 ELSE 0 END")}
                     / NULLIF({sql_total("CASE WHEN l_discount > 0.1 THEN 1 ELSE 0 END")}, 0), 6) AS return_rate
        FROM lineitem GROUP BY 1""",
)
def agg_safe_ratio(t):
    deep = F.col("l_discount") > 0.1
    back = deep & (F.col("l_returnflag") == "R")
    return t.lineitem.groupBy("l_suppkey").agg(
        r6(safe_ratio(total("l_extendedprice"), total("l_quantity"))).alias("unit_price"),
        r6(safe_ratio(total(F.when(back, 1).otherwise(0)), total(F.when(deep, 1).otherwise(0)))).alias("return_rate"),
    )


def _rollup_sql(unit):
    return f"""SELECT date_trunc('{unit}', o_orderdate)::DATE AS period, o_orderpriority, COUNT(*) AS n_orders,
                      {sql_total("o_totalprice")} AS amount FROM orders GROUP BY 1, 2"""


def _rollup(t, unit):
    period = F.to_date(F.date_trunc(unit, "o_orderdate")).alias("period")
    return t.orders.groupBy(period, "o_orderpriority").agg(
        F.count("*").alias("n_orders"), total("o_totalprice").alias("amount")
    )


@proof("agg_week_rollup", _rollup_sql("week"))
def agg_week_rollup(t):
    return _rollup(t, "week")


@proof("agg_month_rollup", _rollup_sql("month"))
def agg_month_rollup(t):
    return _rollup(t, "month")


@proof(
    "agg_noise_floor",
    """SELECT l_suppkey, CASE WHEN ABS(s) < 0.000001 THEN 0.0::DOUBLE ELSE s END AS balance, ROUND(q, 3) AS qty FROM
       (SELECT l_suppkey, CAST(SUM(CAST(l_discount AS DECIMAL(18,2)) - CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS s,
               CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS q FROM lineitem GROUP BY 1)""",
)
def agg_noise_floor(t):
    # the difference of two equal running figures is noise around zero in floating point
    noisy = F.sum(F.col("l_discount")) - F.sum(F.col("l_discount") * F.lit(3.0) / F.lit(3.0))
    return t.lineitem.groupBy("l_suppkey").agg(
        noise_floor(noisy).alias("balance"), F.round(total("l_quantity"), 3).alias("qty")
    )


@proof(
    "agg_sum_with_latest",
    f"""SELECT l_partkey, {sql_total("l_quantity")} AS qty,
               arg_max(l_returnflag, (l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS last_flag,
               arg_max(l_suppkey, (l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS last_supplier
        FROM lineitem GROUP BY 1""",
)
def agg_sum_with_latest(t):
    rows = t.lineitem.withColumns({"last_flag": F.col("l_returnflag"), "last_supplier": F.col("l_suppkey")})
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    return A.sum_with_latest(rows, ["l_partkey"], {"qty": total("l_quantity")}, ["last_flag", "last_supplier"], order)


@proof(
    "agg_kth_smallest",
    """WITH d AS (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders),
            r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY d) AS k FROM d)
       SELECT o_custkey, MAX(CASE WHEN k = 1 THEN d END) AS first_day, MAX(CASE WHEN k = 2 THEN d END) AS second_day
       FROM r WHERE k <= 2 GROUP BY 1""",
)
def agg_kth_smallest(t):
    days = t.orders.select("o_custkey", order_day().alias("d")).distinct()
    return A.kth_per_group(days, ["o_custkey"], "d", ["first_day", "second_day"])


@proof(
    "agg_zero_fill",
    """SELECT c_custkey, COUNT(o_orderkey) AS n_urgent FROM customer
       LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' GROUP BY 1""",
)
def agg_zero_fill(t):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    counts = urgent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_urgent"))
    return A.zero_fill(counts, t.customer.select("c_custkey"), ["c_custkey"], ["n_urgent"])


# ordering


@proof("ord_sort", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def ord_sort(t):
    return t.orders.select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey")


@proof("ord_top1", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def ord_top1(t):
    return t.orders.select("o_orderkey", "o_orderdate").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(1)


# set operations


@proof(
    "set_union_all",
    """SELECT kind, nation, COUNT(*) AS n FROM (SELECT 'customer' AS kind, c_nationkey AS nation FROM customer
       UNION ALL SELECT 'supplier', s_nationkey FROM supplier) GROUP BY 1, 2""",
)
def set_union_all(t):
    members = t.customer.select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation"))
    vendors = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation"))
    return members.unionByName(vendors).groupBy("kind", "nation").agg(F.count("*").alias("n"))


@proof(
    "set_union_distinct",
    """SELECT l_suppkey AS s, l_partkey AS p FROM lineitem WHERE l_returnflag = 'R'
       UNION SELECT l_suppkey, l_partkey FROM lineitem WHERE l_linestatus = 'O'""",
)
def set_union_distinct(t):
    pairs = [t.lineitem.where(c).select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("p"))
             for c in ("l_returnflag = 'R'", "l_linestatus = 'O'")]
    return S.union_distinct(*pairs)


@proof(
    "set_union_by_name",
    """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, NULL::VARCHAR AS site FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name FROM supplier""",
)
def set_union_by_name(t):
    members = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    vendors = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("site"), F.col("s_acctbal").alias("balance"))
    return S.union_by_name(members, vendors)


@proof(
    "set_unpivot",
    f"""WITH w AS (SELECT l_suppkey, {sql_total("CASE WHEN l_returnflag='R' THEN l_quantity ELSE 0 END")} AS returned,
                   {sql_total("CASE WHEN l_returnflag='A' THEN l_quantity ELSE 0 END")} AS accepted,
                   {sql_total("CASE WHEN l_returnflag='N' THEN l_quantity ELSE 0 END")} AS normal FROM lineitem GROUP BY 1)
        SELECT l_suppkey, measure, qty FROM w UNPIVOT (qty FOR measure IN (returned, accepted, normal))""",
)
def set_unpivot(t):
    def part(flag):
        return total(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(0))

    wide = t.lineitem.groupBy("l_suppkey").agg(
        part("R").alias("returned"), part("A").alias("accepted"), part("N").alias("normal")
    )
    return S.unpivot(wide, ["l_suppkey"], ["returned", "accepted", "normal"], "measure", "qty")
