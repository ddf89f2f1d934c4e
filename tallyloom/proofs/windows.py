"""Proofs of window operators."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators import aggregates as A
from tallyloom.operators import windows as N
from tallyloom.proofs.common import event_day, r6, ship_day, sql_total, total
from tallyloom.proofs.registry import proof
from tallyloom.sources.constants import values

LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
LINE_ORDER_SQL = "l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC"


@proof(
    "win_dedup_latest",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
        QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) = 1""",
)
def win_dedup_latest(t):
    newest = [F.desc(c) for c in LINE_ORDER]
    return N.pick_first(t.lineitem, ["l_orderkey", "l_linenumber"], newest).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )


@proof(
    "win_rank_latest_batch",
    """SELECT event_id, user_id, CAST(ts AS DATE) AS batch_day FROM events
       QUALIFY RANK() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC) = 1""",
)
def win_rank_latest_batch(t):
    rows = t.events.select("event_id", "user_id", event_day().alias("batch_day"))
    return N.keep_best(rows, ["user_id"], "batch_day", largest=True)


@proof(
    "win_dense_rank_priority",
    """WITH s AS (SELECT user_id, event_id, CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'view' THEN 3 ELSE 4 END AS prior
                  FROM events)
       SELECT user_id, event_id, CAST(prior AS INTEGER) AS prior FROM s QUALIFY DENSE_RANK() OVER (PARTITION BY user_id ORDER BY prior) = 1""",
)
def win_dense_rank_priority(t):
    prior = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "signup", 2)
    rows = t.events.select("user_id", "event_id", prior.when(F.col("event_type") == "view", 3).otherwise(4).alias("prior"))
    return N.keep_best(rows, ["user_id"], "prior")


@proof(
    "win_lag_lead",
    """SELECT event_id, user_id, LAG(event_type) OVER w AS prev_type, LEAD(value) OVER w AS next_value, LEAD(event_id) OVER w AS next_event
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def win_lag_lead(t):
    rows = t.events.withColumn("calday", event_day())
    out = N.neighbours(
        rows, ["user_id"], "calday", ["ts", "event_id"],
        previous={"prev_type": "event_type"}, following={"next_value": "value", "next_event": "event_id"},
    )
    return out.select("event_id", "user_id", "prev_type", "next_value", "next_event")


@proof(
    "win_first_value",
    """SELECT DISTINCT o_custkey, FIRST_VALUE(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS last_priority
       FROM orders""",
)
def win_first_value(t):
    rows = t.orders.withColumn("last_priority", F.col("o_orderpriority"))
    return N.latest(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["last_priority"])


@proof(
    "win_running_total",
    """SELECT event_id, user_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running FROM events""",
)
def win_running_total(t):
    rows = t.events.select("event_id", "user_id", "ts", event_day().alias("calday"), F.col("value").cast("decimal(18,2)").alias("v"))
    out = N.running_sum(rows, ["user_id"], "calday", ["ts", "event_id"], "v", "running")
    return out.select("event_id", "user_id", F.col("running").cast("double").alias("running"))


@proof(
    "win_rows_trailing_30",
    f"""WITH d AS (SELECT p_brand, CAST(l_shipdate AS DATE) AS calday, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS q
                   FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
        SELECT p_brand, calday, CAST(SUM(q) OVER (PARTITION BY p_brand ORDER BY calday
               RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS DOUBLE) AS qty_30d FROM d""",
)
def win_rows_trailing_30(t):
    lines = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    daily = lines.groupBy("p_brand", ship_day().alias("calday")).agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("q"))
    return N.trailing_sum(daily, ["p_brand"], "calday", "q", "q30", 30).select(
        "p_brand", "calday", F.col("q30").cast("double").alias("qty_30d")
    )


@proof(
    "win_rows_leading",
    f"""WITH w AS (SELECT o_orderpriority, date_trunc('week', o_orderdate)::DATE AS week, {sql_total("o_totalprice")} AS amount FROM orders GROUP BY 1, 2)
        SELECT o_orderpriority, week, ROUND(AVG(amount) OVER (PARTITION BY o_orderpriority ORDER BY week
               ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING), 4) AS ahead FROM w""",
)
def win_rows_leading(t):
    weekly = t.orders.groupBy("o_orderpriority", F.to_date(F.date_trunc("week", "o_orderdate")).alias("week")).agg(
        total("o_totalprice").alias("amount")
    )
    w = Window.partitionBy("o_orderpriority").orderBy("week").rowsBetween(0, 3)
    return weekly.select("o_orderpriority", "week", F.round(F.avg("amount").over(w), 4).alias("ahead"))


@proof(
    "win_share_of_total",
    f"""WITH s AS (SELECT l_suppkey, l_partkey, {sql_total("l_extendedprice")} AS amount FROM lineitem GROUP BY 1, 2)
        SELECT l_suppkey, l_partkey, ROUND(amount / NULLIF(CAST(SUM(CAST(amount AS DECIMAL(18,2))) OVER (PARTITION BY l_suppkey) AS DOUBLE), 0), 6) AS share FROM s""",
)
def win_share_of_total(t):
    sold = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"))
    shared = N.share_of_total(sold, ["l_suppkey"], "amount", "share")
    ratio = F.try_divide(F.col("amount").cast("double"), F.col("total").cast("double"))
    return shared.select("l_suppkey", "l_partkey", r6(ratio).alias("share"))


@proof(
    "win_percentile",
    """SELECT DISTINCT p_brand, ROUND(quantile_cont(l_quantity, 0.8) OVER (PARTITION BY p_brand), 6) AS pct_80,
              ROUND(quantile_cont(l_quantity, 0.95) OVER (PARTITION BY p_brand), 6) AS pct_95
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def win_percentile(t):
    lines = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    q = A.exact_percentiles(lines, ["p_brand"], "l_quantity", {"pct_80": 0.8, "pct_95": 0.95}, few_values=True)
    return q.select("p_brand", r6(F.col("pct_80")).alias("pct_80"), r6(F.col("pct_95")).alias("pct_95"))


@proof(
    "win_priority_pick",
    """WITH o AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS held, NULLIF(o_totalprice, 0) AS amount FROM orders)
       SELECT o_custkey, o_orderkey, o_orderstatus FROM o QUALIFY ROW_NUMBER() OVER
       (PARTITION BY o_custkey ORDER BY held ASC, o_orderdate DESC NULLS LAST, amount ASC NULLS LAST, o_orderkey) = 1""",
)
def win_priority_pick(t):
    order = [
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).asc(),
        F.col("o_orderdate").desc_nulls_last(),
        F.nullif("o_totalprice", F.lit(0.0)).asc_nulls_last(),
        F.col("o_orderkey").asc(),
    ]
    return N.pick_first(t.orders, ["o_custkey"], order).select("o_custkey", "o_orderkey", "o_orderstatus")


@proof(
    "win_topn_quota",
    f"""WITH s AS (SELECT p_type, l_partkey, {sql_total("l_quantity")} AS qty FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
        SELECT p_type, l_partkey, qty FROM s JOIN (VALUES ('PROMO', 5), ('LARGE', 3), ('SMALL', 12)) q(type, quota) ON p_type = q.type
        QUALIFY ROW_NUMBER() OVER (PARTITION BY p_type ORDER BY qty DESC, l_partkey) <= quota""",
)
def win_topn_quota(t):
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    sold = t.lineitem.join(kinds, "l_partkey").groupBy("p_type", "l_partkey").agg(total("l_quantity").alias("qty"))
    quotas = values(t.spark, [("PROMO", 5), ("LARGE", 3), ("SMALL", 12)], "p_type string, quota int")
    kept = N.top_by_quota(sold.join(quotas, "p_type"), ["p_type"], [F.desc("qty"), F.asc("l_partkey")], "quota")
    return kept.select("p_type", "l_partkey", "qty")


@proof(
    "win_labelled_weeks",
    f"""WITH w AS (SELECT date_trunc('week', ts)::DATE AS week, COUNT(*) AS n FROM events GROUP BY 1)
        SELECT week, n, 'W' || CAST(ROW_NUMBER() OVER (ORDER BY week) AS VARCHAR) AS label FROM w""",
)
def win_labelled_weeks(t):
    weekly = t.events.groupBy(F.to_date(F.date_trunc("week", "ts")).alias("week")).agg(F.count("*").alias("n"))
    number = F.row_number().over(Window.orderBy("week"))  # over weeks, after grouping
    return weekly.withColumn("label", F.concat(F.lit("W"), number.cast("string")))


@proof(
    "win_qualify",
    """WITH b AS (SELECT * FROM events QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1)
       SELECT user_id, event_id, event_type FROM b
       QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 3
           AND COUNT(*) OVER (PARTITION BY user_id) > 1""",
)
def win_qualify(t):
    rows = t.events.withColumn("calday", event_day())
    per_day = N.pick_first(rows, ["user_id", "calday"], [F.desc("ts"), F.desc("event_id")])
    several = per_day.groupBy("user_id").agg(F.count("*").alias("_n")).where("_n > 1").select("user_id")
    best = N.pick_first(per_day, ["user_id"], [F.desc("value"), F.asc("event_id")], n=3)
    return best.join(several, "user_id", "left_semi").select("user_id", "event_id", "event_type")


# --- rows under a NULL key are a group of their own -------------------------------------------

NULL_USER = "NULLIF(user_id % 7, 0)"


def events_with_null_users(t):
    user = F.nullif(F.col("user_id") % 7, F.lit(0)).alias("u")
    return t.events.select("event_id", user, "ts", event_day().alias("calday"), "event_type", F.col("value").cast("decimal(18,2)").alias("v"))


@proof(
    "win_running_total_nulls",
    f"""SELECT event_id, u, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY u ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running FROM (SELECT *, {NULL_USER} AS u FROM events)""",
)
def win_running_total_nulls(t):
    out = N.running_sum(events_with_null_users(t), ["u"], "calday", ["ts", "event_id"], "v", "running")
    return out.select("event_id", "u", F.col("running").cast("double").alias("running"))


@proof(
    "win_lag_lead_nulls",
    f"""SELECT event_id, u, LAG(event_type) OVER w AS prev_type, LEAD(event_id) OVER w AS next_event
        FROM (SELECT *, {NULL_USER} AS u FROM events) WINDOW w AS (PARTITION BY u ORDER BY ts, event_id)""",
)
def win_lag_lead_nulls(t):
    out = N.neighbours(
        events_with_null_users(t), ["u"], "calday", ["ts", "event_id"], previous={"prev_type": "event_type"}, following={"next_event": "event_id"}
    )
    return out.select("event_id", "u", "prev_type", "next_event")


@proof(
    "win_share_nulls",
    f"""SELECT event_id, u, ROUND(CAST(v AS DOUBLE) / NULLIF(CAST(SUM(v) OVER (PARTITION BY u) AS DOUBLE), 0), 6) AS share
        FROM (SELECT event_id, {NULL_USER} AS u, CAST(value AS DECIMAL(18,2)) AS v FROM events)""",
)
def win_share_nulls(t):
    shared = N.share_of_total(events_with_null_users(t), ["u"], "v", "share")
    return shared.select("event_id", "u", r6(F.try_divide(F.col("v").cast("double"), F.col("total").cast("double"))).alias("share"))


@proof(
    "win_best_nulls",
    f"SELECT event_id, u, event_type FROM (SELECT *, {NULL_USER} AS u FROM events) QUALIFY RANK() OVER (PARTITION BY u ORDER BY event_type) = 1",
)
def win_best_nulls(t):
    return N.keep_best(events_with_null_users(t), ["u"], "event_type").select("event_id", "u", "event_type")


@proof(
    "win_topn_wide_quota",
    f"""WITH s AS (SELECT p_type, l_partkey, {sql_total("l_quantity")} AS qty FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
        SELECT p_type, l_partkey, qty FROM s JOIN (VALUES ('PROMO', 2), ('LARGE', 100000)) q(type, quota) ON p_type = q.type
        QUALIFY ROW_NUMBER() OVER (PARTITION BY p_type ORDER BY qty DESC, l_partkey) <= quota""",
)
def win_topn_wide_quota(t):
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    sold = t.lineitem.join(kinds, "l_partkey").groupBy("p_type", "l_partkey").agg(total("l_quantity").alias("qty"))
    quotas = values(t.spark, [("PROMO", 2), ("LARGE", 100_000)], "p_type string, quota int")
    kept = N.top_by_quota(sold.join(quotas, "p_type"), ["p_type"], [F.desc("qty"), F.asc("l_partkey")], "quota")
    return kept.select("p_type", "l_partkey", "qty")
