"""Proofs of predicates and day slices."""

from pyspark.sql import functions as F

from tallyloom.functions.dates import day
from tallyloom.operators.filters import differs, matches_any, on_day, stamp_on_day
from tallyloom.proofs.common import AS_OF, event_day, order_day, ship_day, sql_total, total
from tallyloom.proofs.registry import proof


@proof(
    "flt_day_slice",
    f"SELECT event_id, user_id, event_type, value FROM events WHERE CAST(ts AS DATE) = DATE '{AS_OF}'",
)
def flt_day_slice(t):
    return t.events.where(on_day("ts", AS_OF)).select("event_id", "user_id", "event_type", "value")


@proof(
    "flt_prefix_day",
    f"""SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS proc_stamp FROM events
        WHERE strftime(ts, '%Y%m%d%H%M%S') LIKE '{AS_OF.replace("-", "")}%'""",
)
def flt_prefix_day(t):
    stamped = t.events.select("event_id", F.date_format("ts", "yyyyMMddHHmmss").alias("proc_stamp"))
    return stamped.where(stamp_on_day("proc_stamp", AS_OF))


@proof(
    "flt_in_between",
    f"""SELECT o_orderpriority, COUNT(*) AS n_orders, {sql_total("o_totalprice")} AS amount FROM orders
        WHERE o_orderstatus IN ('O', 'P') AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
        GROUP BY 1""",
)
def flt_in_between(t):
    return (
        t.orders.where(F.col("o_orderstatus").isin("O", "P") & order_day().between(day("1996-01-01"), day("1998-12-31")))
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("n_orders"), total("o_totalprice").alias("amount"))
    )


@proof(
    "flt_like_patterns",
    r"""SELECT p_partkey, p_name FROM part
        WHERE (UPPER(p_name) LIKE '%RING' OR UPPER(p_name) LIKE 'HOT%') AND p_name NOT LIKE '%\_%' ESCAPE '\'""",
)
def flt_like_patterns(t):
    keep = matches_any(F.col("p_name"), ["%ring", "hot%"]) & ~F.col("p_name").like(r"%\_%")
    return t.part.where(keep).select("p_partkey", "p_name")


@proof(
    "flt_regex",
    "SELECT p_partkey, p_brand FROM part WHERE regexp_matches(p_brand, '^Brand#[1-9][0-9]$')",
)
def flt_regex(t):
    return t.part.where(F.col("p_brand").rlike("^Brand#[1-9][0-9]$")).select("p_partkey", "p_brand")


@proof(
    "flt_null_tolerant",
    """SELECT COALESCE(flag, 'none') AS flag, COUNT(*) AS n
       FROM (SELECT NULLIF(l_returnflag, 'N') AS flag, l_linestatus FROM lineitem)
       WHERE (flag <> 'R' OR flag IS NULL) AND NOT (l_linestatus = 'F' AND flag IS NOT DISTINCT FROM 'A')
       GROUP BY 1""",
)
def flt_null_tolerant(t):
    flags = t.lineitem.select(F.nullif("l_returnflag", F.lit("N")).alias("flag"), "l_linestatus")
    kept = flags.where(
        differs(F.col("flag"), "R") & ~((F.col("l_linestatus") == "F") & F.col("flag").eqNullSafe(F.lit("A")))
    )
    return kept.groupBy(F.coalesce("flag", F.lit("none")).alias("flag")).agg(F.count("*").alias("n"))


@proof(
    "flt_as_of_day",
    f"""SELECT CAST(ts AS DATE) AS event_day, COUNT(*) AS n FROM events
        WHERE CAST(ts AS DATE) >= DATE '{AS_OF}' - INTERVAL 6 DAY AND CAST(ts AS DATE) <= DATE '{AS_OF}' GROUP BY 1""",
)
def flt_as_of_day(t, as_of=AS_OF):
    recent = t.events.where(event_day().between(F.date_sub(day(as_of), 6), day(as_of)))
    return recent.groupBy(event_day().alias("event_day")).agg(F.count("*").alias("n"))


@proof(
    "agg_having",
    f"""SELECT l_suppkey, CAST(l_shipdate AS DATE) AS calday, {sql_total("l_quantity")} AS qty FROM lineitem
        GROUP BY ALL HAVING SUM(CAST(l_quantity AS DECIMAL(18,2))) > 60""",
)
def agg_having(t):
    daily = t.lineitem.groupBy("l_suppkey", ship_day().alias("calday")).agg(total("l_quantity").alias("qty"))
    return daily.where(F.col("qty") > 60)
