"""Proofs of join forms."""

from pyspark.sql import functions as F

from tallyloom.functions.numbers import exact_sum
from tallyloom.functions.text import strip_zeros
from tallyloom.operators import joins as J
from tallyloom.operators import windows as N
from tallyloom.operators.aggregates import MeasureSet, merged_measures
from tallyloom.operators.filters import valid_on
from tallyloom.proofs.common import AS_OF, event_day, order_day, ship_day, sql_total, total
from tallyloom.proofs.registry import proof
from tallyloom.proofs.versions import USER_VERSIONS_SQL, user_versions
from tallyloom.session import broadcast_within
from tallyloom.sources.constants import values


@proof(
    "jn_inner",
    f"""SELECT o_orderpriority, l_returnflag, COUNT(*) AS n, {sql_total("l_quantity")} AS qty
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
)
def jn_inner(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority", "l_returnflag").agg(
        F.count("*").alias("n"), total("l_quantity").alias("qty")
    )


@proof(
    "jn_left_star",
    f"""SELECT p_type, r_name, COUNT(*) AS n, {sql_total("l_extendedprice")} AS amount
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def jn_left_star(t):
    site = J.star(
        t.supplier,
        (t.nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey"),
        (t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"),
    ).select(F.col("s_suppkey").alias("l_suppkey"), "r_name")
    item = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    wide = J.star(t.lineitem, (item, "l_partkey"), (site, "l_suppkey"))
    return wide.groupBy("p_type", "r_name").agg(F.count("*").alias("n"), total("l_extendedprice").alias("amount"))


@proof(
    "jn_full_coalesce",
    f"""WITH o AS (SELECT CAST(o_orderdate AS DATE) AS calday, COUNT(*) AS n_orders FROM orders GROUP BY 1),
             s AS (SELECT CAST(l_shipdate AS DATE) AS calday, {sql_total("l_quantity")} AS shipped FROM lineitem GROUP BY 1)
        SELECT COALESCE(o.calday, s.calday) AS calday, COALESCE(n_orders, 0) AS n_orders, COALESCE(shipped, 0) AS shipped
        FROM o FULL JOIN s ON o.calday = s.calday""",
)
def jn_full_coalesce(t):
    ordered = t.orders.groupBy(order_day().alias("calday")).agg(F.count("*").alias("n_orders"))
    shipped = t.lineitem.groupBy(ship_day().alias("calday")).agg(total("l_quantity").alias("shipped"))
    return ordered.join(shipped, "calday", "full").na.fill(0)


def _by_flag_sql(flag, name):
    return (
        f"(SELECT l_suppkey, CAST(l_shipdate AS DATE) AS calday, {sql_total('l_quantity')} AS {name} "
        f"FROM lineitem WHERE l_returnflag = '{flag}' GROUP BY 1, 2)"
    )


@proof(
    "jn_full_multiway",
    f"""SELECT l_suppkey, calday, returned, accepted, normal
        FROM {_by_flag_sql("R", "returned")} FULL JOIN {_by_flag_sql("A", "accepted")} USING (l_suppkey, calday)
        FULL JOIN {_by_flag_sql("N", "normal")} USING (l_suppkey, calday)""",
)
def jn_full_multiway(t):
    """The three sets share a fact, so that one pass over it gives them all."""
    at = {"l_suppkey": F.col("l_suppkey"), "calday": ship_day()}
    sets = [MeasureSet(at, F.col("l_returnflag") == flag, {name: (exact_sum, F.col("l_quantity"))}) for flag, name in [("R", "returned"), ("A", "accepted"), ("N", "normal")]]
    return merged_measures(t.lineitem, list(at), sets)


@proof(
    "jn_cross",
    """SELECT s_suppkey, channel, CAST(share AS INTEGER) AS share,
              CAST(CAST(s_acctbal AS DECIMAL(18,2)) * share AS DOUBLE) AS part_balance
       FROM supplier, (VALUES ('store', 60), ('online', 30), ('partner', 10)) v(channel, share)""",
)
def jn_cross(t):
    grid = J.with_each(t.supplier, [("store", 60), ("online", 30), ("partner", 10)], "channel string, share int")
    return grid.select(
        "s_suppkey",
        "channel",
        "share",
        (F.col("s_acctbal").cast("decimal(18,2)") * F.col("share")).cast("double").alias("part_balance"),
    )


@proof(
    "jn_range_trailing",
    f"""WITH d AS (SELECT event_type, CAST(ts AS DATE) AS calday, CAST(value AS DECIMAL(18,2)) AS v FROM events),
             spine AS (SELECT CAST(UNNEST(generate_series(MIN(calday), MAX(calday), INTERVAL 1 DAY)) AS DATE) AS spine_day FROM d)
        SELECT spine_day, event_type, CAST(SUM(v) AS DOUBLE) AS value_7d, COUNT(*) AS n_7d
        FROM spine JOIN d ON d.calday > spine_day - 7 AND d.calday <= spine_day GROUP BY 1, 2""",
)
def jn_range_trailing(t):
    daily = t.events.groupBy("event_type", event_day().alias("calday")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("v"), F.count("*").alias("n")
    )
    last = daily.agg(F.max("calday")).scalar()
    fed = N.trailing_sums(daily, ["event_type"], "calday", ["v", "n"], [7], "spine_day", last)
    return fed.select("spine_day", "event_type", F.col("v_7d").cast("double").alias("value_7d"), F.col("n_7d"))


@proof(
    "jn_interval_carry_forward",
    f"""WITH s AS (SELECT user_id, CAST(ts AS DATE) AS d, arg_max(event_type, (ts, event_id)) AS status FROM events GROUP BY 1, 2),
             p AS (SELECT *, LEAD(d) OVER (PARTITION BY user_id ORDER BY d) AS d_to FROM s),
             spine AS (SELECT CAST(UNNEST(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS calday)
        SELECT calday, user_id, status FROM spine JOIN p ON calday >= d AND (calday < d_to OR d_to IS NULL)""",
)
def jn_interval_carry_forward(t):
    state = t.events.groupBy("user_id", event_day().alias("d")).agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("status")
    )
    return J.carry_forward(state, ["user_id"], "d", "calday", "2024-01-31").select("calday", "user_id", "status")


@proof(
    "jn_valid_period",
    f"""WITH v AS ({USER_VERSIONS_SQL}),
             a AS (SELECT user_id, COUNT(*) AS n_events FROM events WHERE CAST(ts AS DATE) = DATE '{AS_OF}' GROUP BY 1)
        SELECT v.user_id, v.status, a.n_events FROM v JOIN a USING (user_id)
        WHERE DATE '{AS_OF}' BETWEEN start_date AND end_date""",
)
def jn_valid_period(t):
    current = valid_on(user_versions(t), AS_OF).select("user_id", "status")
    active = t.events.where(event_day() == F.lit(AS_OF).cast("date")).groupBy("user_id").agg(F.count("*").alias("n_events"))
    return current.join(active, "user_id")


BANDS = [("0", 0.0, 10.0), ("1", 10.0, 25.0), ("2", 25.0, 40.0), ("3", 40.0, 45.0)]
BANDS_SQL = "(VALUES ('0', 0.0, 10.0), ('1', 10.0, 25.0), ('2', 25.0, 40.0), ('3', 40.0, 45.0)) b(band_id, lo, hi)"


@proof(
    "jn_band",
    f"""SELECT band_id, l_returnflag, COUNT(*) AS n, {sql_total("l_quantity")} AS qty
        FROM lineitem LEFT JOIN {BANDS_SQL} ON l_quantity > lo AND l_quantity <= hi GROUP BY 1, 2""",
)
def jn_band(t):
    bands = values(t.spark, BANDS, "band_id string, lo double, hi double")
    joined = J.band_join(t.lineitem, F.col("l_quantity"), bands, "lo", "hi", width=5, floor_at=0, ceil_at=50)
    return joined.groupBy("band_id", "l_returnflag").agg(F.count("*").alias("n"), total("l_quantity").alias("qty"))


RULES = [
    ("r1", "Brand#7", None, None),
    ("r2", None, "PROMO", None),
    ("r3", "Brand#16", "ECONOMY", None),
    ("r4", None, "SMALL", 10),
    ("r5", None, None, 33),
    ("r6", None, None, None),
]
RULES_SQL = """(VALUES ('r1', 'Brand#7', NULL, NULL), ('r2', NULL, 'PROMO', NULL), ('r3', 'Brand#16', 'ECONOMY', NULL),
    ('r4', NULL, 'SMALL', 10), ('r5', NULL, NULL, 33), ('r6', NULL, NULL, NULL)) b(rule_id, brand, type, size)"""


@proof(
    "jn_wildcard_rule",
    f"""SELECT p_partkey, rule_id FROM part a JOIN {RULES_SQL}
        ON (b.brand IS NULL OR a.p_brand = b.brand) AND (b.type IS NULL OR a.p_type = b.type)
        AND (b.size IS NULL OR a.p_size = b.size)""",
)
def jn_wildcard_rule(t):
    rules = values(t.spark, RULES, "rule_id string, p_brand string, p_type string, p_size int")
    return J.wildcard_join(t.part, rules, ["p_brand", "p_type", "p_size"]).select("p_partkey", "rule_id")


@proof(
    "jn_semi",
    """SELECT l_suppkey, COUNT(*) AS n FROM lineitem WHERE l_orderkey IN
       (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY 1""",
)
def jn_semi(t):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("l_orderkey"))
    return t.lineitem.join(urgent, "l_orderkey", "left_semi").groupBy("l_suppkey").agg(F.count("*").alias("n"))


@proof(
    "jn_anti_exists",
    """SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS
       (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""",
)
def jn_anti_exists(t):
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.join(returned, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@proof(
    "jn_anti_notin",
    """SELECT p_partkey, p_name FROM part WHERE p_brand NOT IN
       (SELECT NULLIF(p_brand, 'Brand#7') FROM part WHERE p_size < 5 AND NULLIF(p_brand, 'Brand#7') IS NOT NULL)""",
)
def jn_anti_notin(t):
    listed = t.part.where("p_size < 5").select(F.nullif("p_brand", F.lit("Brand#7")).alias("p_brand"))
    return J.not_in(t.part, listed, "p_brand").select("p_partkey", "p_name")


@proof(
    "jn_lagged_self",
    f"""WITH d AS (SELECT event_type, CAST(ts AS DATE) AS calday, {sql_total("value")} AS v FROM events GROUP BY 1, 2)
        SELECT a.event_type, a.calday, a.v AS today, b.v AS yesterday
        FROM d a LEFT JOIN d b ON a.event_type = b.event_type AND a.calday = b.calday + 1""",
)
def jn_lagged_self(t):
    daily = t.events.groupBy("event_type", event_day().alias("calday")).agg(total("value").alias("today"))
    before = daily.select("event_type", F.date_add("calday", 1).alias("calday"), F.col("today").alias("yesterday"))
    return daily.join(before, ["event_type", "calday"], "left")


@proof(
    "jn_cleaned_key",
    f"""WITH s AS (SELECT NULLIF(LTRIM(lpad(CAST(l_partkey AS VARCHAR), 18, '0'), '0'), '') AS k, l_quantity FROM lineitem),
             p AS (SELECT NULLIF(LTRIM(CAST(p_partkey AS VARCHAR), '0'), '') AS k, p_brand FROM part)
        SELECT p_brand, COUNT(*) AS n, {sql_total("l_quantity")} AS qty FROM s JOIN p USING (k) GROUP BY 1""",
)
def jn_cleaned_key(t):
    sales = t.lineitem.select(
        strip_zeros(F.lpad(F.col("l_partkey").cast("string"), 18, "0")).alias("k"), "l_quantity"
    )
    items = t.part.select(strip_zeros(F.col("p_partkey").cast("string")).alias("k"), "p_brand")
    return sales.join(items, "k").groupBy("p_brand").agg(F.count("*").alias("n"), total("l_quantity").alias("qty"))


ROUTES_SQL = "(VALUES ('north', '0, 1,2'), ('south', '2,3,4, 4'), ('east', '7,,9')) r(route, members)"


@proof(
    "jn_list_contains",
    f"""SELECT route, n_name, COUNT(*) AS n_suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN {ROUTES_SQL}
        ON instr(',' || replace(members, ' ', '') || ',', ',' || CAST(n_nationkey AS VARCHAR) || ',') > 0 GROUP BY 1, 2""",
)
def jn_list_contains(t):
    routes = values(t.spark, [("north", "0, 1,2"), ("south", "2,3,4, 4"), ("east", "7,,9")], "route string, members string")
    stops = J.by_list_member(routes, "members", "key")
    sites = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return (
        sites.withColumn("key", F.col("n_nationkey").cast("string")).join(stops, "key")
        .groupBy("route", "n_name").agg(F.count("*").alias("n_suppliers"))
    )


@proof(
    "jn_fallback_keys",
    """SELECT p_partkey, COALESCE(a.vendor, b.vendor, c.vendor) AS vendor FROM part
       LEFT JOIN (VALUES ('Brand#7', 'LARGE', 'v1'), ('Brand#16', 'ECONOMY', 'v2')) a(brand, type, vendor)
         ON p_brand = a.brand AND p_type = a.type
       LEFT JOIN (VALUES ('Brand#7', 'v3'), ('Brand#4', 'v4')) b(brand, vendor) ON p_brand = b.brand
       LEFT JOIN (VALUES ('LARGE', 'v5'), ('SMALL', 'v6')) c(type, vendor) ON p_type = c.type""",
)
def jn_fallback_keys(t):
    exact = values(t.spark, [("Brand#7", "LARGE", "v1"), ("Brand#16", "ECONOMY", "v2")], "p_brand string, p_type string, vendor string")
    brand = values(t.spark, [("Brand#7", "v3"), ("Brand#4", "v4")], "p_brand string, vendor string")
    kind = values(t.spark, [("LARGE", "v5"), ("SMALL", "v6")], "p_type string, vendor string")
    lookups = [(exact, ["p_brand", "p_type"]), (brand, ["p_brand"]), (kind, ["p_type"])]
    return J.first_match(t.part, lookups, "vendor", "vendor").select("p_partkey", "vendor")


@proof(
    "jn_broadcast_hint",
    f"""SELECT s_nationkey, COUNT(*) AS n, {sql_total("l_extendedprice")} AS amount
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1""",
)
def jn_broadcast_hint(t):
    sites = broadcast_within(t.supplier.select("s_suppkey", "s_nationkey"))
    joined = t.lineitem.join(sites, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy("s_nationkey").agg(F.count("*").alias("n"), total("l_extendedprice").alias("amount"))


@proof(
    "jn_lateral_explode",
    """SELECT lang, word, COUNT(*) AS n FROM (SELECT lang, UNNEST(string_split(text, ' ')) AS word FROM documents)
       WHERE word <> '' GROUP BY 1, 2""",
)
def jn_lateral_explode(t):
    words = t.documents.select("lang", F.explode(F.split("text", " ")).alias("word"))
    return words.where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("n"))


@proof(
    "jn_lateral_outer",
    """WITH lines AS (SELECT conv_id, turn, list_filter(string_split(text, ' '), lambda w: length(w) > 9) AS long_words FROM conversations)
       SELECT conv_id, turn, UNNEST(long_words) AS long_word FROM lines
       UNION ALL SELECT conv_id, turn, NULL FROM lines WHERE len(long_words) = 0""",
)
def jn_lateral_outer(t):
    long_words = F.filter(F.split("text", " "), lambda w: F.length(w) > 9)
    return t.conversations.select("conv_id", "turn", F.explode_outer(long_words).alias("long_word"))


@proof(
    "jn_temporal_validity",
    f"""WITH v AS ({USER_VERSIONS_SQL})
        SELECT e.event_id, v.status FROM events e LEFT JOIN v
        ON e.user_id = v.user_id AND CAST(e.ts AS DATE) BETWEEN v.start_date AND v.end_date""",
)
def jn_temporal_validity(t):
    facts = t.events.select("event_id", "user_id", event_day().alias("calday"))
    versions = user_versions(t).select("user_id", "status", "start_date", "end_date")
    return J.temporal_join(facts, versions, ["user_id"], "calday").select("event_id", "status")


@proof(
    "jn_asof_snapshot",
    """WITH snap AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS snap_day FROM events WHERE dayofweek(ts) = 1),
            cnt AS (SELECT user_id, CAST(ts AS DATE) AS snap_day, COUNT(*) AS n_snap FROM events WHERE dayofweek(ts) = 1 GROUP BY 1, 2),
            days AS (SELECT DISTINCT snap_day FROM snap),
            per AS (SELECT snap_day, COALESCE(LEAD(snap_day) OVER (ORDER BY snap_day) - 1, DATE '2024-01-31') AS snap_to FROM days)
       SELECT e.event_id, per.snap_day, cnt.n_snap FROM events e
       JOIN per ON CAST(e.ts AS DATE) BETWEEN per.snap_day AND per.snap_to
       LEFT JOIN cnt ON cnt.user_id = e.user_id AND cnt.snap_day = per.snap_day""",
)
def jn_asof_snapshot(t):
    snapshots = (
        t.events.where(F.dayofweek("ts") == 2)
        .groupBy("user_id", event_day().alias("snap_day")).agg(F.count("*").alias("n_snap"))
    )
    last = F.lit("2024-01-31").cast("date")
    facts = t.events.select("event_id", "user_id", event_day().alias("calday"))
    joined = J.asof_snapshot_join(facts, snapshots, ["user_id"], "calday", "snap_day", last)
    return joined.select("event_id", "snap_day", "n_snap")
