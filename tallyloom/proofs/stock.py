"""Proofs of stock and cost operators, with shipments as movements and receipts."""

from pyspark.sql import functions as F

from tallyloom.functions.dates import day
from tallyloom.plans import balance as B
from tallyloom.proofs.common import event_day, ship_day
from tallyloom.proofs.registry import proof

LAST = "2001-12-31"


@proof(
    "x_running_balance",
    f"""WITH m AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d,
                   CAST(SUM(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_quantity AS DECIMAL(18,3))) AS DECIMAL(28,3)) AS q FROM lineitem GROUP BY 1, 2),
             p AS (SELECT l_suppkey, d, ROUND(SUM(q) OVER w, 3) AS balance, LEAD(d) OVER w AS d_to FROM m WINDOW w AS (PARTITION BY l_suppkey ORDER BY d)),
             spine AS (SELECT CAST(UNNEST(generate_series(MIN(d), DATE '{LAST}', INTERVAL 1 DAY)) AS DATE) AS calday FROM m),
             f AS (SELECT calday, l_suppkey, balance, ROW_NUMBER() OVER (PARTITION BY l_suppkey, CAST(trunc(balance) AS BIGINT) ORDER BY calday) AS rn
                   FROM spine JOIN p ON calday >= d AND (calday < d_to OR d_to IS NULL))
        SELECT calday, l_suppkey, CAST(balance AS DOUBLE) AS balance FROM f WHERE balance <> 0 OR rn = 1""",
)
def x_running_balance(t):
    quantity = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    moves = t.lineitem.select("l_suppkey", ship_day().alias("d"), quantity.cast("decimal(18,3)").alias("q"))
    out = B.balance_from_movements(moves, ["l_suppkey"], "d", "q", LAST)
    return out.withColumn("balance", F.col("balance").cast("double"))


VALUE_FIRST, VALUE_LAST = "1995-01-01", "1999-12-31"


@proof(
    "x_running_balance_value",
    f"""WITH l AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, CASE WHEN l_returnflag = 'N' THEN 1 ELSE -1 END AS sign, l_tax FROM lineitem),
             m AS (SELECT l_suppkey, CASE WHEN d < DATE '{VALUE_FIRST}' THEN DATE '{VALUE_FIRST}' - 1 ELSE d END AS d, SUM(CAST(sign * 0.2505 AS DECIMAL(18,4))) AS q,
                          SUM(CAST(sign * l_tax * 10 AS DECIMAL(18,2))) AS v FROM l WHERE d <= DATE '{VALUE_LAST}' GROUP BY 1, 2),
             p AS (SELECT l_suppkey, d, ROUND(SUM(q) OVER w, 3) AS quantity, SUM(v) OVER w AS amount, LEAD(d) OVER w AS d_to FROM m WINDOW w AS (PARTITION BY l_suppkey ORDER BY d)),
             spine AS (SELECT CAST(UNNEST(generate_series(DATE '{VALUE_FIRST}', DATE '{VALUE_LAST}', INTERVAL 1 DAY)) AS DATE) AS calday),
             f AS (SELECT calday, l_suppkey, quantity, amount, ROW_NUMBER() OVER (PARTITION BY l_suppkey, ROUND(quantity, 0), ROUND(amount, 0) ORDER BY calday) AS rn
                   FROM spine JOIN p ON calday >= d AND (calday < d_to OR d_to IS NULL))
        SELECT calday, l_suppkey, CAST(quantity AS DOUBLE) AS quantity, CAST(amount AS DOUBLE) AS amount FROM f WHERE quantity <> 0 OR amount <> 0 OR rn = 1""",
)
def x_running_balance_value(t):
    """Small pieces in and out, so that balances pass through zero; what came before the first day is the opening balance."""
    sign = F.when(F.col("l_returnflag") == "N", 1).otherwise(-1)
    quantity, amount = (sign * F.lit(0.2505)).cast("decimal(18,4)"), (sign * F.col("l_tax") * 10).cast("decimal(18,2)")
    moves = t.lineitem.select("l_suppkey", ship_day().alias("d"), quantity.alias("quantity"), amount.alias("amount"))
    first = day(VALUE_FIRST)
    before = moves.where(F.col("d") < first).groupBy("l_suppkey").agg(F.sum("quantity").alias("quantity"), F.sum("amount").alias("amount"))
    opening = before.withColumn("d", F.date_sub(first, 1))
    out = B.balances_from_movements(moves.where(F.col("d") >= first), ["l_suppkey"], "d", {"quantity": 3, "amount": None}, VALUE_FIRST, VALUE_LAST, opening)
    return out.withColumns({m: F.col(m).cast("double") for m in ("quantity", "amount")})


BANDS = [("1", 0, 30), ("2", 30, 90), ("3", 90, 180), ("4", 180, 270), ("5", 270, 360), ("6", 360, 720)]  # fixed values
BAND_SQL = "CASE " + " ".join(f"WHEN age + 1 > {lo} AND age + 1 <= {hi} THEN '{i}'" for i, lo, hi in BANDS) + " END"
STOCK_DAY = "2001-08-01"


def stock_and_receipts(t):
    receipts = t.lineitem.where(ship_day() <= day(STOCK_DAY)).select(
        "l_partkey",
        ship_day().alias("gr_date"),
        F.col("l_quantity").alias("gr_qty"),
        (F.col("l_quantity") * 2).alias("gr_value"),
    )
    sold = t.lineitem.groupBy("l_partkey").agg(F.floor(F.sum("l_quantity") * 0.4).cast("double").alias("stock_qty"))
    stock = sold.withColumn("stock_value", F.floor(F.col("stock_qty") * 2.5))
    return stock.withColumn("stock_value", F.col("stock_value").cast("double")), receipts


FIFO_SQL = f"""WITH stock AS (SELECT l_partkey, floor(SUM(l_quantity) * 0.4) AS sq FROM lineitem GROUP BY 1),
         st AS (SELECT *, floor(sq * 2.5) AS sv FROM stock),
         r AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS gr_date, SUM(l_quantity) AS gq, SUM(l_quantity * 2) AS gv FROM lineitem
               WHERE CAST(l_shipdate AS DATE) <= DATE '{STOCK_DAY}' GROUP BY 1, 2),
         a AS (SELECT *, date_diff('day', gr_date, DATE '{STOCK_DAY}') AS age FROM r),
         b AS (SELECT *, {BAND_SQL} AS band FROM a),
         c AS (SELECT *, SUM(gq) OVER w - gq AS qb, SUM(gv) OVER w - gv AS vb FROM b WHERE band IS NOT NULL AND gq > 0
               WINDOW w AS (PARTITION BY l_partkey ORDER BY band, age ROWS UNBOUNDED PRECEDING)),
         one AS (SELECT st.l_partkey, gr_date, COALESCE(age, 721) AS aging_days, COALESCE(band, '7') AS band_id, 1 AS flag,
                   CASE WHEN gq IS NULL THEN sq WHEN sq > qb THEN LEAST(sq - qb, gq) ELSE 0 END AS aging_qty,
                   CASE WHEN gv IS NULL THEN sv WHEN sv > vb THEN LEAST(sv - vb, gv) ELSE 0 END AS aging_value
                 FROM st LEFT JOIN c ON st.l_partkey = c.l_partkey),
         one_k AS (SELECT * FROM one WHERE NOT (ROUND(aging_qty, 3) <= 0.001 AND ROUND(aging_value, 3) <= 0.001)),
         g1 AS (SELECT l_partkey, SUM(aging_qty) AS gq, SUM(aging_value) AS gv FROM one_k GROUP BY 1),
         two AS (SELECT l_partkey, NULL::DATE AS gr_date, 721 AS aging_days, '7' AS band_id, 2 AS flag, sq - gq AS aging_qty, sv - gv AS aging_value
                 FROM st JOIN g1 USING (l_partkey) WHERE ROUND(sq, 3) > ROUND(gq, 3) AND NOT (ROUND(sq - gq, 3) <= 0.001 AND ROUND(sv - gv, 3) <= 0.001)),
         upto2 AS (SELECT * FROM one_k UNION ALL SELECT * FROM two),
         g2 AS (SELECT l_partkey, SUM(aging_value) AS gv FROM upto2 GROUP BY 1),
         three AS (SELECT l_partkey, NULL::DATE AS gr_date, 721 AS aging_days, '7' AS band_id, 3 AS flag, 0.0::DOUBLE AS aging_qty, sv - gv AS aging_value
                   FROM st JOIN g2 USING (l_partkey) WHERE ROUND(sv - gv, 3) > 0.001)
        SELECT l_partkey, gr_date, CAST(aging_days AS INTEGER) AS aging_days, band_id, CAST(flag AS INTEGER) AS flag, aging_qty::DOUBLE AS aging_qty, aging_value::DOUBLE AS aging_value
        FROM upto2 UNION ALL SELECT * FROM three"""


@proof("x_fifo_aging", FIFO_SQL)
def x_fifo_aging(t):
    stock, receipts = stock_and_receipts(t)
    return B.fifo_aging(stock, receipts, ["l_partkey"], STOCK_DAY, BANDS, "7")


@proof(
    "x_aging_clusters",
    f"""WITH w AS (SELECT f.*, p_type, p_brand, p_size FROM ({FIFO_SQL}) f JOIN part ON l_partkey = p_partkey),
             n AS (SELECT p_type, p_brand, COUNT(DISTINCT CASE WHEN band_id >= '5' THEN l_partkey END) AS n_old, COUNT(DISTINCT l_partkey) AS n FROM w GROUP BY 1, 2),
             c AS (SELECT *, CASE WHEN n_old = 0 THEN 'No' WHEN n_old < 0.33 * n THEN 'Local' WHEN n_old > 0.67 * n THEN 'Regional' ELSE 'Local - Regional' END AS aging_cluster FROM n)
        SELECT aging_cluster, band_id, COUNT(*) AS n,
               ROUND(SUM(GREATEST(p_size * 10 * CASE WHEN p_size > 25 THEN 0.75::DOUBLE ELSE 0.63::DOUBLE END - aging_days, 0)), 3) AS days_left
        FROM w JOIN c USING (p_type, p_brand) GROUP BY 1, 2""",
)
def x_aging_clusters(t):
    stock, receipts = stock_and_receipts(t)
    aged = B.fifo_aging(stock, receipts, ["l_partkey"], STOCK_DAY, BANDS, "7")
    wide = aged.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand", "p_size"), "l_partkey")
    clusters = B.aging_cluster(wide, ["p_type", "p_brand"], "l_partkey", [b[0] for b in BANDS if b[0] >= "5"] + ["7"])
    life = B.remaining_shelf_life(F.col("p_size") * 10, F.when(F.col("p_size") > 25, "VN").otherwise("XX"), F.col("aging_days"), 0.75, 0.63)
    return wide.join(clusters, ["p_type", "p_brand"]).groupBy("aging_cluster", "band_id").agg(
        F.count("*").alias("n"), F.round(F.sum(life), 3).alias("days_left")
    )


HORIZONS = [7, 14, 28]
COST_LAST = "2024-01-31"


def _rolled(t, keys=("user_id",), horizons=HORIZONS):
    costs = t.events.select(*keys, event_day().alias("d"), F.col("value").cast("decimal(18,2)").alias("c"), F.get_json_object("props", "$.k").cast("decimal(18,2)").alias("q"))
    return B.rolling_cost(costs, list(keys), "d", "c", "q", horizons, COST_LAST)


def _rolled_sql():
    sums = ", ".join(
        f"SUM(CASE WHEN d > calday - {h} THEN c ELSE 0 END) AS c{h}, SUM(CASE WHEN d > calday - {h} THEN q ELSE 0 END) AS q{h}" for h in HORIZONS
    )
    return f"""e AS (SELECT user_id, CAST(ts AS DATE) AS d, SUM(CAST(value AS DECIMAL(18,2))) AS c,
                      SUM(CAST(json_extract_string(props, '$.k') AS DECIMAL(18,2))) AS q FROM events GROUP BY 1, 2),
               spine AS (SELECT CAST(UNNEST(generate_series(MIN(d), DATE '{COST_LAST}', INTERVAL 1 DAY)) AS DATE) AS calday FROM e),
               s AS (SELECT calday, user_id, {sums} FROM spine JOIN e ON d > calday - 28 AND calday >= d GROUP BY 1, 2)"""


@proof(
    "x_rolling_cost",
    f"""WITH {_rolled_sql()} SELECT calday, user_id,
        {", ".join(f"CAST(c{h} AS DOUBLE) AS cost_{h}d, CAST(q{h} AS DOUBLE) AS qty_{h}d" for h in HORIZONS)},
        COALESCE({", ".join(f"CAST(c{h} AS DOUBLE) / NULLIF(ROUND(CAST(q{h} AS DOUBLE), 3), 0)" for h in HORIZONS)}) AS unit_value FROM s""",
)
def x_rolling_cost(t):
    rolled = _rolled(t)
    return rolled.withColumns({f"{m}_{h}d": F.col(f"{m}_{h}d").cast("double") for h in HORIZONS for m in ("cost", "qty")})


@proof(
    "x_least_positive_cost",
    f"""WITH {_rolled_sql()},
        u AS (SELECT calday, user_id, {", ".join(f"COALESCE(CAST(c{h} AS DOUBLE) / NULLIF(ROUND(CAST(q{h} AS DOUBLE), 3), 0), 0) AS unit_{h}d" for h in HORIZONS)} FROM s),
        o AS (SELECT user_id, d AS calday, COALESCE(CAST(c AS DOUBLE) / NULLIF(ROUND(CAST(q AS DOUBLE), 3), 0), 0) AS unit_own FROM e),
        j AS (SELECT calday, user_id, COALESCE(unit_own, 0) AS unit_own, {", ".join(f"COALESCE(unit_{h}d, 0) AS unit_{h}d" for h in HORIZONS)} FROM o FULL JOIN u USING (calday, user_id))
        SELECT *, (SELECT MIN(v) FROM (VALUES (unit_own), (unit_7d), (unit_14d), (unit_28d)) x(v) WHERE v > 0) AS cost_per_unit FROM j""",
)
def x_least_positive_cost(t):
    """A day's own cost is its trailing cost of one day."""
    rolled = _rolled(t, horizons=[1, *HORIZONS])
    names = {1: "unit_own"} | {h: f"unit_{h}d" for h in HORIZONS}
    units = rolled.select("calday", "user_id", *[B.unit_cost(f"cost_{h}d", f"qty_{h}d").alias(n) for h, n in names.items()])
    return B.least_positive_cost(units, list(names.values()))
