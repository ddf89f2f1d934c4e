"""Proofs of sales statistics."""

from datetime import date

from pyspark.sql import functions as F

from tallyloom.functions.dates import day
from tallyloom.operators.aggregates import exact_percentiles
from tallyloom.plans import demand
from tallyloom.proofs.common import event_day, r6, ship_day, sql_total, total
from tallyloom.proofs.registry import proof
from tallyloom.session import fresh_dir
from tallyloom.sinks import tables as W
from tallyloom.sources.constants import date_spine, values


@proof(
    "x_upper_bounds",
    """SELECT p_brand, ROUND(quantile_cont(l_quantity, 0.8), 6) AS pct_80, ROUND(quantile_cont(l_quantity, 0.85), 6) AS pct_85,
              ROUND(quantile_cont(l_quantity, 0.9), 6) AS pct_90, ROUND(quantile_cont(l_quantity, 0.95), 6) AS pct_95
       FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_quantity > 0 AND NOT (month(l_shipdate) = 2 AND day(l_shipdate) <= 7) GROUP BY 1""",
)
def x_upper_bounds(t):
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    sales = t.lineitem.withColumn("calday", ship_day()).join(brands, "l_partkey")
    # holiday weeks: the first seven days of February of every year in the data
    days = date_spine(t.spark, "1995-01-01", "2001-12-31")
    holidays = days.where((F.month("calday") == 2) & (F.day("calday") <= 7))
    bounds = demand.upper_bounds(sales, ["p_brand"], "l_quantity", "calday", holidays)
    return bounds.select("p_brand", *[r6(F.col(c)).alias(c) for c in bounds.columns if c != "p_brand"])


@proof(
    "x_bom_explode",
    """WITH s AS (SELECT l_suppkey, l_partkey, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem GROUP BY 1, 2),
            bom AS (SELECT p_partkey AS bundle, p_partkey + 1 AS component, 2 AS cq, 1 AS bq FROM part WHERE p_type = 'PROMO'
                    UNION ALL SELECT p_partkey, p_partkey + 2, 1, 2 FROM part WHERE p_type = 'PROMO'),
            u AS (SELECT * FROM s UNION ALL SELECT l_suppkey, component, q * cq / bq FROM s JOIN bom ON l_partkey = bundle)
       SELECT l_suppkey, l_partkey, CAST(SUM(q) AS DOUBLE) AS qty FROM u GROUP BY 1, 2""",
)
def x_bom_explode(t):
    bundles = t.part.where("p_type = 'PROMO'")

    def component(offset, quantity, base):
        return bundles.select(
            F.col("p_partkey").alias("l_partkey"),
            (F.col("p_partkey") + offset).alias("component_id"),
            F.lit(quantity).alias("component_quantity"),
            F.lit(base).alias("base_quantity"),
        )

    bom = component(1, 2, 1).unionByName(component(2, 1, 2))
    sales = t.lineitem.select("l_suppkey", "l_partkey", F.col("l_quantity").alias("qty"))
    return demand.bom_explode(sales, bom, ["l_suppkey"], "l_partkey", "qty")


OVERRIDE = [("1997.51", "1996.52"), ("1998.01", "1997.03"), ("1998.02", "1997.04")]


def _weekly(t):
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = t.lineitem.join(brands, "l_partkey").withColumn("d", ship_day())
    return lines.groupBy("p_brand", F.year("d").alias("calyear"), F.weekofyear("d").alias("calweek")).agg(
        total("l_extendedprice").alias("rev")
    )


@proof(
    "x_seasonality_index",
    f"""WITH l AS (SELECT p_brand, CAST(year(l_shipdate) AS INTEGER) AS calyear, CAST(weekofyear(l_shipdate) AS INTEGER) AS calweek, {sql_total("l_extendedprice")} AS rev
                   FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
             d AS (SELECT CAST(UNNEST(generate_series(MIN(CAST(l_shipdate AS DATE)), MAX(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem),
             w0 AS (SELECT DISTINCT CAST(year(d) AS INTEGER) AS calyear, CAST(weekofyear(d) AS INTEGER) AS calweek FROM d),
             w AS (SELECT *, CAST(COUNT(*) OVER (PARTITION BY calyear) AS INTEGER) AS cnt_isoweek FROM w0),
             g AS (SELECT b.p_brand, w.*, COALESCE(l.rev, 0) AS rev FROM (SELECT DISTINCT p_brand FROM l) b CROSS JOIN w LEFT JOIN l USING (p_brand, calyear, calweek)),
             s AS (SELECT *, calyear || '.' || lpad(CAST(calweek AS VARCHAR), 2, '0') AS year_week,
                     COALESCE(AVG(rev) OVER (PARTITION BY p_brand, calyear ORDER BY calweek ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)
                              / NULLIF(AVG(rev) OVER (PARTITION BY p_brand, calyear), 0), 1) AS idx FROM g),
             p AS (SELECT p_brand, quantile_cont(idx, 0.05) AS lo, quantile_cont(idx, 0.95) AS hi FROM s WHERE idx > 0 AND year_week >= '1996.01' GROUP BY 1),
             ov AS (SELECT * FROM (VALUES {", ".join(str(r) for r in OVERRIDE)}) o(year_week_apply, year_week))
        SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY p_brand, year_week_apply ORDER BY is_shifted, year_week) AS INTEGER) AS rn FROM (
        SELECT p_brand, calyear, calweek, year_week, ov.year_week_apply IS NULL AS is_shifted, ROUND(lo, 6) AS lower_value, ROUND(hi, 6) AS upper_value,
               ROUND(CASE WHEN idx < lo THEN lo WHEN idx > hi THEN hi ELSE idx END, 6) AS seasonality_index,
               COALESCE(ov.year_week_apply, CASE WHEN calweek - 2 <= 0 THEN calyear || '.' || lpad(CAST(calweek - 2 + cnt_isoweek AS VARCHAR), 2, '0')
                        ELSE (calyear + 1) || '.' || lpad(CAST(calweek - 2 AS VARCHAR), 2, '0') END) AS year_week_apply
        FROM s LEFT JOIN p USING (p_brand) LEFT JOIN ov USING (year_week))""".replace("SELECT *, CAST(ROW", "SELECT * EXCLUDE (is_shifted), CAST(ROW"),
)
def x_seasonality_index(t):
    ends = t.lineitem.agg(F.min(ship_day()).alias("a"), F.max(ship_day()).alias("b"))
    days = ends.select(F.explode(F.sequence("a", "b")).alias("d"))
    weeks = days.select(F.year("d").alias("calyear"), F.weekofyear("d").alias("calweek")).distinct()
    per_year = weeks.groupBy("calyear").agg(F.count("*").cast("int").alias("cnt_isoweek"))
    override = values(t.spark, OVERRIDE, "year_week_apply string, year_week string")
    out = demand.seasonality_index(
        _weekly(t), ["p_brand"], weeks.join(per_year, "calyear"), "rev", "1996.01", override
    )
    return out.select(
        "p_brand", "calyear", "calweek", "year_week", "year_week_apply", "rn",
        *[r6(F.col(c)).alias(c) for c in ("lower_value", "upper_value", "seasonality_index")],
    )


RATE_DAY = "2024-01-31"
#: The day of the rate, and how far the events are moved back to end there. The second one lies in week 53 of the year before.
RATE_DAYS = {RATE_DAY: 0, "2021-01-01": 1125}
GROUP_SQL = "user_id % 5"
#: Index by order priority group and week of 1996, applied to the same week of 2020 and 2024; one group has none, and where two apply the first rank counts.
INDEX_SQL = """SELECT length(o_orderpriority) % 5 AS grp, y || '.' || lpad(CAST(week(CAST(o_orderdate AS DATE)) AS VARCHAR), 2, '0') AS year_week_apply, r AS rn,
        CAST(COUNT(*) AS DOUBLE) * r AS seasonality_index FROM orders, (VALUES (2020, 1), (2020, 2), (2024, 1), (2024, 2)) AS v(y, r) WHERE o_orderstatus <> 'P' OR r = 2 GROUP BY 1, 2, 3"""


def _rate_sql(on, back):
    return f"""SELECT '{on}' AS rate_day, user_id, ROUND(m7, 6) AS ma_short, ROUND(m14, 6) AS ma_middle, ROUND(m28, 6) AS ma_long, ROUND(m14, 6) AS sell_rate,
               ROUND(CASE WHEN trend < lo THEN lo WHEN trend > hi THEN hi ELSE trend END, 6) AS sale_trend, COALESCE(si, 1) AS seasonality_index
        FROM (WITH d AS (SELECT user_id, CAST(ts AS DATE) - {back} AS calday, {sql_total("value")} AS v FROM events GROUP BY 1, 2),
             m AS (SELECT user_id, AVG(CASE WHEN calday >= DATE '{on}' - 7 THEN v END) AS m7, AVG(CASE WHEN calday >= DATE '{on}' - 14 THEN v END) AS m14,
                          AVG(v) AS m28 FROM d WHERE calday >= DATE '{on}' - 28 AND calday < DATE '{on}' GROUP BY 1),
             r AS (SELECT *, CASE WHEN COALESCE(m14, 0) = 0 THEN 0 ELSE m7 / m14 END AS tr FROM m),
             s AS (SELECT user_id, m7, m14, m28, CASE WHEN COALESCE(tr, 0) = 0 THEN 1 ELSE tr END AS trend FROM r),
             b AS (SELECT quantile_cont(trend, 0.1) AS lo, quantile_cont(trend, 0.9) AS hi FROM s),
             i AS (SELECT grp, arg_min(seasonality_index, rn) AS si FROM ({INDEX_SQL}) WHERE year_week_apply = strftime(DATE '{on}', '%G.%V') GROUP BY 1)
             SELECT * FROM s CROSS JOIN b LEFT JOIN i ON {GROUP_SQL} = grp)"""


@proof("x_sell_rate", " UNION ALL ".join(_rate_sql(on, back) for on, back in RATE_DAYS.items()))
def x_sell_rate(t):
    """Rates of two days with the index of their week: one inside a year, one in week 53, which belongs to the year before."""
    week = F.concat(F.lit("."), F.lpad(F.weekofyear("o_orderdate").cast("string"), 2, "0"))
    ranks = F.explode(F.array(*[F.struct(F.lit(y).alias("y"), F.lit(r).alias("rn")) for y in ("2020", "2024") for r in (1, 2)])).alias("v")
    orders = t.orders.select((F.length("o_orderpriority") % 5).alias("grp"), week.alias("week"), "o_orderstatus", ranks).where("o_orderstatus <> 'P' OR v.rn = 2")
    counted = orders.groupBy("grp", F.concat("v.y", "week").alias("year_week_apply"), F.col("v.rn").alias("rn")).agg(F.count("*").alias("n"))
    index = counted.withColumn("seasonality_index", F.col("n").cast("double") * F.col("rn"))
    out = None
    for on, back in RATE_DAYS.items():
        daily = t.events.groupBy("user_id", F.date_sub(event_day(), back).alias("calday")).agg(total("value").alias("v"))
        rates = demand.sell_rate(daily, ["user_id"], "v", "calday", on, (7, 14, 28))
        bounds = exact_percentiles(rates, [], "sale_trend", {"lo": 0.1, "hi": 0.9})
        clipped = demand.clip_to(rates, "sale_trend", bounds.select("lo").scalar(), bounds.select("hi").scalar())
        clipped = demand.with_seasonality(clipped.withColumn("grp", (F.col("user_id") % 5).cast("int")), index, ["grp"], on).drop("grp")
        rows = clipped.select(F.lit(on).alias("rate_day"), "user_id", *[r6(F.col(c)).alias(c) for c in clipped.columns if c != "user_id"])
        out = rows if out is None else out.unionByName(rows)
    return out


def _outlier_sql():
    """The seven day passes written out: each day's rows read the corrected rows before it."""
    steps = []
    for i, d in enumerate(range(23, 30)):
        on = f"DATE '2024-01-{d}'"
        past = "seed" if i == 0 else f"all{i}"
        steps.append(
            f"""q{i + 1} AS (SELECT user_id, quantile_cont(corrected_qty, 0.25) AS q1, quantile_cont(corrected_qty, 0.75) AS q3,
                       AVG(CASE WHEN calday >= {on} - 30 THEN corrected_qty END) AS mean FROM {past} WHERE calday < {on} AND calday >= {on} - 180 GROUP BY 1),
            r{i + 1} AS (SELECT s.calday, s.user_id, s.base_qty, CAST(s.coupon_qty > s.base_qty * 0.5 AS INTEGER) AS promo,
                       {on} >= first_day + 10 AS settled, q3, mean, GREATEST(q3 + (q3 - q1) * 1.5, 50.0) AS upper
                     FROM sold s JOIN firsts USING (user_id) LEFT JOIN q{i + 1} USING (user_id) WHERE s.calday = {on}),
            c{i + 1} AS (SELECT calday, user_id, base_qty, promo, CASE WHEN settled THEN CAST(COALESCE(q3 IS NOT NULL AND base_qty > upper, FALSE) AS INTEGER) END AS outl,
                       CASE WHEN NOT settled THEN 0.03 WHEN promo = 1 OR base_qty = 0 AND FALSE THEN COALESCE(mean, 0) WHEN q3 IS NOT NULL AND base_qty > upper THEN upper ELSE base_qty END AS corrected_qty FROM r{i + 1}),
            all{i + 1} AS (SELECT calday, user_id, corrected_qty FROM {past} UNION ALL SELECT calday, user_id, corrected_qty FROM c{i + 1})"""
        )
    days = " UNION ALL ".join(f"SELECT * FROM c{i + 1}" for i in range(7))
    return f"""WITH sold AS (SELECT user_id, CAST(ts AS DATE) AS calday, {sql_total("value")} AS base_qty,
                        {sql_total("CASE WHEN event_type = 'click' THEN value ELSE 0 END")} AS coupon_qty FROM events GROUP BY 1, 2),
            firsts AS (SELECT user_id, MIN(calday) AS first_day FROM sold GROUP BY 1),
            seed AS (SELECT calday, user_id, base_qty AS corrected_qty FROM sold WHERE calday < DATE '2024-01-23'), {", ".join(steps)}
        SELECT calday, user_id, base_qty, promo AS is_promotion, outl AS is_outlier, ROUND(corrected_qty, 8) AS corrected_qty FROM ({days})"""


@proof("x_outlier_correct", _outlier_sql())
def x_outlier_correct(t):
    """Three weeks of history as they were sold, then seven days corrected one after the other."""
    table = fresh_dir(t.spark, "corrected")
    sold = t.events.groupBy("user_id", event_day().alias("calday")).agg(
        total("value").alias("base_qty"),
        total(F.when(F.col("event_type") == "click", F.col("value")).otherwise(0)).alias("coupon_qty"),
    )
    bound = sold.groupBy("user_id").agg(F.min("calday").alias("first_day"), F.lit(50.0).alias("pct_95"))
    daily = sold.join(bound, "user_id").withColumns(
        {
            "promo_qty": F.lit(0.0),
            "stock_qty": F.lit(1.0),
            "unit_cost": F.lit(10.0),
            "has_gift": F.lit(False),
            "is_component": F.lit(False),
        }
    )
    history = daily.where(F.col("calday") < day("2024-01-23"))
    seed = history.select("calday", "user_id", "base_qty", F.col("base_qty").alias("corrected_qty"), F.lit(0).alias("is_oos"))
    W.replace_days(W.align_schema(seed, f"calday DATE, user_id BIGINT, {demand.CORRECTED_SCHEMA}"), table, "calday")
    demand.outlier_correct(daily, table, ["user_id"], date(2024, 1, 23), date(2024, 1, 29), settle_days=10)
    out = W.read_table(t.spark, table).where(F.col("calday") >= day("2024-01-23"))
    return out.select("calday", "user_id", "base_qty", "is_promotion", "is_outlier", F.round("corrected_qty", 8).alias("corrected_qty"))
