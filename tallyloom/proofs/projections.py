"""Proofs of projection, renaming, cleaning and record building."""

from pyspark.sql import functions as F

from tallyloom.functions import nested, numbers, text
from tallyloom.functions.dates import add_partition_columns
from tallyloom.proofs.common import r6, sql_total, total
from tallyloom.proofs.registry import proof


@proof(
    "prj_clean_columns",
    'SELECT o_orderkey AS "order_key", o_totalprice AS "Total_Price_", o_orderstatus AS "plant_status" FROM orders',
)
def prj_clean_columns(t):
    raw = t.orders.select(
        F.col("o_orderkey").alias("order key"),
        F.col("o_totalprice").alias("Total-Price (#)"),
        F.col("o_orderstatus").alias("plant/status"),
    )
    return text.clean_columns(text.slash_to_underscore(raw))


@proof(
    "prj_snake_case",
    """SELECT c_custkey AS "cust_key", c_acctbal AS "acct_bal2_x", c_mktsegment AS "bic/mkt_segment" FROM customer""",
)
def prj_snake_case(t):
    raw = t.customer.select(
        F.col("c_custkey").alias("custKey"),
        F.col("c_acctbal").alias("acctBal2 X!"),
        F.col("c_mktsegment").alias("/bic/mktSegment"),
    )
    renamed = text.snake_case_columns(raw)
    return renamed.toDF(*[n.lstrip("/") for n in renamed.columns])


@proof("prj_star_except", "SELECT * EXCLUDE (o_totalprice, o_orderpriority) FROM orders")
def prj_star_except(t):
    return t.spark.sql("SELECT * EXCEPT (o_totalprice, o_orderpriority) FROM {orders}", orders=t.orders)


@proof(
    "prj_struct_pack",
    f"""SELECT l_suppkey, {sql_total("l_quantity")} AS qty, {sql_total("l_extendedprice")} AS amount, COUNT(*) AS n_lines
        FROM lineitem GROUP BY 1""",
)
def prj_struct_pack(t):
    sums = t.lineitem.groupBy("l_suppkey").agg(
        nested.pack(qty=total("l_quantity"), amount=total("l_extendedprice")).alias("revenue"),
        nested.pack(n_lines=F.count("*")).alias("volume"),
    )
    return sums.select("l_suppkey", "revenue.qty", "revenue.amount", "volume.n_lines")


@proof(
    "prj_struct_rebuild",
    """SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS nation, CAST(ROUND(c_acctbal) AS BIGINT) AS balance,
              UPPER(c_mktsegment) AS segment FROM customer""",
)
def prj_struct_rebuild(t):
    entered = t.customer.select(
        "c_custkey",
        nested.pack(
            by=nested.pack(site=nested.pack(nation=F.col("c_nationkey"), extra=F.lit(None).cast("string"))),
            balance=F.col("c_acctbal"),
            segment=F.col("c_mktsegment"),
        ).alias("data"),
    )
    target = "struct<by:struct<site:struct<nation:string,extra:string>>,balance:bigint,segment:string>"
    rounded = F.col("data").withField("balance", F.round("data.balance")).withField("segment", F.upper("data.segment"))
    typed = entered.withColumn("data", rounded.cast(target))
    return typed.select("c_custkey", "data.by.site.nation", "data.balance", "data.segment")


@proof(
    "cln_blank_null",
    """SELECT doc_id, NULLIF(lang, 'en') AS lang, CASE WHEN source NOT IN ('src1', 'src10') THEN source END AS source FROM documents""",
)
def cln_blank_null(t):
    return t.documents.select(
        "doc_id",
        text.blank_to_null(F.col("lang"), ["en"]).alias("lang"),
        text.blank_to_null(F.col("source"), ["src1", "src10"]).alias("source"),
    )


@proof(
    "cln_coalesce_chain",
    """SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'BUILDING'), NULLIF(n_name, 'NATION_3'), 'unknown') AS label
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def cln_coalesce_chain(t):
    wide = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    label = F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.nullif("n_name", F.lit("NATION_3")), F.lit("unknown"))
    return wide.select("c_custkey", label.alias("label"))


# fixed values: upper limits of revenue per day and the tier below each
TIER_CUTS = [(8000.0, "N1"), (12000.0, "N2"), (15000.0, "N3"), (18000.0, "N4"), (25000.0, "N5")]


@proof(
    "prj_case_tier",
    f"""WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, {sql_total("l_extendedprice")} AS rev FROM lineitem GROUP BY 1, 2),
             r AS (SELECT l_suppkey, CAST(SUM(CAST(rev AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS per_day FROM d GROUP BY 1)
        SELECT l_suppkey, ROUND(per_day, 6) AS per_day, CASE WHEN per_day < 8000 THEN 'N1' WHEN per_day < 12000 THEN 'N2' WHEN per_day < 15000 THEN 'N3'
               WHEN per_day < 18000 THEN 'N4' WHEN per_day < 25000 THEN 'N5' ELSE 'N6' END AS tier FROM r""",
)
def prj_case_tier(t):
    daily = t.lineitem.groupBy("l_suppkey", F.to_date("l_shipdate").alias("d")).agg(total("l_extendedprice").alias("rev"))
    rate = daily.groupBy("l_suppkey").agg((total("rev") / F.count("*")).alias("per_day"))
    tiered = rate.withColumn("tier", numbers.band(F.col("per_day"), TIER_CUTS, "N6"))
    return tiered.withColumn("per_day", r6(F.col("per_day")))


@proof(
    "prj_partition_columns",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS yyyy, strftime(o_orderdate, '%m') AS mm, strftime(o_orderdate, '%d') AS dd FROM orders""",
)
def prj_partition_columns(t):
    return add_partition_columns(t.orders, "o_orderdate").select("o_orderkey", "yyyy", "mm", "dd")


@proof(
    "prj_line_type",
    f"""SELECT CASE WHEN l_returnflag = 'N' AND l_quantity <> 0 THEN 'SALE_LINE_ITEM' WHEN l_linestatus = 'F' AND l_tax > 0.04 THEN 'PAYMENT'
                    WHEN l_discount > 0.05 THEN 'PROMOTION' WHEN l_returnflag IN ('A', 'R') AND l_tax = 0 THEN 'TAX_AMT_VIADISCOUNT' ELSE 'OTHER' END AS line_type,
               COUNT(*) AS n FROM lineitem GROUP BY 1""",
)
def prj_line_type(t):
    rules = [
        ("SALE_LINE_ITEM", (F.col("l_returnflag") == "N") & (F.col("l_quantity") != 0)),
        ("PAYMENT", (F.col("l_linestatus") == "F") & (F.col("l_tax") > 0.04)),
        ("PROMOTION", F.col("l_discount") > 0.05),
        ("TAX_AMT_VIADISCOUNT", F.col("l_returnflag").isin("A", "R") & (F.col("l_tax") == 0)),
    ]
    return t.lineitem.groupBy(text.first_label(rules, "OTHER").alias("line_type")).agg(F.count("*").alias("n"))


@proof(
    "prj_code_map",
    """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'Promotion' WHEN 'LARGE' THEN 'Large pack' ELSE p_type END AS type_label,
              CAST(CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 5 WHEN p_type = 'LARGE' THEN 8 ELSE 10 END AS INTEGER) AS vat FROM part""",
)
def prj_code_map(t):
    label = text.map_codes(F.col("p_type"), {"PROMO": "Promotion", "LARGE": "Large pack"}, F.col("p_type"))
    vat = text.map_codes(F.col("p_type"), {"SMALL": 5, "MEDIUM": 5, "LARGE": 8}, F.lit(10))
    return t.part.select("p_partkey", label.alias("type_label"), vat.alias("vat"))


@proof(
    "prj_view",
    f"SELECT o_orderstatus, {sql_total('o_totalprice')} AS amount FROM orders GROUP BY 1",
)
def prj_view(t):
    t.orders.createOrReplaceTempView("tallyloom_order_view")
    return t.spark.sql(
        """SELECT o_orderstatus, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
           FROM tallyloom_order_view GROUP BY o_orderstatus"""
    )
