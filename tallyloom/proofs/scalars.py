"""Proofs of column functions."""

from pyspark.sql import functions as F

from tallyloom.functions import dates, keys, nested, numbers, text
from tallyloom.proofs.common import event_day, order_day, r6, total, wall_time
from tallyloom.proofs.registry import proof
from tallyloom.sources.constants import values


@proof(
    "fn_strip_zeros",
    "SELECT o_orderkey, NULLIF(LTRIM(lpad(CAST(o_orderkey AS VARCHAR), 10, '0'), '0'), '') AS bare FROM orders",
)
def fn_strip_zeros(t):
    padded = F.lpad(F.col("o_orderkey").cast("string"), 10, "0")
    return t.orders.select("o_orderkey", text.strip_zeros(padded).alias("bare"))


@proof(
    "fn_normalize_numeric_text",
    """WITH r AS (SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'x' || p_partkey WHEN p_type = 'LARGE' THEN CAST(p_partkey AS VARCHAR) || '.0'
                         WHEN p_type = 'SMALL' THEN CAST(p_partkey AS VARCHAR) || '.5' ELSE lpad(CAST(p_partkey AS VARCHAR), 9, '0') END AS raw FROM part)
       SELECT p_partkey, CASE WHEN regexp_full_match(raw, '[0-9]+') THEN CAST(CAST(raw AS BIGINT) AS VARCHAR)
              WHEN regexp_full_match(raw, '[0-9]+\\.[0-9]+') AND CAST(raw AS DOUBLE) = floor(CAST(raw AS DOUBLE)) THEN CAST(CAST(CAST(raw AS DOUBLE) AS BIGINT) AS VARCHAR)
              ELSE raw END AS code FROM r""",
)
def fn_normalize_numeric_text(t):
    key = F.col("p_partkey").cast("string")
    raw = (
        F.when(F.col("p_type") == "PROMO", F.concat(F.lit("x"), key))
        .when(F.col("p_type") == "LARGE", F.concat(key, F.lit(".0")))
        .when(F.col("p_type") == "SMALL", F.concat(key, F.lit(".5")))
        .otherwise(F.lpad(key, 9, "0"))
    )
    return t.part.select("p_partkey", text.normalize_numeric_text(raw).alias("code"))


@proof(
    "fn_clean_mobile",
    """WITH r AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '840' WHEN 'MACHINERY' THEN '.0' WHEN 'FURNITURE' THEN '84'
                         WHEN 'HOUSEHOLD' THEN '9' ELSE '09' END || lpad(CAST(c_custkey AS VARCHAR), 9, '1') AS raw FROM customer)
       SELECT c_custkey, CASE WHEN raw LIKE '840%' THEN substr(raw, 3, 15) WHEN raw LIKE '.0%' THEN substr(raw, 2, 15)
              WHEN raw LIKE '84%' AND length(raw) > 10 THEN '0' || substr(raw, 3, 15) WHEN left(raw, 1) BETWEEN '1' AND '9' THEN '0' || raw
              ELSE raw END AS mobile FROM r""",
)
def fn_clean_mobile(t):
    prefix = text.map_codes(
        F.col("c_mktsegment"), {"BUILDING": "840", "MACHINERY": ".0", "FURNITURE": "84", "HOUSEHOLD": "9"}, F.lit("09")
    )
    raw = F.concat(prefix, F.lpad(F.col("c_custkey").cast("string"), 9, "1"))
    return t.customer.select("c_custkey", text.clean_mobile(raw).alias("mobile"))


@proof(
    "fn_surrogate_key",
    """SELECT event_id, md5(coalesce(CAST(user_id AS VARCHAR), '') || '|' || coalesce(NULLIF(event_type, 'view'), '') || '|' || CAST(CAST(ts AS DATE) AS VARCHAR)) AS text_key,
              TRUE AS keyed FROM events""",
)
def fn_surrogate_key(t):
    parts = [F.col("user_id"), F.nullif("event_type", F.lit("view")), event_day()]
    keyed = keys.surrogate_key(*parts).isNotNull() & keys.short_key(*parts).isNotNull()
    return t.events.select("event_id", keys.md5_key(*parts).alias("text_key"), keyed.alias("keyed"))


@proof(
    "fn_pii_hash",
    "SELECT c_custkey, md5(c_name) AS name_hash, upper(md5(c_name)) AS name_hex FROM customer",
)
def fn_pii_hash(t):
    hidden = keys.pseudonym(F.col("c_name"))
    return t.customer.select("c_custkey", F.md5("c_name").alias("name_hash"), F.hex(hidden).alias("name_hex"))


@proof(
    "fn_string_suite",
    """SELECT p_partkey, upper(trim('  ' || p_name || ' ')) AS u, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded, substr(p_name, 2, 3) AS mid,
              replace(p_brand, 'Brand#', 'B') AS short_brand, CAST(length(p_name) AS INTEGER) AS len, left(p_name, 2) AS l2, right(p_name, 2) AS r2,
              CAST(instr(p_name, ' ') AS INTEGER) AS blank_at, split_part(p_name, ' ', 2) AS noun, concat(p_type, '-', p_brand) AS tag FROM part""",
)
def fn_string_suite(t):
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        F.upper(F.trim(F.concat(F.lit("  "), name, F.lit(" ")))).alias("u"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
        F.substring(name, 2, 3).alias("mid"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("short_brand"),
        F.length(name).alias("len"),
        F.left(name, F.lit(2)).alias("l2"),
        F.right(name, F.lit(2)).alias("r2"),
        F.instr(name, " ").alias("blank_at"),
        F.split_part(name, F.lit(" "), F.lit(2)).alias("noun"),
        F.concat("p_type", F.lit("-"), "p_brand").alias("tag"),
    )


@proof(
    "fn_regex_replace",
    "SELECT c_custkey, regexp_replace(c_name, '^Customer#0*', '') AS bare, regexp_replace(c_mktsegment, '[AEIOU]', '', 'g') AS consonants FROM customer",
)
def fn_regex_replace(t):
    return t.customer.select(
        "c_custkey",
        F.regexp_replace("c_name", "^Customer#0*", "").alias("bare"),
        F.regexp_replace("c_mktsegment", "[AEIOU]", "").alias("consonants"),
    )


@proof(
    "fn_parse_compact_date",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d, date_trunc('second', o_orderdate) AS ts FROM orders",
)
def fn_parse_compact_date(t):
    compact = F.when(F.col("o_orderstatus") == "P", "00000000").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    stamp = F.date_format("o_orderdate", "yyyyMMddHHmmss")
    return t.orders.select(
        "o_orderkey", dates.parse_compact_date(compact).alias("d"), wall_time(dates.parse_compact_ts(stamp)).alias("ts")
    )


FORMATS = ["yyyyMMddHHmmss", "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd"]


@proof(
    "fn_parse_multi_format",
    """SELECT event_id, CASE event_type WHEN 'signup' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) WHEN 'error' THEN NULL ELSE date_trunc('second', ts) END AS parsed FROM events""",
)
def fn_parse_multi_format(t):
    kind = F.col("event_type")
    raw = (
        F.when(kind == "view", F.date_format("ts", FORMATS[0]))
        .when(kind == "click", F.date_format("ts", FORMATS[1]))
        .when(kind == "purchase", F.date_format("ts", FORMATS[2]))
        .when(kind == "signup", F.date_format("ts", FORMATS[3]))
        .otherwise("not a time")
    )
    return t.events.select("event_id", wall_time(dates.parse_first(raw, FORMATS)).alias("parsed"))


@proof("fn_parse_ampm", "SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def fn_parse_ampm(t):
    return t.events.select("event_id", wall_time(dates.parse_ampm(F.date_format("ts", "M/d/yyyy h:m:s a"))).alias("parsed"))


@proof(
    "fn_date_arith",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) + 7 AS plus7, CAST(o_orderdate AS DATE) - 30 AS minus30, CAST(CAST(o_orderdate AS DATE) - INTERVAL 6 MONTH AS DATE) AS half_year,
              CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') AS INTEGER) AS age_days, o_orderdate + INTERVAL 7 HOUR AS local_ts FROM orders""",
)
def fn_date_arith(t):
    d = order_day()
    return t.orders.select(
        "o_orderkey",
        F.date_add(d, 7).alias("plus7"),
        F.date_sub(d, 30).alias("minus30"),
        F.add_months(d, -6).alias("half_year"),
        F.datediff(dates.day("2001-12-31"), d).alias("age_days"),
        (F.col("o_orderdate") + F.expr("INTERVAL 7 HOURS")).alias("local_ts"),
    )


@proof(
    "fn_date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(hour(ts) AS INTEGER) AS h, CAST(dayofweek(ts) + 1 AS INTEGER) AS dow,
              CAST(weekofyear(ts) AS INTEGER) AS iso_week, date_trunc('month', ts)::DATE AS month_start, date_trunc('week', ts)::DATE AS week_start, last_day(ts) AS month_end,
              strftime(ts, '%Y%m%d') AS ymd FROM events""",
)
def fn_date_parts(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        F.year(ts).alias("y"),
        F.month(ts).alias("m"),
        F.hour(ts).alias("h"),
        F.dayofweek(ts).alias("dow"),
        F.weekofyear(ts).alias("iso_week"),
        F.trunc(ts, "MONTH").alias("month_start"),
        F.trunc(ts, "WEEK").alias("week_start"),
        F.last_day(ts).alias("month_end"),
        F.date_format(ts, "yyyyMMdd").alias("ymd"),
    )


@proof(
    "fn_tz_shift",
    "SELECT event_id, ts + INTERVAL 7 HOUR AS local_ts, CAST(ts + INTERVAL 7 HOUR AS DATE) AS local_day FROM events",
)
def fn_tz_shift(t):
    utc = F.col("ts").cast("timestamp")
    return t.events.select("event_id", wall_time(dates.local_ts(utc)).alias("local_ts"), dates.local_day(utc).alias("local_day"))


@proof(
    "fn_epoch_ms",
    "SELECT event_id, date_trunc('millisecond', ts) AS back, CAST(ts AS DATE) AS back_day FROM events",
)
def fn_epoch_ms(t):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    days = F.unix_date(event_day())
    return t.events.select("event_id", wall_time(dates.epoch_ms(ms)).alias("back"), F.date_from_unix_date(days).alias("back_day"))


@proof(
    "fn_last_weekday",
    """WITH d AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month_start FROM orders),
            x AS (SELECT month_start, CAST(UNNEST(generate_series(month_start, last_day(month_start), INTERVAL 1 DAY)) AS DATE) AS day FROM d)
       SELECT month_start, MAX(day) AS last_wed FROM x WHERE dayofweek(day) = 3 GROUP BY 1""",
)
def fn_last_weekday(t):
    months = t.orders.select(F.trunc("o_orderdate", "MONTH").alias("month_start")).distinct()
    return months.withColumn("last_wed", dates.last_weekday_of_month(F.col("month_start")))


@proof(
    "fn_math_clamp",
    """SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_quantity, 0) AS unit_price, CAST(LEAST(10, GREATEST(CEIL(l_quantity / 3), 2)) AS BIGINT) AS clamped,
              ABS(l_discount - 0.05) AS gap, GREATEST(l_discount, l_tax) AS hi, LEAST(l_discount, l_tax) AS lo FROM lineitem""",
)
def fn_math_clamp(t):
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") / F.nullif(q, F.lit(0.0))).alias("unit_price"),
        numbers.clamp(F.ceil(q / 3), 2, 10).cast("bigint").alias("clamped"),
        F.abs(F.col("l_discount") - 0.05).alias("gap"),
        F.greatest("l_discount", "l_tax").alias("hi"),
        F.least("l_discount", "l_tax").alias("lo"),
    )


@proof(
    "fn_try_cast",
    """SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no, TRY_CAST(p_name AS INTEGER) AS not_a_number,
              p_retailprice / NULLIF(p_size - 1, 0) AS ratio FROM part""",
)
def fn_try_cast(t):
    return t.part.select(
        "p_partkey",
        F.split_part("p_brand", F.lit("#"), F.lit(2)).try_cast("int").alias("brand_no"),
        F.col("p_name").try_cast("int").alias("not_a_number"),
        numbers.safe_ratio(F.col("p_retailprice"), F.col("p_size") - 1).alias("ratio"),
    )


@proof(
    "fn_array_suite",
    """SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words, list_contains(string_split(text, ' '), 'the') AS has_the, string_split(text, ' ')[1] AS first_word,
              CAST(len(list_distinct(string_split(text, ' '))) AS INTEGER) AS n_unique, CAST(len(list_filter(string_split(text, ' '), lambda w: length(w) > 6)) AS INTEGER) AS n_long,
              md5(array_to_string(list_sort(list_distinct(list_transform(string_split(text, ' '), lambda w: left(w, 4)))), ',')) AS sorted_md5 FROM documents""",
)
def fn_array_suite(t):
    words = F.split("text", " ")
    stems = F.transform(words, lambda w: F.left(w, F.lit(4)))
    return t.documents.select(
        "doc_id",
        F.size(words).alias("n_words"),
        F.array_contains(words, "the").alias("has_the"),
        F.element_at(words, 1).alias("first_word"),
        F.size(F.array_distinct(words)).alias("n_unique"),
        F.size(F.filter(words, lambda w: F.length(w) > 6)).alias("n_long"),
        F.md5(F.array_join(F.sort_array(F.array_distinct(stems)), ",")).alias("sorted_md5"),
    )


@proof(
    "fn_clean_date_list",
    """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1999-01-01' AND DATE '2000-06-30' AND CAST(o_orderdate AS DATE) <> DATE '2000-01-01'
               THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ',2000-01-01' ELSE '2000-01-01' END AS days,
              CASE WHEN CAST(o_orderdate AS DATE) <= DATE '2000-06-30' AND CAST(o_orderdate AS DATE) <> DATE '2000-01-01'
               THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ',2000-01-01' ELSE '2000-01-01' END AS all_days
        FROM orders""",
)
def fn_clean_date_list(t):
    """With the floor at last year's start, and with an own one below all days."""
    d = order_day().cast("string")
    raw = F.concat_ws(",", F.concat(F.lit(" '"), d, F.lit("' ")), F.lit(""), F.lit("soon"), F.lit("2000-01-01"), d)
    whole = dates.clean_date_list(raw, "2000-06-30", dates.day("1900-01-01"))
    return t.orders.select("o_orderkey", dates.clean_date_list(raw, "2000-06-30").alias("days"), whole.alias("all_days"))


@proof(
    "fn_kv_lookup",
    """SELECT event_id, event_type AS kind, CAST(value AS VARCHAR) AS amount, NULL::VARCHAR AS absent FROM events""",
)
def fn_kv_lookup(t):
    def pair(k, v):
        return F.struct(F.lit(k).alias("key"), v.cast("string").alias("value"))

    fields = F.array(pair("kind", F.col("event_type")), pair("amount", F.col("value")), pair("kind", F.lit("second")))
    rows = t.events.withColumn("custom", fields)
    return rows.select(
        "event_id", *[nested.kv_lookup(F.col("custom"), k).alias(k) for k in ("kind", "amount", "absent")]
    )


UNITS_SQL = "(VALUES ('SMALL', 1, 1), ('MEDIUM', 6, 1), ('LARGE', 24, 2), ('PROMO', 5, 0)) u(p_type, numerator, denominator)"


@proof(
    "fn_unit_conversion",
    f"""SELECT p_type, ROUND(SUM(CAST(l_quantity AS DECIMAL(18,2))) * numerator / NULLIF(denominator, 0), 6) AS base_qty
        FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN {UNITS_SQL} USING (p_type) GROUP BY p_type, numerator, denominator""".replace(
        "SUM(CAST(l_quantity AS DECIMAL(18,2)))", "CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE)"
    ),
)
def fn_unit_conversion(t):
    units = values(
        t.spark, [("SMALL", 1, 1), ("MEDIUM", 6, 1), ("LARGE", 24, 2), ("PROMO", 5, 0)], "p_type string, numerator int, denominator int"
    )
    kinds = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    sold = t.lineitem.join(kinds, "l_partkey").groupBy("p_type").agg(total("l_quantity").alias("qty"))
    converted = numbers.convert_unit(F.col("qty"), F.col("numerator"), F.col("denominator"))
    return sold.join(units, "p_type", "left").select("p_type", r6(converted).alias("base_qty"))


@proof(
    "fn_json_extract",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, json_extract_string(props, '$.absent') AS absent FROM events""",
)
def fn_json_extract(t):
    parsed = F.from_json("props", "k int")
    return t.events.select(
        "event_id", parsed["k"].alias("k"), F.get_json_object("props", "$.absent").alias("absent")
    )


@proof(
    "fn_round_to_pack",
    """SELECT p_partkey, CAST(CEIL(q / NULLIF(pack, 0)) * NULLIF(pack, 0) AS BIGINT) AS packed,
              CASE WHEN COALESCE(pack, 1) <> 1 AND q / NULLIF(pack, 0) = floor(q / NULLIF(pack, 0)) THEN 'Case' ELSE 'Piece' END AS picking
       FROM (SELECT l_partkey AS p_partkey, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS q FROM lineitem GROUP BY 1)
       JOIN (SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 0 WHEN 'LARGE' THEN 12 WHEN 'PROMO' THEN 1 WHEN 'MEDIUM' THEN 7 END AS pack FROM part) USING (p_partkey)""",
)
def fn_round_to_pack(t):
    pack = text.map_codes(F.col("p_type"), {"SMALL": 0, "LARGE": 12, "PROMO": 1, "MEDIUM": 7})
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(total("l_quantity").alias("q"))
    rows = sold.join(t.part.select("p_partkey", pack.alias("pack")), "p_partkey")
    return rows.select(
        "p_partkey",
        numbers.round_to_pack(F.col("q"), F.col("pack")).cast("bigint").alias("packed"),
        numbers.picking_type(F.col("q"), F.col("pack")).alias("picking"),
    )


@proof(
    "fn_least_positive",
    """SELECT s_suppkey, (SELECT MIN(v) FROM (VALUES (s_acctbal), (s_acctbal - 5000), (8000 - s_acctbal)) x(v) WHERE v > 0) AS least FROM supplier""",
)
def fn_least_positive(t):
    b = F.col("s_acctbal")
    return t.supplier.select("s_suppkey", numbers.least_positive(b, b - 5000, 8000 - b).alias("least"))


@proof(
    "fn_normalize_name",
    "SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS clean_md5 FROM documents",
)
def fn_normalize_name(t):
    return t.documents.select("doc_id", F.md5(text.normalize_name(F.col("text"))).alias("clean_md5"))


@proof(
    "udf_sql_function",
    "SELECT o_orderkey, NULLIF(LTRIM(lpad(CAST(o_custkey AS VARCHAR), 12, '0'), '0'), '') AS customer FROM orders",
)
def udf_sql_function(t):
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION tl_strip_zeros(input STRING) RETURNS STRING
           RETURN NULLIF(LTRIM('0', input), '')"""
    )
    return t.spark.sql(
        "SELECT o_orderkey, tl_strip_zeros(lpad(CAST(o_custkey AS STRING), 12, '0')) AS customer FROM {orders}", orders=t.orders
    )


@proof(
    "dq_missing_attributes",
    """SELECT p_partkey, concat_ws(', ', CASE WHEN brand IS NULL THEN 'BRAND' END, CASE WHEN kind IS NULL THEN 'TYPE' END, CASE WHEN size IS NULL THEN 'SIZE' END) AS missing,
              concat_ws(', ', CASE WHEN p_retailprice > 950 THEN 'price over limit' END, CASE WHEN p_size > 40 THEN 'oversize' END) AS reasons
       FROM (SELECT *, NULLIF(p_brand, 'Brand#7') AS brand, NULLIF(p_type, 'PROMO') AS kind, NULLIF(p_size, 10) AS size FROM part)""",
)
def dq_missing_attributes(t):
    looked_up = {
        "BRAND": F.nullif("p_brand", F.lit("Brand#7")),
        "TYPE": F.nullif("p_type", F.lit("PROMO")),
        "SIZE": F.nullif("p_size", F.lit(10)),
    }
    reasons = {"price over limit": F.col("p_retailprice") > 950, "oversize": F.col("p_size") > 40}
    return t.part.select(
        "p_partkey", text.missing_attributes(looked_up).alias("missing"), text.join_reasons(reasons).alias("reasons")
    )
