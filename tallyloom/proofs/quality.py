"""Proofs of data-quality operators and of incremental loads."""

from pyspark.sql import functions as F

from tallyloom.functions.dates import day
from tallyloom.plans import incremental, quality
from tallyloom.proofs.common import event_day, sql_total
from tallyloom.proofs.registry import proof
from tallyloom.session import fresh_dir
from tallyloom.sinks import tables as W
from tallyloom.sinks.tables import WriteStats
from tallyloom.streaming.contracts import Contract, Rule, array_of, object_of, optional, validated


@proof(
    "dq_column_sums",
    f"""SELECT CAST({sql_total("o_totalprice")} AS DECIMAL(28,2))::DOUBLE AS price, CAST(SUM(o_custkey) AS BIGINT) AS cust FROM orders""",
)
def dq_column_sums(t):
    rows = t.orders.select(F.col("o_totalprice").cast("decimal(18,2)").alias("price"), F.col("o_custkey").alias("cust"))
    sums = quality.column_sums(rows, "price, cust")
    return sums.select(F.from_json("sums", "price DOUBLE, cust BIGINT").alias("s")).select("s.*")


def _profile_sql(table, ints, texts, others):
    parts = []
    for c in ints + texts + others:
        number = f"MIN({c})::BIGINT, MAX({c})::BIGINT" if c in ints else "NULL::BIGINT, NULL::BIGINT"
        lengths = (
            f"MIN(length({c}))::INTEGER, MAX(length({c}))::INTEGER, SUM(length({c}))::BIGINT"
            if c in texts else "NULL::INTEGER, NULL::INTEGER, NULL::BIGINT"
        )
        parts.append(f"SELECT '{c}', COUNT(*) - COUNT({c}), COUNT(DISTINCT {c}), {number}, {lengths} FROM {table}")
    names = "column_name, null_count, distinct_count, min_value, max_value, min_length, max_length, total_length"
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) p({names})"


@proof("dq_column_profile", _profile_sql("customer", ["c_custkey", "c_nationkey"], ["c_name", "c_mktsegment"], ["c_acctbal"]))
def dq_column_profile(t):
    return quality.column_profile(t.customer)


@proof(
    "dq_profile_log",
    "SELECT 'documents' AS table_name, 'bronze' AS layer, CAST(5 AS INTEGER) AS n_columns, COUNT(*) AS inserted_records, SUM(length(text))::BIGINT AS text_length FROM documents",
)
def dq_profile_log(t):
    stats = WriteStats("documents", "append", inserted=0)
    row = quality.profile_log_row(quality.column_profile(t.documents), "documents", "bronze", day("2024-01-15"), "append", stats)
    text = F.get(F.filter("column_metrics", lambda m: m["column_name"] == "text"), F.lit(0))
    rows = t.documents.agg(F.count("*").alias("inserted_records"))
    return row.select("table_name", "layer", F.size("column_metrics").alias("n_columns"), text["total_length"].alias("text_length")).withColumn(
        "inserted_records", rows.scalar()
    )


@proof(
    "dq_source_target_reconcile",
    """WITH s AS (SELECT COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS a FROM orders),
            g AS (SELECT COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS a FROM orders WHERE o_orderstatus <> 'P')
       SELECT 'same' AS pair, s.n AS source_count, s.n AS target_count, 'Passed' AS status, 'Validation Passed - count; Validation Passed - sums; Validation Passed - columns' AS messages FROM s
       UNION ALL SELECT 'less', s.n, g.n, 'Failed', 'Validation Failed - count; Validation Failed - sums; Validation Passed - columns' FROM s, g""",
)
def dq_source_target_reconcile(t):
    source = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    less = source.where("o_orderstatus <> 'P'")
    out = [
        quality.source_target_reconcile(source, target, ["amount"]).withColumn("pair", F.lit(name))
        for name, target in (("same", source), ("less", less))
    ]
    return out[0].unionByName(out[1]).select("pair", "source_count", "target_count", "status", "messages")


HUB_CONTRACTS = {
    "view_hub": Contract({"id": Rule(("number",)), "user": Rule(("number",)), "at": Rule(("datetime",)), "k": optional("number")}, ("id", "user"), closed=True),
    "click_hub": Contract({"id": Rule(("number",)), "amount": Rule(("number",)), "user": Rule(("number",))}, ("id", "amount")),
    "purchase_hub": Contract({"id": Rule(("number",)), "lines": array_of(Contract({"sku": Rule(("string",)), "qty": optional("number")}, ("sku",), closed=True))}, ("id", "lines")),
    "signup_hub": Contract({"id": Rule(("string",))}, ("id",)),
}


def hub_messages(t):
    """Events as messages; values above 100 break their hub's contract in one way per hub."""
    high = F.col("value") > 100
    common = [F.col("event_id").alias("id"), F.col("user_id").alias("user")]
    body = (
        F.when(F.col("event_type") == "view", F.to_json(F.struct(*common, F.when(high, "soon").otherwise(F.date_format("ts", "yyyyMMddHHmmss")).alias("at"), F.when(high, 1).alias("note"))))
        .when(F.col("event_type") == "click", F.to_json(F.struct(*common, F.when(~high, F.col("value")).alias("amount"))))
        .when(
            F.col("event_type") == "purchase",
            F.to_json(F.struct(F.col("event_id").alias("id"), F.array(F.struct(F.lit("a").alias("sku"), F.lit(1).alias("qty")), F.struct(F.when(~high, "b").alias("sku"), F.lit(2).alias("qty"))).alias("lines"))),
        )
        .when((F.col("event_type") == "signup") & high, F.lit('{"id": '))
        .otherwise(F.to_json(F.struct(*common)))
    )
    return t.events.select(F.concat("event_type", F.lit("_hub")).alias("hub"), body.alias("json_str"), "event_id", "ts")


HUB_ERROR_SQL = """CASE WHEN event_type = 'view' AND value > 100 THEN '''at'' is not of type ''datetime'' | Additional properties are not allowed: note'
     WHEN event_type = 'click' AND value > 100 THEN '''amount'' is a required property'
     WHEN event_type = 'purchase' AND value > 100 THEN '''sku'' is a required property in lines[]'
     WHEN event_type = 'signup' AND value > 100 THEN 'malformed JSON' WHEN event_type = 'signup' THEN '''id'' is not of type ''string'''
     WHEN event_type = 'error' THEN 'unknown hub: error_hub' END"""


@proof(
    "dq_json_contract",
    f"SELECT event_id, {HUB_ERROR_SQL} IS NULL AS is_valid, {HUB_ERROR_SQL} AS error FROM events",
)
def dq_json_contract(t):
    return validated(hub_messages(t), HUB_CONTRACTS).select("event_id", "is_valid", "error")


NESTED_CONTRACT = Contract(
    {
        "id": Rule(("number",)),
        "site": object_of(Contract({"geo": object_of(Contract({"codes": array_of(Rule(("number", "null"))), "a.b": Rule(("string",))}, ("codes", "a.b"), closed=True))}, ("geo",))),
    },
    ("id", "site"),
)


@proof(
    "dq_json_contract_nested",
    """SELECT event_id, error IS NULL AS is_valid, error FROM (SELECT event_id, CASE event_type
           WHEN 'click' THEN '''geo'' is a required property in site'
           WHEN 'purchase' THEN '''a.b'' is a required property in site.geo | element is not of type ''number'', ''null'' in site.geo.codes[]'
           WHEN 'signup' THEN '''site'' is not of type ''object'''
           WHEN 'error' THEN '''a.b'' is not of type ''string'' in site.geo | Additional properties are not allowed: more in site.geo' END AS error FROM events)""",
)
def dq_json_contract_nested(t):
    """Four levels: an object in an object, an array of scalars in it, a key that holds a dot."""
    value, kind = F.col("value"), F.col("event_type")
    geo = (
        F.when(kind == "purchase", F.to_json(F.struct(F.array(F.lit("x"), F.lit("y")).alias("codes"))))
        .when(kind == "error", F.to_json(F.struct(F.array(value).alias("codes"), F.lit(5).alias("a.b"), F.lit(1).alias("more"))))
        .otherwise(F.concat(F.lit('{"codes":[null,'), value.cast("string"), F.lit('],"a.b":"ok"}')))
    )
    site = F.when(kind == "click", F.lit('{"x":1}')).when(kind == "signup", F.lit("[1]")).otherwise(F.concat(F.lit('{"geo":'), geo, F.lit("}")))
    body = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"site":'), site, F.lit("}"))
    messages = t.events.select("event_id", F.lit("hub").alias("hub"), body.alias("json_str"))
    return validated(messages, {"hub": NESTED_CONTRACT}).select("event_id", "is_valid", "error")


@proof("dq_reconcile_doubles", "SELECT COUNT(*) AS source_count, COUNT(*) AS target_count, 'Passed' AS status FROM events")
def dq_reconcile_doubles(t):
    """The same fractional values in two orders have the same control total."""
    source, target = t.events.orderBy("value").select("value"), t.events.orderBy(F.desc("event_id")).select("value")
    return quality.source_target_reconcile(source, target, ["value"]).select("source_count", "target_count", "status")


HUBS_SQL = "(SELECT DISTINCT event_type || '_hub' AS hub FROM events)"


@proof(
    "dq_invalid_summary",
    f"""WITH e AS (SELECT event_type || '_hub' AS hub, {HUB_ERROR_SQL} AS error FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'),
             b AS (SELECT hub, COUNT(*) AS n, string_agg(DISTINCT error, ', ' ORDER BY error) AS errs FROM e WHERE error IS NOT NULL GROUP BY 1)
        SELECT h.hub, CAST(COALESCE(n, 0) AS INTEGER) AS invalid_record_count, CASE WHEN COALESCE(n, 0) > 0 THEN 'Mismatched' ELSE 'Matched' END AS schema_match_status,
               errs AS schema_mismatches FROM {HUBS_SQL} h LEFT JOIN b USING (hub)""",
)
def dq_invalid_summary(t):
    checked = validated(hub_messages(t), HUB_CONTRACTS)
    invalid = checked.where("NOT is_valid").select("hub", F.to_date("ts").alias("ingest_day"), "error")
    hubs = t.events.select(F.concat("event_type", F.lit("_hub")).alias("hub")).distinct()
    return quality.invalid_summary(invalid, hubs, day("2024-01-15"))


@proof(
    "dq_audit_reconcile",
    f"""WITH h AS {HUBS_SQL}, e AS (SELECT event_type || '_hub' AS hub, {HUB_ERROR_SQL} AS error FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'),
             s AS (SELECT hub, COUNT(*) AS n FROM e WHERE hub <> 'error_hub' GROUP BY 1), l AS (SELECT hub, COUNT(*) AS n FROM e WHERE error IS NULL GROUP BY 1),
             i AS (SELECT hub, COUNT(*) AS n FROM e WHERE error IS NOT NULL GROUP BY 1)
        SELECT hub, '20240115' AS proc_date, COALESCE(s.n, 0) AS streaming_count, l.n AS landed_count, CAST(COALESCE(i.n, 0) AS INTEGER) AS invalid_record_count,
               CASE WHEN COALESCE(i.n, 0) > 0 THEN 'Mismatched' ELSE 'Matched' END AS schema_match_status
        FROM h LEFT JOIN s USING (hub) LEFT JOIN l USING (hub) LEFT JOIN i USING (hub)""",
)
def dq_audit_reconcile(t):
    on = F.lit("20240115")
    checked = validated(hub_messages(t), HUB_CONTRACTS)
    rows = checked.select("hub", "is_valid", "error", F.to_date("ts").alias("d"), F.date_format("ts", "yyyyMMddHHmmss").alias("proc_stamp"))
    rows = rows.withColumn("load_day", F.substring("proc_stamp", 1, 8))
    hubs = rows.select("hub").distinct()
    # the audit log has a row per hub, day and batch; the error hub was never streamed
    log = rows.where("hub <> 'error_hub'").groupBy("hub", F.substring("proc_stamp", 1, 8).alias("proc_date"), F.hour(F.to_timestamp("proc_stamp", "yyyyMMddHHmmss")).alias("batch_id")).agg(F.count("*").alias("row_count"))
    streamed = quality.streamed_summary(log, hubs, on)
    path = fresh_dir(t.spark, "landed")
    W.append(rows.where("is_valid").select("hub", "proc_stamp", "load_day"), path, ["load_day"])
    landed = quality.landed_summary(W.read_table(t.spark, path), on)
    invalid = quality.invalid_summary(rows.where("NOT is_valid").withColumnRenamed("d", "ingest_day"), hubs, day("2024-01-15"))
    return quality.audit_reconcile(streamed, landed, invalid).drop("schema_mismatches")


@proof(
    "x_changed_days",
    """WITH log AS (SELECT 'gold' AS ds, event_type AS tb, CAST(ts AS DATE) AS proc_date, CAST(MIN(ts) AS DATE) - 1 AS s, CAST(MAX(ts) AS DATE) AS e FROM events GROUP BY 1, 2, 3),
            seen AS (SELECT ds || '.' || tb AS dep, MAX(proc_date) AS last FROM log WHERE proc_date <= DATE '2024-01-10' AND tb IN ('view', 'click') GROUP BY 1),
            hit AS (SELECT log.*, dep FROM log JOIN seen ON ds || '.' || tb = dep WHERE proc_date > last AND proc_date <= DATE '2024-01-15')
       SELECT MIN(s) AS start_date, MAX(e) AS end_date, GREATEST(MIN(s), DATE '2023-01-01') AS start_date_d, COUNT(DISTINCT dep) AS table_count,
              string_agg(DISTINCT dep, ',' ORDER BY dep) AS table_etl, (SELECT CAST(COUNT(*) AS INTEGER) FROM (SELECT DISTINCT UNNEST([s, e]) AS d FROM hit)) AS n_days FROM hit""",
)
def x_changed_days(t):
    log, pending = _pending(t)
    out = incremental.changed_days(log, pending, "2024-01-15")
    return out.withColumn("n_days", F.size(F.split("calday_list", ","))).drop("calday_list")


def _pending(t):
    """A change log row per event type and day; the mart has consumed two types up to January 10."""
    log = t.events.groupBy(F.col("event_type").alias("table_affect"), event_day().alias("proc_date")).agg(
        F.date_sub(F.to_date(F.min("ts")), 1).alias("start_date"), F.to_date(F.max("ts")).alias("end_date")
    )
    listed = F.concat_ws(", ", F.col("start_date").cast("string"), F.col("end_date").cast("string"))
    log = log.withColumns({"dataset_affect": F.lit("gold"), "calday_list": listed})
    early = log.where((F.col("proc_date") <= day("2024-01-10")) & F.col("table_affect").isin("view", "click"))
    consumed = early.groupBy(F.concat_ws(".", "dataset_affect", "table_affect").alias("dependency_table")).agg(
        F.max("proc_date").alias("etl_to")
    )
    consumed = consumed.withColumns({"dataset_affect": F.lit("mart"), "table_affect": F.lit("daily")})
    return log, incremental.dependencies(log, consumed, "mart", "daily", "2024-01-15")


@proof(
    "x_incremental_load",
    """WITH hit AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE event_type IN ('view', 'click') AND CAST(ts AS DATE) BETWEEN DATE '2024-01-11' AND DATE '2024-01-15')
       SELECT event_id FROM events WHERE CAST(ts AS DATE) IN (SELECT d FROM hit UNION SELECT d - 1 FROM hit)""",
)
def x_incremental_load(t):
    log, pending = _pending(t)
    changes = incremental.changed_days(log, pending, "2024-01-15")
    rows = t.events.select("event_id", event_day().alias("calday"))
    return incremental.only_changed(rows, "calday", changes).select("event_id")
