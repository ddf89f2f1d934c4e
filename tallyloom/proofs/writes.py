"""Proofs of table writes: each writes a table in steps and reads it back."""

from datetime import date

from pyspark.sql import functions as F

from tallyloom.functions.dates import add_partition_columns, day
from tallyloom.proofs.common import AS_OF, event_day, sql_total, total
from tallyloom.proofs.registry import proof
from tallyloom.session import fresh_dir
from tallyloom.sinks import tables as W

# the batches: orders up to a split day, and a later delivery that repeats part of them with new amounts
SPLIT = "1998-06-30"


def daily(t):
    return t.events.groupBy(event_day().alias("calday"), "event_type").agg(F.count("*").alias("n"), total("value").alias("v"))


DAILY_SQL = f"SELECT CAST(ts AS DATE) AS calday, event_type, COUNT(*) AS n, {sql_total('value')} AS v FROM events GROUP BY 1, 2"


def early(t):
    return daily(t).where(F.col("calday") <= day(AS_OF))


def late(t):
    """From three days before the split on, with doubled counts."""
    return daily(t).where(F.col("calday") > F.date_sub(day(AS_OF), 3)).withColumn("n", F.col("n") * 2)


LATE_WHERE = f"calday > DATE '{AS_OF}' - 3"


@proof("wr_replace", "SELECT p_partkey, p_brand FROM part")
def wr_replace(t):
    path = fresh_dir(t.spark, "replace")
    W.replace_table(t.part.select("p_partkey", "p_brand").where("p_size > 10"), path)
    W.replace_table(t.part.select("p_partkey", "p_brand"), path)
    return W.read_table(t.spark, path)


@proof(
    "wr_replace_days",
    f"SELECT calday, event_type, CASE WHEN {LATE_WHERE} THEN n * 2 ELSE n END AS n, v FROM ({DAILY_SQL})",
)
def wr_replace_days(t):
    path = fresh_dir(t.spark, "days")
    W.replace_days(early(t), path, "calday")
    W.replace_days(late(t), path, "calday")
    W.replace_days(late(t), path, "calday")
    return W.read_table(t.spark, path).select("calday", "event_type", "n", "v")


@proof(
    "wr_replace_where",
    f"SELECT calday, event_type, CASE WHEN calday = DATE '{AS_OF}' THEN n * 2 ELSE n END AS n, v FROM ({DAILY_SQL})",
)
def wr_replace_where(t):
    path = fresh_dir(t.spark, "where")
    W.replace_days(daily(t), path, "calday")
    one = daily(t).where(F.col("calday") == day(AS_OF)).withColumn("n", F.col("n") * 2)
    W.replace_where(one, path, "calday", date.fromisoformat(AS_OF))
    return W.read_table(t.spark, path).select("calday", "event_type", "n", "v")


@proof("wr_replace_where_empty", f"SELECT calday, event_type, n, v FROM ({DAILY_SQL}) WHERE calday <> DATE '{AS_OF}'")
def wr_replace_where_empty(t):
    """An empty batch leaves its day empty and the other days alone."""
    path = fresh_dir(t.spark, "where")
    W.replace_days(daily(t), path, "calday")
    W.replace_where(daily(t).where(F.lit(False)), path, "calday", date.fromisoformat(AS_OF))
    return W.read_table(t.spark, path).select("calday", "event_type", "n", "v")


ORDERS_A = f"CAST(o_orderdate AS DATE) <= DATE '{SPLIT}'"
ORDERS_B = "CAST(o_orderdate AS DATE) > DATE '1998-03-31'"


def orders_a(t):
    return t.orders.where(F.to_date("o_orderdate") <= day(SPLIT)).select("o_orderkey", "o_orderstatus", "o_totalprice")


def orders_b(t):
    later = t.orders.where(F.to_date("o_orderdate") > day("1998-03-31"))
    return later.select("o_orderkey", F.lit("X").alias("o_orderstatus"), "o_totalprice")


UPSERT_SQL = f"SELECT o_orderkey, CASE WHEN {ORDERS_B} THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders"
INSERT_SQL = f"SELECT o_orderkey, CASE WHEN {ORDERS_A} THEN o_orderstatus ELSE 'X' END AS o_orderstatus, o_totalprice FROM orders"


@proof("wr_replace_keys", UPSERT_SQL)
def wr_replace_keys(t):
    path = fresh_dir(t.spark, "keys")
    W.replace_table(orders_a(t), path)
    W.replace_keys(orders_b(t), path, ["o_orderkey"])
    return W.read_table(t.spark, path)


@proof("wr_upsert", UPSERT_SQL)
def wr_upsert(t):
    path = fresh_dir(t.spark, "upsert")
    W.replace_table(orders_a(t), path)
    W.upsert(orders_b(t), path, ["o_orderkey"])
    return W.read_table(t.spark, path)


@proof("wr_merge_insert_only", INSERT_SQL)
def wr_merge_insert_only(t):
    path = fresh_dir(t.spark, "absent")
    W.insert_absent(orders_a(t), path, ["o_orderkey"])
    W.insert_absent(orders_b(t), path, ["o_orderkey"])
    W.insert_absent(orders_b(t), path, ["o_orderkey"])
    return W.read_table(t.spark, path)


@proof(
    "wr_merge_pruned",
    f"SELECT calday, event_type, CASE WHEN calday > DATE '{AS_OF}' THEN n * 2 ELSE n END AS n, v FROM ({DAILY_SQL})",
)
def wr_merge_pruned(t):
    path = fresh_dir(t.spark, "pruned")
    W.replace_days(early(t), path, "calday")
    W.insert_absent(late(t), path, ["calday", "event_type"], day="calday")
    return W.read_table(t.spark, path).select("calday", "event_type", "n", "v")


@proof(
    "wr_history_snapshot",
    """SELECT s_suppkey, s_acctbal, DATE '2024-01-01' AS calday FROM supplier WHERE s_acctbal > 0
       UNION ALL SELECT s_suppkey, s_acctbal, DATE '2024-01-02' FROM supplier""",
)
def wr_history_snapshot(t):
    path = fresh_dir(t.spark, "his")
    sites = t.supplier.select("s_suppkey", "s_acctbal")
    W.append_history(sites.where("s_acctbal > 0"), path, "2024-01-01")
    W.append_history(sites.where("s_acctbal < 0"), path, "2024-01-02")
    W.append_history(sites, path, "2024-01-02")
    return W.read_table(t.spark, path)


@proof("wr_append", "SELECT c_custkey, c_mktsegment FROM customer")
def wr_append(t):
    path = fresh_dir(t.spark, "append")
    rows = t.customer.select("c_custkey", "c_mktsegment")
    W.append(rows.where("c_mktsegment = 'BUILDING'"), path)
    W.append(rows.where("c_mktsegment <> 'BUILDING'"), path)
    return W.read_table(t.spark, path)


@proof(
    "wr_align_schema",
    "SELECT CAST(c_nationkey AS VARCHAR) AS nation, c_custkey AS id, CAST(c_acctbal AS DECIMAL(18,2))::DOUBLE AS balance, NULL::DATE AS closed_on FROM customer",
)
def wr_align_schema(t):
    path = fresh_dir(t.spark, "typed")
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), "c_name")
    W.append(W.align_schema(rows, "nation STRING, id BIGINT, balance DOUBLE, closed_on DATE"), path)
    return W.read_table(t.spark, path)


@proof(
    "wr_partitioned_parquet",
    f"SELECT CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d, COUNT(*) AS n, {sql_total('value')} AS v FROM events GROUP BY 1, 2, 3",
)
def wr_partitioned_parquet(t):
    path = fresh_dir(t.spark, "ymd")
    W.write_dated(add_partition_columns(t.events, "ts"), path)
    back = t.spark.read.parquet(path)
    keys = [F.col(a).cast("int").alias(b) for a, b in (("yyyy", "y"), ("mm", "m"), ("dd", "d"))]
    return back.groupBy(*keys).agg(F.count("*").alias("n"), total("value").alias("v"))


@proof("wr_single_file", "SELECT s_suppkey, s_name, 1::BIGINT AS n_files FROM supplier")
def wr_single_file(t):
    """An extract within the stated bound is one file, also when its load is repeated."""
    path = fresh_dir(t.spark, "single")
    for _ in range(2):
        W.write_extract(t.supplier.repartition(4).select("s_suppkey", "s_name"), path, load_id=1, one_file_rows=1_000_000)
    back = t.spark.read.parquet(f"{path}/load_id=1")
    return back.withColumn("n_files", F.lit(len(back.inputFiles())).cast("bigint"))


@proof(
    "wr_evolving_append",
    "SELECT s_suppkey, s_name, NULL::DOUBLE AS s_acctbal FROM supplier WHERE s_acctbal < 0 UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal >= 0",
)
def wr_evolving_append(t):
    path = fresh_dir(t.spark, "evolve")
    W.append_evolving(t.supplier.where("s_acctbal < 0").select("s_suppkey", "s_name"), path)
    W.append_evolving(t.supplier.where("s_acctbal >= 0").select("s_suppkey", "s_name", "s_acctbal"), path)
    return W.read_evolving(t.spark, path).select("s_suppkey", "s_name", "s_acctbal")


@proof("wr_append_replayed", "SELECT c_custkey, c_mktsegment FROM customer")
def wr_append_replayed(t):
    """Loads that are sent again, in and out of order, add their rows once."""
    path = fresh_dir(t.spark, "replayed")
    rows = t.customer.select("c_custkey", "c_mktsegment")
    loads = {1: rows.where("c_mktsegment = 'BUILDING'"), 2: rows.where("c_mktsegment <> 'BUILDING'")}
    for load_id in (1, 1, 2, 1, 2):
        W.append(loads[load_id], path, load=("crm", load_id))
    return W.read_table(t.spark, path)


@proof(
    "wr_dated_replayed",
    f"SELECT CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(day(ts) AS INTEGER) AS d, COUNT(*) AS n, {sql_total('value')} AS v FROM events GROUP BY 1, 2, 3",
)
def wr_dated_replayed(t):
    """Two loads of a landing folder, the first one sent twice."""
    path = fresh_dir(t.spark, "dated")
    clicks, others = t.events.where("event_type = 'click'"), t.events.where("event_type <> 'click' OR event_type IS NULL")
    for load_id, rows in ((1, clicks), (1, clicks), (2, others)):
        W.write_dated(add_partition_columns(rows, "ts"), path, load_id=load_id)
    keys = [F.col(a).cast("int").alias(b) for a, b in (("yyyy", "y"), ("mm", "m"), ("dd", "d"))]
    return t.spark.read.parquet(path).groupBy(*keys).agg(F.count("*").alias("n"), total("value").alias("v"))


@proof("wr_upsert_bucketed", UPSERT_SQL)
def wr_upsert_bucketed(t):
    """Changes to a table laid out by key: an insert that meets nothing, then an upsert and a repeat of it."""
    path = fresh_dir(t.spark, "bucketed")
    W.upsert(orders_a(t), path, ["o_orderkey"], buckets=8)
    W.upsert(orders_b(t), path, ["o_orderkey"])
    W.upsert(orders_b(t), path, ["o_orderkey"], load=("orders", 1))
    return W.read_table(t.spark, path)


@proof("wr_compacted", "SELECT c_custkey, c_mktsegment FROM customer")
def wr_compacted(t):
    """Many small appends by segment, brought together; the rows stay as they are."""
    path = fresh_dir(t.spark, "compacted")
    rows = t.customer.select("c_custkey", "c_mktsegment")
    for i in range(4):
        W.append(rows.where(F.pmod("c_custkey", F.lit(4)) == i), path, ["c_mktsegment"])
    W.compact(t.spark, path)
    return W.read_table(t.spark, path)


_LOGGED = f"""WITH a AS (SELECT COUNT(*) AS n FROM orders WHERE {ORDERS_A}), b AS (SELECT COUNT(*) AS n FROM orders WHERE {ORDERS_B}),
             ab AS (SELECT COUNT(*) AS n FROM orders WHERE {ORDERS_A} AND {ORDERS_B}), o AS (SELECT COUNT(*) AS n FROM orders)"""


@proof(
    "mon_write_log",
    f"""{_LOGGED}
        SELECT 1::BIGINT AS load_id, 'replace' AS operation, a.n AS inserted, 0::BIGINT AS updated, 0::BIGINT AS deleted FROM a
        UNION ALL SELECT 2, 'upsert', b.n - ab.n, ab.n, 0 FROM b, ab
        UNION ALL SELECT 3, 'replace_keys', b.n, 0, b.n FROM b
        UNION ALL SELECT 4, 'replace', a.n, 0, o.n FROM a, o""",
)
def mon_write_log(t):
    """Change counts of a full load, an upsert, a replacement by key and another full load; the last one is logged twice."""
    base = fresh_dir(t.spark, "logged")
    path, log = f"{base}/orders", f"{base}/write_log"
    W.log_write(t.spark, log, 1, W.replace_table(orders_a(t), path))
    W.log_write(t.spark, log, 2, W.upsert(orders_b(t), path, ["o_orderkey"]))
    W.log_write(t.spark, log, 3, W.replace_keys(orders_b(t), path, ["o_orderkey"]))
    stats = W.replace_table(orders_a(t), path)
    for _ in range(2):
        W.log_write(t.spark, log, 4, stats)
    return W.read_table(t.spark, log).select("load_id", "operation", "inserted", "updated", "deleted")


@proof(
    "mon_read_version",
    f"""SELECT 11::BIGINT AS load_id, o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE {ORDERS_A}
        UNION ALL SELECT 12, * FROM ({UPSERT_SQL})
        UNION ALL SELECT 13, o_orderkey, 'X', o_totalprice FROM orders WHERE {ORDERS_B}""",
)
def mon_read_version(t):
    """A table read as each of three loads left it, after all of them and a fourth were committed."""
    path = fresh_dir(t.spark, "versions")
    W.replace_table(orders_a(t), path, load=("orders", 11))
    W.upsert(orders_b(t), path, ["o_orderkey"], load=("orders", 12))
    W.replace_table(orders_b(t), path, load=("orders", 13))
    W.append(orders_b(t), path, load=("orders", 14))
    out = None
    for load_id in (11, 12, 13):
        one = W.read_version(t.spark, path, load_id=load_id).select(F.lit(load_id).cast("long").alias("load_id"), "*")
        out = one if out is None else out.unionAll(one)
    return out
