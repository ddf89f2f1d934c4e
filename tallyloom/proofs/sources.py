"""Proofs of scans. Files are written from the test tables into a fresh directory and read back."""

from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from tallyloom.functions.dates import add_partition_columns
from tallyloom.proofs.common import AS_OF, event_day, order_day, wall_time
from tallyloom.proofs.registry import proof
from tallyloom.session import fresh_dir
from tallyloom.sinks import tables as W
from tallyloom.sources import constants, files

EVENT_COLS = "event_id, user_id, event_type, value"


@proof(
    "src_parquet_partition",
    f"SELECT {EVENT_COLS} FROM events WHERE CAST(ts AS DATE) = DATE '{AS_OF}'",
)
def src_parquet_partition(t):
    base = fresh_dir(t.spark, "dated")
    W.write_dated(add_partition_columns(t.events, "ts"), base)
    return files.read_parquet_partition(t.spark, base, AS_OF).select(*EVENT_COLS.split(", "))


@proof("src_parquet_safe", "SELECT s_suppkey, s_name, 1::INTEGER AS found FROM supplier")
def src_parquet_safe(t):
    path = fresh_dir(t.spark, "safe")
    ddl = "s_suppkey BIGINT, s_name STRING"
    t.supplier.select("s_suppkey", "s_name").write.parquet(path)
    there, listed = files.read_parquet_safe(t.spark, path, ddl)
    absent, none = files.read_parquet_safe(t.spark, path + "-absent", ddl)
    return there.withColumn("found", F.lit(int(bool(listed)))).unionByName(absent.withColumn("found", F.lit(len(none))))


@proof(
    "src_csv_roundtrip",
    "SELECT c_custkey, c_name, c_acctbal, NULLIF(c_mktsegment, 'BUILDING') AS segment FROM customer",
)
def src_csv_roundtrip(t):
    path = fresh_dir(t.spark, "csv")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    rows.write.option("header", True).option("sep", ";").csv(path)
    return files.read_csv(t.spark, path, "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, segment STRING", sep=";")


def _now():
    return datetime.now(UTC).replace(microsecond=0, tzinfo=None)


@proof(
    "src_csv_modified_window",
    "SELECT COUNT(*) AS row_count, 2::INTEGER AS column_count, 'all' AS file_window FROM supplier UNION ALL SELECT 0, 2, 'later'",
)
def src_csv_modified_window(t):
    path = fresh_dir(t.spark, "csvs")
    t.supplier.select("s_suppkey", "s_name").write.option("header", True).csv(f"{path}/a/b")
    ddl, now = "s_suppkey BIGINT, s_name STRING", _now()
    day = timedelta(days=1)
    seen = files.read_csv_incremental(t.spark, path, ddl, now - day, now + day)
    later = files.read_csv_incremental(t.spark, path, ddl, now + day, now + 2 * day)
    return (
        files.frame_stats(seen).withColumn("file_window", F.lit("all"))
        .unionByName(files.frame_stats(later).withColumn("file_window", F.lit("later")))
    )


@proof("src_parquet_modified_after", "SELECT p_partkey, p_brand FROM part")
def src_parquet_modified_after(t):
    path = fresh_dir(t.spark, "recent")
    t.part.select("p_partkey", "p_brand").write.parquet(f"{path}/load1")
    return files.read_parquet_incremental(t.spark, path, _now() - timedelta(days=1))


@proof(
    "src_new_files",
    "SELECT c_mktsegment AS folder, 1::BIGINT AS n_files, 0::BIGINT AS n_later FROM customer GROUP BY 1",
)
def src_new_files(t):
    path = fresh_dir(t.spark, "arrivals")
    rows = t.customer.select("c_custkey", "c_mktsegment")
    rows.repartition("c_mktsegment").write.partitionBy("c_mktsegment").csv(path)
    now = _now()
    seen = files.new_files(t.spark, path, now - timedelta(days=1), now + timedelta(days=1))
    later = files.new_files(t.spark, path, now + timedelta(days=2), now + timedelta(days=3))
    tagged = seen.withColumn("late", F.lit(0)).unionByName(later.withColumn("late", F.lit(1)))
    folder = F.regexp_extract("path", "c_mktsegment=([A-Z]+)", 1)
    return tagged.groupBy(folder.alias("folder")).agg(
        F.count_if(F.col("late") == 0).alias("n_files"), F.count_if(F.col("late") == 1).alias("n_later")
    )


@proof(
    "src_json_multiline",
    "SELECT s_suppkey AS id, s_name AS name, n_name AS nation FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def src_json_multiline(t):
    path = fresh_dir(t.spark, "docs")
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    record = F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.struct(F.col("n_name").alias("name")).alias("nation"))
    # a document of at most a hundred records per file, printed over many lines
    documents = rows.groupBy(F.floor(F.col("s_suppkey") / 100).alias("doc")).agg(F.collect_list(record).alias("records"))
    documents.select("doc", F.to_json("records", {"pretty": "true"})).write.partitionBy("doc").text(path)
    read = files.read_json_multiline(t.spark, path, "id BIGINT, name STRING, nation STRUCT<name: STRING>")
    return read.select("id", "name", F.col("nation.name").alias("nation"))


@proof("src_xml_rowtag", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def src_xml_rowtag(t):
    path = fresh_dir(t.spark, "xml")
    t.supplier.select("s_suppkey", "s_name", "s_acctbal").write.format("xml").option("rowTag", "vendor").option("rootTag", "vendors").save(path)
    return files.read_any(t.spark, path, "xml", "s_suppkey BIGINT, s_name STRING, s_acctbal DOUBLE", row_tag="vendor")


@proof("src_todf_rename", "SELECT s_suppkey AS vendor, s_name AS vendor_name, s_nationkey AS area FROM supplier")
def src_todf_rename(t):
    path = fresh_dir(t.spark, "bare")
    t.supplier.select("s_suppkey", "s_name", "s_nationkey").write.csv(path)
    bare = files.read_csv(t.spark, path, "_c0 BIGINT, _c1 STRING, _c2 INT", header=False)
    return files.rename_by_position(bare, ["vendor", "vendor_name", "area"])


@proof(
    "src_latest_snapshot",
    "SELECT event_id, CAST(ts AS DATE) AS load_day FROM events WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)",
)
def src_latest_snapshot(t):
    return files.newest_snapshot(t.events.select("event_id", event_day().alias("load_day")), "load_day")


@proof(
    "src_values",
    """SELECT p_partkey, target FROM part JOIN (VALUES ('PROMO', 13.2), ('LARGE', 49.6), ('SMALL', 96.3)) v(p_type, target) USING (p_type)""".replace(
        "target FROM", "CAST(target AS DOUBLE) AS target FROM"
    ),
)
def src_values(t):
    targets = constants.values(t.spark, [("PROMO", 13.2), ("LARGE", 49.6), ("SMALL", 96.3)], "p_type string, target double")
    return t.part.join(targets, "p_type").select("p_partkey", "target")


@proof(
    "src_date_spine",
    """WITH s AS (SELECT CAST(UNNEST(generate_series(MIN(CAST(o_orderdate AS DATE)), MAX(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS calday FROM orders)
       SELECT calday, COUNT(o_orderkey) AS n_orders FROM s LEFT JOIN orders ON CAST(o_orderdate AS DATE) = calday GROUP BY 1""",
)
def src_date_spine(t):
    days = t.orders.groupBy(order_day().alias("calday")).agg(F.count("*").alias("n_orders"))
    ends = t.orders.agg(F.min(order_day()).alias("a"), F.max(order_day()).alias("b"))
    spine = ends.select(F.explode(F.sequence("a", "b")).alias("calday"))
    return spine.join(days, "calday", "left").na.fill(0)


@proof("fn_ts_from_filename", "SELECT 'price_0001_20240115093000' AS stem, TIMESTAMP '2024-01-15 09:30:00' AS file_ts, COUNT(*) AS n FROM supplier")
def fn_ts_from_filename(t):
    path = fresh_dir(t.spark, "named")
    named = f"{path}/price_0001_20240115093000.xml"
    t.supplier.select("s_suppkey").write.csv(named)
    # the stamp is taken from the directory level that carries the name
    rows = t.spark.read.schema("s_suppkey BIGINT").csv(named)
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    stamped = rows.withColumn("name", name).withColumn("file_ts", wall_time(files.stamp_from_filename(F.col("name"))))
    return stamped.groupBy(F.regexp_replace("name", r"\.xml$", "").alias("stem"), "file_ts").agg(F.count("*").alias("n"))
