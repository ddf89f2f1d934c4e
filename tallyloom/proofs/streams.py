"""Proofs of stream ingest: events are written as message or JSON files, streamed with
``availableNow`` and read back. Each oracle is the same relation computed from the table."""

from pyspark.sql import functions as F

from tallyloom.proofs.common import sql_total, total
from tallyloom.proofs.quality import HUB_CONTRACTS, HUB_ERROR_SQL, hub_messages
from tallyloom.proofs.registry import proof
from tallyloom.session import fresh_dir
from tallyloom.streaming import ingest
from tallyloom.streaming.contracts import validated
from tallyloom.sinks.tables import append, compact, read_table


def message_dir(t, base):
    """Messages as ``(topic, value)`` Parquet files, as many as Spark writes."""
    path = f"{base}/messages"
    rows = hub_messages(t).select(F.col("hub").alias("topic"), F.encode("json_str", "UTF-8").alias("value"))
    rows.repartition(4).write.parquet(path)
    return path


def event_json_dir(t, base):
    """Events as JSON files. Load stamps come in two spellings, and are missing for one event type."""
    path = f"{base}/json"
    kind = F.col("event_type")
    stamp = (
        F.when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "error", F.lit(None))
        .otherwise(F.date_format("ts", "yyyyMMddHHmmss"))
    )
    t.events.select("event_id", "user_id", "event_type", "value", stamp.alias("ProcDate")).repartition(4).write.json(path)
    return path


NOW = "20240201000000"
EVENT_SCHEMA = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, ProcDate STRING"
STAMP_SQL = f"CASE WHEN event_type = 'error' THEN '{NOW}' ELSE strftime(ts, '%Y%m%d%H%M%S') END"


def now():
    return F.to_timestamp(F.lit(NOW), "yyyyMMddHHmmss")


def landed(t, base, runs=1):
    """Land the JSON events, the given number of times over one checkpoint."""
    stream = ingest.with_stamp(ingest.json_files(t.spark, event_json_dir(t, base), EVENT_SCHEMA), "ProcDate", now())
    sink = ingest.landing_sink("events_hub", f"{base}/landed", f"{base}/audit", "ProcDate", now())
    for _ in range(runs):
        ingest.run_batches(stream, sink, f"{base}/checkpoint").awaitTermination()


@proof(
    "str_source_file",
    "SELECT event_type || '_hub' AS topic, COUNT(*) AS n FROM events GROUP BY 1",
)
def str_source_file(t):
    base = fresh_dir(t.spark, "source")
    stream = ingest.message_files(t.spark, message_dir(t, base), max_files=2)

    def each(batch, batch_id):
        append(batch, f"{base}/out", load=("stream", batch_id))

    ingest.run_batches(stream, each, f"{base}/checkpoint").awaitTermination()
    return read_table(t.spark, f"{base}/out").groupBy("topic").agg(F.count("*").alias("n"))


@proof(
    "str_decode",
    """SELECT event_type || '_hub' AS hub, COUNT(*) AS n, CAST(SUM(event_id) AS BIGINT) AS id_sum FROM events
       WHERE NOT (event_type = 'signup' AND value > 100) GROUP BY 1""",
)
def str_decode(t):
    messages = hub_messages(t).select(F.col("hub").alias("topic"), F.encode("json_str", "UTF-8").alias("value"))
    decoded = ingest.decode(messages).withColumn("id", F.get_json_object("json_str", "$.id").try_cast("bigint"))
    return decoded.where("id IS NOT NULL").groupBy("hub").agg(F.count("*").alias("n"), F.sum("id").alias("id_sum"))


@proof(
    "str_valid_invalid_split",
    f"""SELECT event_type || '_hub' AS hub, {HUB_ERROR_SQL} IS NULL AS is_valid, COALESCE({HUB_ERROR_SQL}, 'none') AS error, COUNT(*) AS n
        FROM events GROUP BY 1, 2, 3""",
)
def str_valid_invalid_split(t):
    base = fresh_dir(t.spark, "split")
    stream = validated(ingest.decode(ingest.message_files(t.spark, message_dir(t, base))), HUB_CONTRACTS)
    sink = ingest.split_sink(f"{base}/messages_checked", "checker", now())
    ingest.run_batches(stream, sink, f"{base}/checkpoint").awaitTermination()
    good, bad = (ingest.read_side(t.spark, f"{base}/messages_checked", side) for side in (True, False))
    good = good.select("hub", F.lit(True).alias("is_valid"), F.lit("none").alias("error"))
    bad = bad.select("hub", F.lit(False).alias("is_valid"), "error")
    return good.unionByName(bad).groupBy("hub", "is_valid", "error").agg(F.count("*").alias("n"))


@proof(
    "str_available_now",
    f"SELECT event_type, COUNT(*) AS n, {sql_total('value')} AS amount FROM events GROUP BY 1",
)
def str_available_now(t):
    base = fresh_dir(t.spark, "now")
    landed(t, base)
    rows = read_table(t.spark, f"{base}/landed")
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), total("value").alias("amount"))


@proof(
    "str_foreach_batch_audit",
    f"SELECT 'events_hub' AS hub, left({STAMP_SQL}, 8) AS proc_date, COUNT(*) AS row_count FROM events GROUP BY 1, 2",
)
def str_foreach_batch_audit(t):
    base = fresh_dir(t.spark, "audit")
    landed(t, base)
    audit = read_table(t.spark, f"{base}/audit")
    return audit.groupBy("hub", "proc_date").agg(F.sum("row_count").alias("row_count"))


@proof("str_stamp_normalize", f"SELECT event_id, {STAMP_SQL} AS stamp FROM events")
def str_stamp_normalize(t):
    base = fresh_dir(t.spark, "stamp")
    landed(t, base)
    return read_table(t.spark, f"{base}/landed").select("event_id", F.col("ProcDate").alias("stamp"))


@proof("str_file_lineage", "SELECT event_id, TRUE AS has_path, TRUE AS has_time FROM events")
def str_file_lineage(t):
    base = fresh_dir(t.spark, "lineage")
    landed(t, base)
    parts = F.split("source_metadata", r"\|")
    return read_table(t.spark, f"{base}/landed").select(
        "event_id",
        parts[0].contains("/json/").alias("has_path"),
        F.to_timestamp(parts[1]).isNotNull().alias("has_time"),
    )


@proof("str_restart_exactly_once", "SELECT COUNT(*) AS n, COUNT(DISTINCT event_id) AS n_ids, COUNT(*) AS audited FROM events")
def str_restart_exactly_once(t):
    base = fresh_dir(t.spark, "restart")
    landed_rows = f"{base}/landed"
    path = event_json_dir(t, base)
    stream = ingest.with_stamp(ingest.json_files(t.spark, path, EVENT_SCHEMA), "ProcDate", now())
    sink = ingest.landing_sink("events_hub", landed_rows, f"{base}/audit", "ProcDate", now())

    def replayed(batch, batch_id):
        # the same batch twice, as after a failure between the write and the commit
        sink(batch, batch_id)
        sink(batch, batch_id)

    for _ in range(2):  # the second run finds nothing new in its checkpoint
        ingest.run_batches(stream, replayed, f"{base}/checkpoint").awaitTermination()
    audited = read_table(t.spark, f"{base}/audit").agg(F.sum("row_count")).scalar()
    rows = read_table(t.spark, landed_rows)
    return rows.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids")).withColumn("audited", audited)


@proof(
    "str_json_infer",
    f"SELECT event_type, COUNT(*) AS n, {sql_total('value')} AS amount, CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS n_extra FROM events GROUP BY 1",
)
def str_json_infer(t):
    base = fresh_dir(t.spark, "infer")
    first = t.events.where("event_type <> 'click'").select("event_id", "event_type", "value")
    second = t.events.where("event_type = 'click'").select("event_id", "event_type", "value", F.struct("user_id").alias("who"))
    first.write.json(f"{base}/json/day=1")
    ingest.inferred_schema(t.spark, f"{base}/json", f"{base}/schema")
    second.write.json(f"{base}/json/day=2")
    schema = ingest.inferred_schema(t.spark, f"{base}/json/day=2", f"{base}/schema")
    stream = ingest.json_files(t.spark, f"{base}/json/*", schema)

    def each(batch, batch_id):
        append(batch, f"{base}/out", load=("stream", batch_id))

    ingest.run_batches(stream, each, f"{base}/checkpoint").awaitTermination()
    rows = read_table(t.spark, f"{base}/out")
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"), total("value").alias("amount"), F.count("who.user_id").alias("n_extra")
    )


@proof("str_timed_trigger", f"SELECT event_type, COUNT(*) AS n, {sql_total('value')} AS amount, 4::BIGINT AS triggers FROM events GROUP BY 1")
def str_timed_trigger(t):
    """Four files, one a trigger, on a timed trigger that ends after four of them with rows; then the small files are brought together."""
    base = fresh_dir(t.spark, "timed")
    path = event_json_dir(t, base)
    stream = t.spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).json(path)
    taken = ingest.run_timed(stream, lambda batch, i: append(batch, f"{base}/out", load=("timed", i)), f"{base}/checkpoint", "200 milliseconds", 4)
    compact(t.spark, f"{base}/out")
    rows = read_table(t.spark, f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"), total("value").alias("amount"))
    return rows.withColumn("triggers", F.lit(len(taken)).cast("long"))
