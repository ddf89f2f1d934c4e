"""Stream ingest: message sources, validation split, landing with an idempotent audit.

Every sink is a ``foreachBatch`` that appends its batch to a versioned table in one write, with (writer, batch id) as the load. A batch
that is replayed after a lost executor or driver finds its load committed and adds nothing, so rows and counts are never doubled.
Small files of many batches are brought together by ``sinks.tables.compact``.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tallyloom.functions.dates import normalize_stamp
from tallyloom.sinks.tables import append_evolving, read_table, replace_table
from tallyloom.sinks.versions import VersionedTable

MESSAGE_SCHEMA = "topic STRING, value BINARY"


def kafka_source(spark: SparkSession, servers: str, topics: list[str], **options: str) -> DataFrame:
    """Messages of Kafka topics; the connector must be on the class path."""
    defaults = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.request.timeout.ms": "60000",
        "kafka.session.timeout.ms": "30000",
    }
    return spark.readStream.format("kafka").options(**(defaults | options)).load()


def message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages from Parquet files of the same ``(topic, value)`` shape as a Kafka source."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def decode(messages: DataFrame) -> DataFrame:
    """``hub`` and ``json_str`` of each message."""
    return messages.select(F.col("topic").alias("hub"), F.decode("value", "UTF-8").alias("json_str"))


# --- schema store ---------------------------------------------------------------------------


def widen(old: T.StructType, new: T.StructType) -> T.StructType:
    """Union of fields; a field whose types differ becomes text, structs are widened inside."""
    fields = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        have = fields.get(f.name)
        if have is None or isinstance(have, T.NullType):
            fields[f.name] = f.dataType
        elif isinstance(have, T.StructType) and isinstance(f.dataType, T.StructType):
            fields[f.name] = widen(have, f.dataType)
        elif have != f.dataType:
            numeric = {T.LongType(), T.DoubleType()}
            fields[f.name] = T.DoubleType() if {have, f.dataType} == numeric else T.StringType()
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


STORE_SCHEMA = "schema STRING, seen_until TIMESTAMP, seen_then ARRAY<STRING>"


def inferred_schema(spark: SparkSession, path: str, store: str | None = None) -> T.StructType:
    """Schema of a JSON directory, widened by the stored one and stored again.

    The store remembers up to which modification time files were read, and the names of those of that very time; a later call infers from
    newer files only. Listing reads no contents. Without a store the whole directory is read.
    """
    if store is None:
        return spark.read.json(path).schema
    kept = read_table(spark, store)
    last = kept.head() if kept is not None else None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "modificationTime")
    if last is not None:
        stored = kept.select("seen_until", "seen_then")
        at, until = F.col("modificationTime"), F.col("seen_until")
        files = files.join(F.broadcast(stored), (at > until) | ((at == until) & ~F.array_contains("seen_then", F.col("path"))), "left_semi")
    fresh = files.collect()  # names of files that came since the last call, which the scan below lists again
    found = T.StructType.fromJson(json.loads(last.schema)) if last is not None else T.StructType()
    if not fresh:
        return found
    found = widen(found, spark.read.json([r.path for r in fresh]).schema)
    until = max(r.modificationTime for r in fresh)
    then = [r.path for r in fresh if r.modificationTime == until]
    if last is not None and last.seen_until == until:
        then += last.seen_then
    replace_table(spark.createDataFrame([(found.json(), until, sorted(then))], STORE_SCHEMA), store)
    return found


def json_files(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Stream of a JSON directory under a stored schema, with the lineage of each row."""
    rows = spark.readStream.schema(schema).json(path)
    file, modified = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    return rows.withColumn("source_metadata", F.concat_ws("|", file, modified.cast("string")))


def with_stamp(rows: DataFrame, column: str, now: Column) -> DataFrame:
    """Normalised 14-digit load stamp; a source without the column gets ``now``."""
    have = F.col(column) if column in rows.columns else F.lit(None).cast("string")
    return rows.withColumn(column, normalize_stamp(have, now))


# --- sinks ----------------------------------------------------------------------------------


def run_batches(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Start a query; without a period it takes what is there and stops."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode("append")
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


class TriggerLog(StreamingQueryListener):
    """Progress of one query's triggers that took rows: batch id and number of rows; ``done`` is set after a number of them."""

    def __init__(self, triggers: int):
        self.triggers, self.seen, self.query, self.done = triggers, {}, None, threading.Event()

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if str(progress.id) == self.query and progress.numInputRows:
            self.seen[progress.batchId] = progress.numInputRows
        if len(self.seen) >= self.triggers:
            self.done.set()

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query:
            self.done.set()


def run_timed(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, every: str, triggers: int, at_most: float = 600.0
) -> dict[int, int]:
    """Run on a timed trigger until ``triggers`` batches with rows are through, or ``at_most`` seconds; rows by batch id.

    For a query that lives on, use ``run_batches`` with a period: this one gives a scheduled job an end. What the checkpoint holds
    after it is continued by the next run.
    """
    spark, log = stream.sparkSession, TriggerLog(triggers)
    spark.streams.addListener(log)
    try:
        query = run_batches(stream, each, checkpoint, every=every)
        log.query = str(query.id)
        for progress in query.recentProgress:  # what came before the listener knew the query
            if progress.numInputRows:
                log.seen[progress.batchId] = progress.numInputRows
        log.done.wait(at_most)
        query.stop()
        if query.exception() is not None:
            raise query.exception()
        return dict(sorted(log.seen.items()))
    finally:
        spark.streams.removeListener(log)


def split_sink(path: str, writer: str, ingest_time: Column) -> Callable[[DataFrame, int], None]:
    """Valid messages and invalid ones with their error, by one write of the batch: validity and hub are the table's partitions."""

    def each(batch: DataFrame, batch_id: int) -> None:
        bad = ~F.col("is_valid")
        rows = batch.select(
            "hub",
            "is_valid",
            "json_str",
            F.when(bad, F.col("error")).alias("error"),
            F.when(bad, ingest_time).alias("ingestion_time"),
            F.lit(batch_id).cast("long").alias("batch_id"),
        )
        append_evolving(rows, path, ["is_valid", "hub"], load=(writer, batch_id))

    return each


def read_side(spark: SparkSession, path: str, valid: bool) -> DataFrame:
    """One side of what ``split_sink`` wrote; the other side's partitions are not listed by the scan."""
    rows = read_table(spark, path).where(F.col("is_valid") == F.lit(valid))
    return rows.select("hub", "json_str", "batch_id") if valid else rows.select("hub", "json_str", "error", "ingestion_time", "batch_id")


#: Partition column of landed tables: the day of the load stamp.
LOAD_DAY = "load_day"


def landing_sink(hub: str, table: str, audit: str, stamp: str, batch_time: Column) -> Callable[[DataFrame, int], None]:
    """Land a batch partitioned by load day and record its row counts by day, both as the load (hub, batch id).

    The counts are those of the files that the batch's commit names, so the batch is run once. Where only the audit is missing after a failure, the
    replay writes it from the commit that is there.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        rows = batch.withColumns({"batch_id": F.lit(batch_id).cast("long"), LOAD_DAY: F.substring(stamp, 1, 8)})
        append_evolving(rows, table, [LOAD_DAY], load=(hub, batch_id))
        landed = VersionedTable(batch.sparkSession, table)
        version = landed.version(load_id=batch_id, writer=hub)
        files = landed.files(version).where(F.col("write") == version.write)
        counts = files.groupBy(F.regexp_extract("part", f"{LOAD_DAY}=([^/]+)", 1).alias("proc_date")).agg(F.sum("rows").alias("row_count"))
        audited = counts.withColumns({"hub": F.lit(hub), "batch_id": F.lit(batch_id).cast("long"), "batch_timestamp": batch_time})
        append_evolving(audited, audit, load=(hub, batch_id))

    return each
