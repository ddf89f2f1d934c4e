"""Data quality: profiles, control totals, source-to-target reconciliation, ingest audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.numbers import exact_sum
from tallyloom.operators.aggregates import zero_fill
from tallyloom.sinks.tables import align_schema


def column_sums(df: DataFrame, columns: list[str] | str) -> DataFrame:
    """Sums of the named columns as one JSON text; no columns gives NULL."""
    names = [c.strip() for c in columns.split(",") if c.strip()] if isinstance(columns, str) else list(columns)
    if not names:
        return df.sparkSession.range(1).select(F.lit(None).cast("string").alias("sums"))
    return df.agg(F.to_json(F.struct(*[F.sum(c).alias(c) for c in names])).alias("sums"))


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: nulls, distinct values, range of whole numbers, lengths of text.

    Columns become rows ``(column, value, length)`` and are counted by value first, so a distinct count
    is a count of groups spread over the cluster, whatever the number of columns. Long values travel as
    their digest.
    """
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        whole = isinstance(f.dataType, (T.IntegerType, T.LongType))
        text = isinstance(f.dataType, T.StringType)
        nested = isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
        value = F.to_json(c) if nested else c.cast("string")
        parts.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.when(F.length(value) > 64, F.concat(F.lit("sha2:"), F.sha2(value, 256))).otherwise(value).alias("value"),
                (c.cast("bigint") if whole else F.lit(None).cast("bigint")).alias("number"),
                (F.length(c) if text else F.lit(None).cast("int")).alias("len"),
            )
        )
    rows = df.select(F.inline(F.array(*parts)))
    by_value = rows.groupBy("column_name", "value").agg(
        F.count("*").alias("_n"), F.first("number").alias("number"), F.first("len").alias("len")
    )
    return by_value.groupBy("column_name").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("_n")).otherwise(0)).alias("null_count"),
        F.count("value").alias("distinct_count"),
        F.min("number").alias("min_value"),
        F.max("number").alias("max_value"),
        F.min("len").alias("min_length"),
        F.max("len").alias("max_length"),
        F.sum(F.col("len") * F.col("_n")).alias("total_length"),
    )


def profile_log_row(profile: DataFrame, table: str, layer: str, proc_date: Column, operation: str, stats) -> DataFrame:
    """One log row per table with the column metrics as an array (as many records as columns)."""
    metrics = F.sort_array(F.collect_list(F.struct(*profile.columns))).alias("column_metrics")
    return profile.agg(metrics).select(
        F.lit(table).alias("table_name"),
        F.lit(layer).alias("layer"),
        proc_date.alias("proc_date"),
        F.lit(operation).alias("operation"),
        F.lit(stats.inserted).cast("bigint").alias("inserted_records"),
        F.lit(stats.updated).cast("bigint").alias("updated_records"),
        "column_metrics",
    )


def source_target_reconcile(source: DataFrame, target: DataFrame, columns: list[str], column_counts: tuple[int, int] | None = None) -> DataFrame:
    """Compare row counts, control totals and column counts; two empty sides agree.

    Both sides are tagged and compared by one aggregate over their sums. Sums of fractional columns are taken as
    decimals, so that they do not depend on the order of the rows.
    """
    n_source, n_target = column_counts or (len(source.columns), len(target.columns))

    def total(df: DataFrame, c: str) -> Column:
        return exact_sum(F.col(c)) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.sum(c)

    def side(df: DataFrame, tag: int) -> DataFrame:
        return df.agg(
            F.count("*").alias("n"), F.to_json(F.struct(*[total(df, c).alias(c) for c in columns])).alias("sums")
        ).withColumn("side", F.lit(tag))

    both = side(source, 0).unionByName(side(target, 1))

    def of(tag: int, c: str) -> Column:
        return F.max(F.when(F.col("side") == tag, F.col(c)))

    row = both.agg(
        of(0, "n").alias("source_count"), of(1, "n").alias("target_count"), of(0, "sums").alias("source_sums"), of(1, "sums").alias("target_sums")
    )

    def verdict(ok: Column) -> Column:
        return F.when(ok, "Passed").otherwise("Failed")

    checks = {
        "count": F.col("source_count") == F.col("target_count"),
        "sums": F.col("source_sums").eqNullSafe(F.col("target_sums")),
        "columns": F.lit(n_source == n_target),
    }
    out = row.withColumns({f"{name}_check": verdict(ok) for name, ok in checks.items()})
    passed = reduce(lambda a, b: a & b, checks.values())
    notes = [
        F.concat(F.lit("Validation "), F.col(f"{name}_check"), F.lit(f" - {name}")) for name in checks
    ]
    return out.withColumns({"status": verdict(passed), "messages": F.concat_ws("; ", *notes)})


# --- ingest audit ---------------------------------------------------------------------------


def invalid_summary(invalid: DataFrame, hubs: DataFrame, on: Column) -> DataFrame:
    """Invalid records of a day per hub, with their distinct error texts.

    ``invalid`` has ``hub, ingest_day, error``. Errors are counted by text first; a hub lists each text
    once, and there are as many texts as contract rules.
    """
    by_error = invalid.where(F.col("ingest_day") == on).groupBy("hub", "error").agg(F.count("*").alias("_n"))
    per_hub = by_error.groupBy("hub").agg(
        F.sum("_n").alias("_n"), F.array_join(F.sort_array(F.collect_set("error")), ", ").alias("schema_mismatches")
    )
    joined = hubs.join(per_hub, "hub", "left")
    n = F.coalesce("_n", F.lit(0))
    return joined.select(
        "hub",
        n.cast("int").alias("invalid_record_count"),
        F.when(n > 0, "Mismatched").otherwise("Matched").alias("schema_match_status"),
        "schema_mismatches",
    )


def streamed_summary(audit_log: DataFrame, hubs: DataFrame, on: Column) -> DataFrame:
    """Streamed rows of a day per hub from the batch audit log; absent hubs are zero."""
    summed = audit_log.where(F.col("proc_date") == on).groupBy("hub").agg(F.sum("row_count").alias("streaming_count"))
    return zero_fill(summed, hubs, ["hub"], ["streaming_count"]).withColumn("proc_date", on)


def landed_summary(landed: DataFrame, on: Column, day_column: str = "load_day") -> DataFrame:
    """Landed rows of a day per hub; ``landed`` is the union of the landed tables with a hub column.

    Landed tables are partitioned by load day, so the condition picks the day's partitions and no other file is opened.
    """
    rows = landed.where(F.col(day_column) == on)
    return rows.groupBy("hub").agg(F.count("*").alias("landed_count")).withColumn("proc_date", on)


def audit_reconcile(streamed: DataFrame, landed: DataFrame, invalid: DataFrame) -> DataFrame:
    """Streamed against landed counts per hub and day, with the hub's contract status."""
    joined = streamed.join(landed, ["hub", "proc_date"], "full").join(invalid, "hub", "left")
    return joined.select(
        "hub", "proc_date", "streaming_count", "landed_count", "invalid_record_count", "schema_match_status", "schema_mismatches"
    )


def audit_result(final: DataFrame, schema: str | T.StructType, constants: dict[str, str]) -> DataFrame:
    """Reconciled counts as rows of the consolidated audit table, in its column order and types."""
    named = final.withColumns(
        {
            "load_date": F.to_date("proc_date", "yyyyMMdd"),
            "table_name": F.col("hub"),
            "source_object_count": F.col("streaming_count").cast("string"),
            "target_object_count": F.col("landed_count").cast("string"),
        }
        | {name: F.lit(value) for name, value in constants.items()}
    )
    return align_schema(named, schema)
