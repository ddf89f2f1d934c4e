"""Incremental loads: what changed since a table was last built, from two control tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import clean_date_list, day, last_year_start
from tallyloom.session import broadcast_days

CHANGE_LOG = (
    "proc_date DATE, calday_list STRING, dataset_affect STRING, table_affect STRING, start_date DATE, end_date DATE, table_etl STRING"
)
DEPENDENCY_LOG = "proc_date DATE, dataset_affect STRING, table_affect STRING, dependency_table STRING, etl_from DATE, etl_to DATE"


def dependencies(
    change_log: DataFrame, dependency_log: DataFrame, dataset: str, table: str, as_of: date | str
) -> DataFrame:
    """Per table that the target depends on: the range of its changes the target has not consumed.

    Changes newer than the last consumed one count; a table without any consumed change counts whole.
    """
    mine = dependency_log.where((F.col("dataset_affect") == dataset) & (F.col("table_affect") == table))
    consumed = mine.groupBy("dependency_table").agg(F.max("etl_to").alias("_last"))
    changes = change_log.where(F.col("proc_date") <= day(as_of)).withColumn(
        "dependency_table", F.concat_ws(".", "dataset_affect", "table_affect")
    )
    fresh = changes.join(consumed, "dependency_table").where(
        F.col("_last").isNull() | (F.col("proc_date") > F.col("_last"))
    )
    return fresh.groupBy("dependency_table").agg(
        F.max("proc_date").alias("proc_date"), F.min("proc_date").alias("etl_from"), F.max("proc_date").alias("etl_to")
    ).select("proc_date", F.lit(dataset).alias("dataset_affect"), F.lit(table).alias("table_affect"), "dependency_table", "etl_from", "etl_to")


def changed_days(change_log: DataFrame, pending: DataFrame, as_of: date | str, first: date | str | None = None) -> DataFrame:
    """One row: range, day list and touched tables of the pending changes.

    The lists are as long as the calendar and the table catalogue. ``start_date_d`` and the listed days are not
    earlier than ``first``, which is the start of last year unless given.
    """
    named = change_log.withColumn("dependency_table", F.concat_ws(".", "dataset_affect", "table_affect"))
    hits = named.join(pending.select("dependency_table", "etl_from", "etl_to"), "dependency_table").where(
        F.col("proc_date").between(F.col("etl_from"), F.col("etl_to"))
    )
    floor = last_year_start(as_of) if first is None else day(first)
    tables = F.sort_array(F.collect_set("dependency_table"))
    lists = F.array_join(F.sort_array(F.collect_set("calday_list")), ",")
    return hits.agg(
        F.min("start_date").alias("start_date"),
        F.max("end_date").alias("end_date"),
        F.greatest(F.min("start_date"), floor).alias("start_date_d"),
        F.size(tables).cast("bigint").alias("table_count"),
        F.array_join(tables, ",").alias("table_etl"),
        clean_date_list(lists, as_of, floor).alias("calday_list"),
    )


def only_changed(fact: DataFrame, day_column: str, changes: DataFrame) -> DataFrame:
    """Fact rows of the changed days; the day list prunes partitions at run time, not by pasted text."""
    days = changes.select(F.explode(F.split("calday_list", ",")).alias("_d")).select(
        F.col("_d").try_cast("date").alias(day_column)
    )
    return fact.join(broadcast_days(days, day_column), day_column, "left_semi")


def log_rows(changes: DataFrame, pending: DataFrame, dataset: str, table: str, as_of: date | str) -> tuple[DataFrame, DataFrame]:
    """What to append to the change log and the dependency log once the load is done."""
    change = changes.select(
        day(as_of).alias("proc_date"), "calday_list", F.lit(dataset).alias("dataset_affect"), F.lit(table).alias("table_affect"),
        F.col("start_date_d").alias("start_date"), "end_date", "table_etl",
    )
    return change, pending
