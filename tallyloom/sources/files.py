"""File scans."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.functions.dates import stamp_from_filename
from tallyloom.session import path_exists

FIRST_LOAD = "1900-01-01"  # fixed value: last refresh of a source that was never read


def read_parquet_partition(spark: SparkSession, base: str, d: date | str) -> DataFrame:
    """One day of a ``yyyy=/mm=/dd=`` directory, by partition pruning."""
    y, m, dd = str(d).split("-")
    # partition values may be inferred as numbers or kept as text; comparing numbers prunes both
    return spark.read.parquet(base).where(
        (F.col("yyyy").cast("int") == int(y)) & (F.col("mm").cast("int") == int(m)) & (F.col("dd").cast("int") == int(dd))
    )


def read_parquet_safe(spark: SparkSession, path: str, schema: str | StructType) -> tuple[DataFrame, list[str]]:
    """The frame and its files, or an empty frame of the same schema when there is nothing to read."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema), []
    df = spark.read.schema(schema).parquet(path)
    return df, df.inputFiles()


def read_csv(spark: SparkSession, path: str, schema: str | StructType, header: bool = True, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("header", header).option("sep", sep).csv(path)


def _window(reader, after: datetime | str | None, before: datetime | str | None):
    reader = reader.option("recursiveFileLookup", True)
    if after is not None:
        reader = reader.option("modifiedAfter", _iso(after))
    if before is not None:
        reader = reader.option("modifiedBefore", _iso(before))
    return reader


def _iso(ts: datetime | str) -> str:
    return ts.strftime("%Y-%m-%dT%H:%M:%S") if isinstance(ts, datetime) else ts


def read_csv_incremental(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    after: datetime | str | None,
    before: datetime | str | None = None,
    sep: str = ",",
) -> DataFrame:
    """CSV files below ``path`` modified between two times (session time zone)."""
    return _window(spark.read.schema(schema).option("header", True).option("sep", sep), after, before).csv(path)


def read_parquet_incremental(spark: SparkSession, path: str, after: datetime | str | None) -> DataFrame:
    return _window(spark.read, after, None).parquet(path)


def frame_stats(df: DataFrame) -> DataFrame:
    """Row and column count as one row, without bringing rows to the driver."""
    return df.agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def new_files(
    spark: SparkSession, path: str, last_refresh: datetime, now: datetime, suffix: str = ".csv", shift_hours: int = 7
) -> DataFrame:
    """Files with the suffix that arrived since the last refresh and before ``now``.

    The refresh time is local and the file times are UTC. A source that was never read takes files of
    the current day only. Listing and filtering are a scan of file metadata: contents are not read.
    """
    if last_refresh.strftime("%Y-%m-%d") == FIRST_LOAD:
        since = now.replace(hour=0, minute=0, second=0, microsecond=0)
    else:
        since = last_refresh - timedelta(hours=shift_hours)
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", "modificationTime", "length")
    )
    t = F.col("modificationTime")
    inside = (t >= F.lit(_iso(since)).cast("timestamp")) & (t < F.lit(_iso(now)).cast("timestamp"))
    return files.where(inside & F.lower("path").endswith(suffix))


def read_json_multiline(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """JSON documents that span lines; each file is parsed by one task, so files should be small."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_any(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: str | StructType | None = None,
    row_tag: str | None = None,
    **options: str,
) -> DataFrame:
    """Format-generic scan; ``row_tag`` is the record element of an XML source."""
    reader = spark.read.format(fmt).options(**options)
    if row_tag:
        reader = reader.option("rowTag", row_tag)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def rename_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def with_file_stamp(df: DataFrame, out: str = "file_ts", suffix: str = ".xml") -> DataFrame:
    """Source time from the name of the file a row came from."""
    return df.withColumn(out, stamp_from_filename(F.col("_metadata.file_name"), suffix))


def with_lineage(df: DataFrame, out: str = "source_metadata") -> DataFrame:
    """``path|modified time`` of the file a row came from."""
    path, modified = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    return df.withColumn(out, F.concat_ws("|", path, modified.cast("string")))


def newest_snapshot(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest load day; the day is a scalar subquery, so partitions are pruned at run time."""
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())
