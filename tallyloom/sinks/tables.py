"""Table writes.

Every writer makes the next version of a versioned Parquet table (``sinks.versions``): new files beside the old ones, then one commit.
Readers keep the version that they opened, a writer that dies leaves the table as it was, and a write with a ``load`` (writer, load id) that
was committed before does nothing when it is repeated.

* Writers by day or predicate replace the files of those partitions. They read nothing of the old rows.
* Writers by key find the files that hold a key of the batch, read those and write their other rows again. Tables with ``buckets`` are asked by
  hash range and Bloom filter first; of other tables the key columns are read, of the batch's days where the partition column is a key.

A batch that is looked at more than once is written to the scratch folder first, so that all looks see the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallyloom.session import fresh_dir, path_exists
from tallyloom.sinks.versions import CommitConflict, Version, VersionedTable, key_hash, same_parts

Load = tuple[str, int]


@dataclass(frozen=True)
class WriteStats:
    table: str
    operation: str
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    kept: int = 0  #: rows that were written again as they were
    version: int | None = None


def _stats(path: str, version: Version) -> WriteStats:
    return WriteStats(path, version.operation, version.inserted, version.updated, version.deleted, version.kept, version.number)


def _nothing(path: str, operation: str, base: Version) -> WriteStats:
    """What a repeated load does."""
    return WriteStats(path, operation, version=base.number)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of a table, or a plain Parquet folder; None when nothing was written yet."""
    table = VersionedTable(spark, path)
    version = table.version()
    if version is not None:
        return table.read(version)
    return spark.read.parquet(path) if path_exists(spark, path) else None


def read_version(spark: SparkSession, path: str, load_id: int | None = None, number: int | None = None) -> DataFrame:
    """The table as a load, or the commit of a number, left it."""
    table = VersionedTable(spark, path)
    version = table.version(number=number, load_id=load_id)
    if version is None:
        raise LookupError(f"{path} has no version {number if load_id is None else f'of load {load_id}'}")
    return table.read(version)


def change_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per version with its inserted, updated, deleted and kept rows."""
    return VersionedTable(spark, path).history()


def _part_is(column: str, value) -> Column:
    """Manifest rows of one partition. Folder names escape some signs with %."""
    name = F.lit("__HIVE_DEFAULT_PARTITION__" if value is None else str(value))
    levels = F.transform(F.split("part", "/"), lambda x: F.url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))))
    return F.array_contains(levels, F.concat(F.lit(f"{column}="), name))


def replace_table(
    df: DataFrame,
    path: str,
    operation: str = "replace",
    partition_by: list[str] | None = None,
    keys: list[str] | None = None,
    buckets: int | None = None,
    load: Load | None = None,
) -> WriteStats:
    """Full rebuild. With ``keys`` and ``buckets`` the table is laid out for changes by key; an existing layout is kept unless given anew."""
    table = VersionedTable(df.sparkSession, path)
    base = table.version()
    if table.seen(base, load):
        return _nothing(path, operation, base)
    version = table.change(df, base, operation, drop=F.lit(True), schema=df.schema, partition_by=partition_by, keys=keys, buckets=buckets, load=load)
    return _stats(path, version)


def replace_days(df: DataFrame, path: str, by: str | list[str], operation: str = "replace_days", load: Load | None = None) -> WriteStats:
    """Replace the partitions present in the batch, keep the others.

    Rows are brought together by partition value; AQE splits a value that holds most of the rows (a rebalance, not a hash repartition).
    """
    return _replace_parts(df, path, [by] if isinstance(by, str) else list(by), operation, load, same_parts)


def replace_where(df: DataFrame, path: str, column: str, value, load: Load | None = None) -> WriteStats:
    """Overwrite the one partition ``column = value``; the batch must hold no other value. An empty batch empties the partition."""
    wanted = F.col(column).isNull() if value is None else F.col(column) == F.lit(value)
    outside = F.raise_error(F.lit(f"row outside {column} = {value}")).cast(df.schema[column].dataType)
    checked = df.withColumn(column, F.when(wanted, F.col(column)).otherwise(outside))
    return _replace_parts(checked, path, [column], "replace_where", load, _part_is(column, value))


def append_history(df: DataFrame, path: str, on, day_column: str = "calday", load: Load | None = None) -> WriteStats:
    """One full copy per day; a second run of the day replaces that day's copy, also by an empty one."""
    stamped = df.withColumn(day_column, F.lit(str(on)).cast("date"))
    return _replace_parts(stamped, path, [day_column], "history", load, _part_is(day_column, on))


def _replace_parts(df: DataFrame, path: str, by: list[str], operation: str, load: Load | None, drop) -> WriteStats:
    table = VersionedTable(df.sparkSession, path)
    base = table.version()
    if table.seen(base, load):
        return _nothing(path, operation, base)
    if base is not None and base.partition_by != by:
        raise ValueError(f"{path} is partitioned by {base.partition_by}, not by {by}")
    return _stats(path, table.change(_fitting(df, base), base, operation, drop=drop, partition_by=by, load=load))


def _fitting(df: DataFrame, base: Version | None) -> DataFrame:
    """The batch in the table's columns; a name or a type that the table does not have is refused."""
    if base is None:
        return df
    wanted, have = ({f.name: f.dataType.simpleString() for f in schema.fields} for schema in (base.struct, df.schema))
    if wanted != have:
        raise ValueError(f"the table has {base.struct.simpleString()}, the batch {df.schema.simpleString()}: align_schema makes them equal")
    return df.select(*[F.col(f"`{c}`") for c in wanted])


def append(df: DataFrame, path: str, partition_by: list[str] | None = None, load: Load | None = None) -> WriteStats:
    """Add rows. With ``load`` a replay adds them once; without, each call adds them."""
    return _append(df, path, partition_by, load, evolve=False)


def append_evolving(df: DataFrame, path: str, partition_by: list[str] | None = None, load: Load | None = None) -> WriteStats:
    """Append rows whose columns may differ from the table's: new columns are NULL in old rows, absent ones in the new rows."""
    return _append(df, path, partition_by, load, evolve=True)


def _append(df: DataFrame, path: str, partition_by: list[str] | None, load: Load | None, evolve: bool) -> WriteStats:
    """An append depends on no earlier row, so one that loses the race for a version is committed after the winner."""
    table = VersionedTable(df.sparkSession, path)
    while True:
        base = table.version()
        if table.seen(base, load):
            return _nothing(path, "append", base)
        schema = _widened(base.struct, df.schema) if evolve and base else None
        rows = align_schema(df, schema) if schema else _fitting(df, base)
        try:
            return _stats(path, table.change(rows, base, "append", partition_by=partition_by if base is None else None, schema=schema, load=load))
        except CommitConflict:
            continue


def _widened(old: StructType, new: StructType) -> StructType:
    """The table's columns and, after them, the batch's new ones."""
    known = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if f.name in known and known[f.name].simpleString() != f.dataType.simpleString():
            raise ValueError(f"{f.name} is {known[f.name].simpleString()} in the table and {f.dataType.simpleString()} in the batch")
    return StructType([*old.fields, *[StructField(f.name, f.dataType, True) for f in new.fields if f.name not in known]])


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path)


def align_schema(df: DataFrame, schema: str | StructType) -> DataFrame:
    """Columns of the target in its order and types; absent ones are NULL, surplus ones dropped."""
    target = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = [
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields
    ]
    return df.select(*columns)


def _plain(writer, rows: DataFrame, path: str, operation: str) -> WriteStats:
    obs = Observation()
    writer(rows.observe(obs, F.count("*").alias("n"))).parquet(path)
    return WriteStats(path, operation, inserted=_count(obs))


def _count(obs: Observation) -> int:
    try:
        return int(obs.get.get("n") or 0)
    except Py4JJavaError:  # the optimizer proved the rows empty and dropped the counter with them
        return 0


def write_dated(df: DataFrame, path: str, parts: tuple[str, ...] = ("yyyy", "mm", "dd"), load_id: int | None = None) -> WriteStats:
    """Add to a plain landing folder partitioned by ``yyyy/mm/dd``, with rows of a day brought together.

    With ``load_id`` the rows of a load are a partition of their own below the day (``load_id=``), and a replay of the load replaces its
    partitions instead of adding to the day.
    """
    rows = df.hint("rebalance", *[F.col(p) for p in parts])
    if load_id is None:
        return _plain(lambda r: r.write.mode("append").partitionBy(*parts), rows, path, "append_dated")
    rows = rows.withColumn("load_id", F.lit(load_id).cast("long"))
    return _plain(lambda r: r.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts, "load_id"), rows, path, "append_dated")


def write_extract(df: DataFrame, path: str, load_id: int, one_file_rows: int = 0) -> WriteStats:
    """An extract for others as snappy Parquet, one folder ``load_id=`` per load that a replay replaces.

    Files are written by as many tasks as the rows fill. An extract of at most ``one_file_rows`` rows, such as an aggregate, is one file: it is
    written as it comes, counted, and only then copied by one task.
    """
    spark, staged, folder = df.sparkSession, fresh_dir(df.sparkSession, "extract"), f"{path.rstrip('/')}/load_id={load_id}"
    stats = _plain(lambda r: r.hint("rebalance").write, df, staged, "extract")
    rows = spark.read.schema(df.schema).parquet(staged)
    if stats.inserted <= one_file_rows:
        rows = rows.coalesce(1)
    rows.write.mode("overwrite").option("compression", "snappy").parquet(folder)
    return WriteStats(path, "extract", inserted=stats.inserted)


# --- changes by key -------------------------------------------------------------------------


def _fixed(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Rows written once to the scratch folder, and their number."""
    place = fresh_dir(df.sparkSession, label)
    n = _plain(lambda r: r.write, df, place, label).inserted
    return df.sparkSession.read.schema(df.schema).parquet(place), n


def _met(table: VersionedTable, base: Version, batch: DataFrame, keys: list[str], day: str | None) -> DataFrame:
    """Rows of the table that a batch can change, as (tl_file, keys): only files that may hold them are opened, and only their keys are read."""
    files = table.files(base)
    if base.buckets and base.keys == keys:
        files = files.join(table.candidate_files(base, batch.select(key_hash(keys).alias("h"))), "file", "left_semi")
    elif day is not None and day in base.partition_by:
        name = F.coalesce(F.col(f"`{day}`").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        days = batch.select(F.concat(F.lit(f"{day}="), name).alias("level")).distinct()
        level = F.explode(F.transform(F.split("part", "/"), lambda x: F.url_decode(F.replace(x, F.lit("+"), F.lit("%2B")))))
        files = files.join(files.select("file", level.alias("level")).join(days, "level", "left_semi").select("file").distinct(), "file", "left_semi")
    held = table.read_files(files, base, with_file=True).select("tl_file", *keys)
    return held.join(batch.select(*keys), keys, "left_semi")


def _check_day(keys: list[str], day: str | None) -> None:
    """A key must not be able to move between partitions: only the batch's days are looked at."""
    if day is not None and day not in keys:
        raise ValueError(f"the partition column {day} must be one of the keys")


def _hits(table: VersionedTable, base: Version, batch: DataFrame, keys: list[str], day: str | None) -> DataFrame:
    """What ``_met`` finds, written once."""
    return _fixed(_met(table, base, batch, keys, day).select("tl_file", *keys), "hits")[0]


def _rewritten(table: VersionedTable, base: Version, batch: DataFrame, hits: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, int, int]:
    """Files that hold a key of the batch, their other rows, and how many rows of them the batch meets and leaves.

    The driver sees the names of the files that are to be read, as for any scan.
    """
    matched = hits.groupBy(F.col("tl_file").alias("file")).agg(F.count("*").alias("matched"))
    touched = table.files(base).join(matched, "file").select("file", "write", "siblings", "rows", "matched").collect()
    files = table.spark.createDataFrame(touched, "file STRING, write STRING, siblings BIGINT, rows BIGINT, matched BIGINT").coalesce(1)
    n, total = sum(r.matched for r in touched), sum(r.rows for r in touched)
    columns = [F.col(f"`{f.name}`") for f in base.struct.fields]
    others = table.read_files(touched, base).join(batch.select(*keys), keys, "left_anti").select(*columns)
    return files, others, n, total - n


def _created(df: DataFrame, path: str, day: str | None, keys: list[str], buckets: int | None, operation: str, load: Load | None) -> WriteStats:
    table = VersionedTable(df.sparkSession, path)
    layout = {"keys": keys, "buckets": buckets} if buckets else {"partition_by": [day] if day else []}
    return _stats(path, table.change(df, None, operation, load=load, **layout))


def replace_keys(df: DataFrame, path: str, keys: list[str], day: str | None = None, buckets: int | None = None, load: Load | None = None) -> WriteStats:
    """Drop target rows whose key occurs in the batch, then add the batch.

    With ``day`` (part of the key, and the table's partition column) only files of the batch's days are looked at. ``buckets`` lays a new table out
    by key.
    """
    _check_day(keys, day)
    table = VersionedTable(df.sparkSession, path)
    base = table.version()
    if table.seen(base, load):
        return _nothing(path, "replace_keys", base)
    if base is None:
        return _created(df, path, day, keys, buckets, "replace_keys", load)
    rows, n = _fixed(_fitting(df, base), "batch")
    hits = _hits(table, base, rows, keys, day)
    touched, others, matched, kept = _rewritten(table, base, rows, hits, keys)
    counts = {"inserted": n, "deleted": matched, "kept": kept}
    return _stats(path, table.change(others.unionByName(rows), base, "replace_keys", drop=touched, load=load, counts=counts))


def insert_absent(df: DataFrame, path: str, keys: list[str], day: str | None = None, buckets: int | None = None, load: Load | None = None) -> WriteStats:
    """Append the batch rows whose key the target lacks; with ``day``, one of the keys, only its days are probed. No file is rewritten."""
    _check_day(keys, day)
    table = VersionedTable(df.sparkSession, path)
    base = table.version()
    if table.seen(base, load):
        return _nothing(path, "insert_absent", base)
    if base is None:
        return _created(df, path, day, keys, buckets, "insert_absent", load)
    rows, _ = _fixed(_fitting(df, base), "batch")
    fresh = rows.join(_hits(table, base, rows, keys, day).select(*keys), keys, "left_anti").select(*rows.columns)
    return _stats(path, table.change(fresh, base, "insert_absent", load=load))


def upsert(df: DataFrame, path: str, keys: list[str], day: str | None = None, buckets: int | None = None, load: Load | None = None) -> WriteStats:
    """Update every column of matched keys and insert the rest.

    A batch with the same key twice is an error, as it is for MERGE. With ``day`` (one of the keys, and the table's
    partition column) only files of the batch's days are looked at; ``buckets`` lays a new table out by key. Files without a key of the
    batch are neither read beyond their keys nor written again.
    """
    _check_day(keys, day)
    table = VersionedTable(df.sparkSession, path)
    base = table.version()
    if table.seen(base, load):
        return _nothing(path, "upsert", base)
    rows, n = _fixed(_fitting(df, base), "batch")
    twice = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n").first()
    if twice is not None:
        raise ValueError(f"key {tuple(twice)} occurs more than once in the batch")
    if base is None:
        return _created(rows, path, day, keys, buckets, "upsert", load)
    hits = _hits(table, base, rows, keys, day)
    touched, others, matched, kept = _rewritten(table, base, rows, hits, keys)
    updated = hits.agg(F.count_distinct(*keys)).head()[0] if matched else 0
    counts = {"inserted": n - updated, "updated": updated, "deleted": matched - updated, "kept": kept}
    return _stats(path, table.change(others.unionByName(rows), base, "upsert", drop=touched, load=load, counts=counts))


def compact(spark: SparkSession, path: str, target_bytes: int = 256 << 20, load: Load | None = None) -> WriteStats:
    """Bring small files together: within a partition or bucket, files below the target are put into bins of about its size by running
    sum, and the rows of each bin are written as one file. Partitions with one small file are left alone. No row changes.

    Loads that commit while the rows are copied win: a compaction that finds another version raises ``CommitConflict`` and can be run again.
    """
    table = VersionedTable(spark, path)
    base = table.version()
    if base is None or table.seen(base, load):
        return WriteStats(path, "compact", version=base.number if base else None)
    upto = Window.partitionBy("part").orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
    small = table.files(base).where(F.col("bytes") < target_bytes)
    bins = small.withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(upto), F.lit(0)) / F.lit(target_bytes)).cast("int"))
    several = bins.groupBy("part", "bin").agg(F.count("*").alias("n")).where("n > 1")
    bins, _ = _fixed(bins.join(several, ["part", "bin"], "left_semi").select("file", "write", "siblings", "part", "bin", "rows"), "bins")
    total = bins.agg(F.sum("rows")).head()[0]
    if not total:
        return WriteStats(path, "compact", version=base.number)
    rows = table.read_files(bins, base, with_file=True)
    place = bins.select(F.col("file").alias("tl_file"), "part", "bin")
    # not sorted: the rows of a bin stream from the shuffle into its file (where there are partitions, the writer sorts by them)
    rows = rows.join(place, "tl_file").repartition("part", "bin")
    rows = rows.select(*[F.col(f"`{f.name}`") for f in base.struct.fields])
    return _stats(path, table.change(rows, base, "compact", drop=bins, load=load, counts={"kept": int(total)}, gather=False))


# --- write log ------------------------------------------------------------------------------

LOG_SCHEMA = "load_id BIGINT, table STRING, operation STRING, inserted BIGINT, updated BIGINT, deleted BIGINT, kept BIGINT"


def log_write(spark: SparkSession, log_path: str, load_id: int, stats: WriteStats) -> None:
    """Add one row per table and load to the write log; logging a load again does nothing."""
    name = stats.table.rstrip("/").rsplit("/", 1)[-1]
    row = (load_id, name, stats.operation, stats.inserted, stats.updated, stats.deleted, stats.kept)
    append(spark.createDataFrame([row], LOG_SCHEMA), log_path, load=(name, load_id))


def latest_change(spark: SparkSession, log_path: str, table: str) -> DataFrame:
    """Newest load of a table with its change counts; ``read_version`` reads the table as that load left it."""
    log = read_table(spark, log_path).where(F.col("table") == table)
    return log.orderBy(F.desc("load_id")).limit(1)
