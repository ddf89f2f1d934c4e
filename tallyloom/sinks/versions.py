"""Versioned tables over Parquet.

A table is a folder with three parts. ``data`` holds one immutable folder per write (``tl_write=<id>``, below it the table's partitions),
``manifests`` one Parquet table per version that names the version's files with their row counts and key ranges, and ``commits`` one JSON file
per version with schema, change counts and the manifest's place. A version exists when its commit file does, and that file is put in place by one
rename that fails if the name is taken. So readers see a whole version or the one before, a writer that dies leaves only files
that nobody reads, and of two writers that start from the same version one is told to begin again.

All rows about files stay in Spark; the driver sees the commit file and the paths that a read hands to the scan: folders where a write is still
whole, single files otherwise.

Tables with ``keys`` are laid out in buckets of the keys' hash, sorted by it. The manifest then holds the range of hashes of each file, and ``filters``
a blocked Bloom filter per file as rows (file, word, bits), so that a batch finds the files that it can change by equi-joins.

The rename is atomic on file systems like HDFS; on a local disk there is a moment between its check and the move, and object stores need
their own connector's guarantee.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.session import file_system, path_exists

WRITE, BUCKET = "tl_write", "tl_bucket"
MANIFEST = "file STRING, write STRING, siblings BIGINT, part STRING, rows BIGINT, bytes BIGINT, bucket INT, low BIGINT, high BIGINT"
#: Words of 64 bits in a file's filter; with the rows a file may have, at most four keys set three bits each in a word.
WORDS, ROWS_PER_FILE = 1 << 18, 1 << 20


class CommitConflict(RuntimeError):
    """Another writer committed the version that this one was about to write."""


@dataclass(frozen=True)
class Version:
    number: int
    operation: str
    manifest: str
    schema: str  #: JSON of the columns, partition columns at their place
    partition_by: list[str] = field(default_factory=list)
    keys: list[str] = field(default_factory=list)
    buckets: int = 0
    write: str | None = None  #: id of its new files
    writer: str | None = None
    load_id: int | None = None
    writers: dict[str, int] = field(default_factory=dict)  #: last load id of each writer
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    kept: int = 0
    rows: int = 0  #: of the whole version

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def _file_name() -> Column:
    """A row's file as the manifest names it: the name in the folder, which Spark's metadata gives as part of a URI."""
    return F.url_decode(F.replace(F.regexp_extract(F.col("_metadata.file_path"), f"({WRITE}=[^/]+/.*)$", 1), F.lit("+"), F.lit("%2B")))


def _filter_place(h: Column) -> tuple[Column, Column]:
    """Word of a hash in a file's filter and its three bits there."""
    mixed = F.xxhash64(h, F.lit(7))

    def bit(shift: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(mixed, shift).bitwiseAND(F.lit(63)).cast("int"))

    return F.shiftrightunsigned(mixed, 40).bitwiseAND(F.lit(WORDS - 1)).cast("int"), bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12))


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- versions ----

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/commits")

    def numbers(self) -> list[int]:
        """Committed versions, rising."""
        if not self.exists():
            return []
        fs, folder = file_system(self.spark, f"{self.path}/commits")
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _commit_path(self, number: int) -> str:
        return f"{self.path}/commits/{number:020d}.json"

    def version(self, number: int | None = None, load_id: int | None = None, writer: str | None = None) -> Version | None:
        """The newest version, that of a number, or the newest one of a load id (of one writer); None if there is none."""
        if load_id is not None:
            loads = self.history().where(F.col("load_id") == load_id) if self.exists() else None
            loads = loads.where(F.col("writer") == writer) if loads is not None and writer else loads
            found = loads.agg(F.max("number")).head()[0] if loads is not None else None
            return None if found is None else self.version(found)
        if number is None:
            numbers = self.numbers()
            if not numbers:
                return None
            number = numbers[-1]
        fs, p = file_system(self.spark, self._commit_path(number))
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            text = bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()
        return Version(**json.loads(text))

    def history(self) -> DataFrame:
        """One row per version: number, operation, load id and change counts."""
        columns = "number BIGINT, operation STRING, writer STRING, load_id BIGINT, inserted BIGINT, updated BIGINT, deleted BIGINT, kept BIGINT"
        return self.spark.read.schema(columns).option("pathGlobFilter", "*.json").json(f"{self.path}/commits")

    def commit(self, version: Version) -> None:
        """Put the commit file in place, or raise ``CommitConflict`` if the version is there already."""
        name = self._commit_path(version.number)
        temporary = f"{self.path}/commits/_{uuid.uuid4().hex}"
        fs, p = file_system(self.spark, temporary)
        stream = fs.create(p, True)
        stream.write(bytearray(json.dumps(asdict(version), sort_keys=True).encode("utf-8")))
        stream.close()
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        none = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            _, target = file_system(self.spark, name)
            hadoop.FileContext.getFileContext(fs.getUri(), fs.getConf()).rename(p, target, none)
        except Py4JJavaError as error:
            fs.delete(p, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise CommitConflict(f"version {version.number} of {self.path} was written by another writer") from None
            raise

    # ---- files ----

    def files(self, version: Version | None) -> DataFrame:
        """The manifest of a version. It is one small file, and what is asked of it alone is answered without a shuffle."""
        if version is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/{version.manifest}").coalesce(1)

    def read_files(self, files: DataFrame | list[Row], version: Version, with_file: bool = False) -> DataFrame:
        """Rows of some files of a version (manifest rows, or those already collected), in its columns, on request with ``tl_file``, the name that the manifest has for it.

        What the driver collects are paths: one per write whose files are all wanted, else one per file.
        """
        if isinstance(files, DataFrame):
            held = files.groupBy("write", "siblings").agg(F.count("*").alias("n"), F.collect_list("file").alias("files"))
            whole = F.array(F.concat(F.lit(f"{WRITE}="), "write"))
            rows = held.select(F.when(F.col("n") == F.col("siblings"), whole).otherwise(F.col("files")).alias("paths"))
            paths = [f"{self.path}/data/{p}" for r in rows.collect() for p in r.paths]
        else:
            paths = [f"{self.path}/data/{r.file}" for r in files]
        columns = [F.col(f"`{f.name}`") for f in version.struct.fields]
        if not paths:
            empty = self.spark.createDataFrame([], version.struct)
            return empty.withColumn("tl_file", F.lit(None).cast("string")) if with_file else empty
        reader = self.spark.read.schema(version.struct).option("basePath", f"{self.path}/data")
        return reader.parquet(*sorted(paths)).select(*columns, *([_file_name().alias("tl_file")] if with_file else []))

    def read(self, version: Version | None = None) -> DataFrame:
        version = version or self.version()
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version")
        return self.read_files(self.files(version), version)

    def write_files(self, df: DataFrame, partition_by: list[str], keys: list[str], buckets: int, gather: bool = True) -> str:
        """Rows into a folder of their own, which no version names yet; returns the write's id."""
        write = f"w{uuid.uuid4().hex}"  # a letter first, so that it is not taken for a number
        folder = f"{self.path}/data/{WRITE}={write}"
        parts = list(partition_by)
        if buckets:
            h = key_hash(keys)
            df = df.withColumn("tl_hash", h).withColumn(BUCKET, F.pmod("tl_hash", F.lit(buckets)).cast("int"))
            df = (df.hint("rebalance", F.col(BUCKET)) if gather else df).sortWithinPartitions(BUCKET, "tl_hash").drop("tl_hash")
            parts = [BUCKET]
        elif parts and gather:
            df = df.hint("rebalance", *[F.col(f"`{c}`") for c in parts])
        writer = df.write.option("maxRecordsPerFile", ROWS_PER_FILE) if buckets else df.write
        (writer.partitionBy(*parts) if parts else writer).parquet(folder)
        return write

    def found_files(self, write: str, schema: StructType, keys: list[str], buckets: int) -> DataFrame:
        """Manifest rows of a write, read from its files: footers, and the key columns of tables with buckets."""
        folder = f"{self.path}/data/{WRITE}={write}"
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(folder)
        h = key_hash(keys) if buckets else F.lit(None).cast("long")
        rows = rows.select(_file_name().alias("file"), F.col("_metadata.file_size").alias("bytes"), h.alias("h"))
        found = rows.groupBy("file", "bytes").agg(F.count("*").alias("rows"), F.min("h").alias("low"), F.max("h").alias("high"))
        bucket = F.nullif(F.regexp_extract("file", f"{BUCKET}=(\\d+)/", 1), F.lit("")).cast("int")
        part = F.regexp_extract("file", f"^{WRITE}=[^/]+/(.+)/[^/]+$", 1)
        return found.select("file", F.lit(write).alias("write"), F.lit(None).cast("long").alias("siblings"), part.alias("part"), "rows", "bytes", bucket.alias("bucket"), "low", "high")

    def write_filter(self, write: str, schema: StructType, keys: list[str]) -> None:
        """The Bloom filter of each file of a write, as rows (file, word, bits)."""
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(f"{self.path}/data/{WRITE}={write}")
        word, bits = _filter_place(F.col("h"))
        rows = rows.select(_file_name().alias("file"), key_hash(keys).alias("h"))
        rows = rows.select("file", word.alias("word"), bits.alias("bits")).groupBy("file", "word").agg(F.bit_or("bits").alias("bits"))
        rows.write.parquet(f"{self.path}/filters/{WRITE}={write}")

    def candidate_files(self, version: Version, hashes: DataFrame) -> DataFrame:
        """Files of a version that may hold a hash of column ``h``: by bucket and range, then by filter. No hash that is there is missed."""
        near = self.files(version).select("file", "write", "bucket", "low", "high")
        asked = hashes.select("h", F.pmod("h", F.lit(version.buckets)).cast("int").alias("bucket")).distinct()
        word, bits = _filter_place(F.col("h"))
        pairs = near.join(asked, "bucket").where(F.col("h").between(F.col("low"), F.col("high"))).select("file", "write", word.alias("word"), bits.alias("mask"))
        filters = self.spark.read.schema(f"file STRING, word INT, bits BIGINT, {WRITE} STRING").parquet(f"{self.path}/filters").withColumnRenamed(WRITE, "write")
        held = pairs.join(filters, ["write", "file", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        return held.select("file").distinct()

    # ---- changes ----

    def change(
        self,
        rows: DataFrame | None,
        base: Version | None,
        operation: str,
        *,
        drop: Column | DataFrame | Callable[[DataFrame, DataFrame], DataFrame] | None = None,
        partition_by: list[str] | None = None,
        keys: list[str] | None = None,
        buckets: int | None = None,
        schema: StructType | None = None,
        load: tuple[str, int] | None = None,
        counts: dict[str, int] | None = None,
        gather: bool = True,
    ) -> Version:
        """Commit the version after ``base``: its files without those to ``drop``, and ``rows`` in new files.

        ``drop`` is a condition on manifest rows, a frame of ``file``, or a function of the old and the new files. Layout and schema are those
        of ``base`` unless given. Without ``gather`` rows are written as they lie in the tasks. ``counts`` are the changes by kind; without them new rows are inserted and rows of dropped files deleted.
        """
        partition_by = list(partition_by if partition_by is not None else base.partition_by if base else [])
        keys = list(keys if keys is not None else base.keys if base else [])
        buckets = buckets if buckets is not None else base.buckets if base else 0
        schema = schema or (base.struct if base else rows.schema)
        old = self.files(base)
        new, write = self.spark.createDataFrame([], MANIFEST), None
        if rows is not None:
            write = self.write_files(rows, partition_by, keys, buckets, gather)
            new = self._listed(write, schema, keys, buckets)
            if buckets:
                self.write_filter(write, schema, keys)
        kept = old
        if drop is not None:
            if isinstance(drop, Column):
                kept = old.where(~F.coalesce(drop, F.lit(False)))
            else:
                gone = drop if isinstance(drop, DataFrame) else drop(old, new)
                kept = old.join(gone.select("file").distinct(), "file", "left_anti").select(*old.columns)
        manifest, obs = f"manifests/{uuid.uuid4().hex}", Observation(uuid.uuid4().hex)
        merged = kept.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)))
        merged = merged.observe(obs, F.sum(F.when(F.col("is_new"), F.col("rows"))).alias("added"), F.sum(F.when(~F.col("is_new"), F.col("rows"))).alias("stayed"))
        merged.drop("is_new").coalesce(1).write.parquet(f"{self.path}/{manifest}")
        seen = _seen(obs)
        added, stayed = (int(seen.get(k) or 0) for k in ("added", "stayed"))
        if counts is None:
            counts = {"inserted": added, "deleted": (base.rows if base else 0) - stayed}
        loads = {**(base.writers if base else {}), **({load[0]: load[1]} if load else {})}
        number = base.number + 1 if base else 1
        writer, load_id = load or (None, None)
        version = Version(number, operation, manifest, schema.json(), partition_by, keys, buckets, write, writer, load_id, loads, rows=added + stayed, **counts)
        self.commit(version)
        return version

    def _listed(self, write: str, schema: StructType, keys: list[str], buckets: int) -> DataFrame:
        """Manifest rows of a write, kept: their making reads every new file."""
        obs, place = Observation(uuid.uuid4().hex), f"{self.path}/manifests/{write}"
        self.found_files(write, schema, keys, buckets).observe(obs, F.count("*").alias("n")).coalesce(1).write.parquet(place)
        siblings = F.lit(int(_seen(obs).get("n") or 0)).cast("long")
        return self.spark.read.schema(MANIFEST).parquet(place).coalesce(1).withColumn("siblings", siblings)

    @staticmethod
    def seen(base: Version | None, load: tuple[str, int] | None) -> bool:
        """Whether a writer's load id, or a later one of it, was committed already."""
        return bool(load and base and base.writers.get(load[0], load[1] - 1) >= load[1])

    def vacuum(self, keep: int = 1) -> int:
        """Delete data that none of the newest ``keep`` versions names; returns the number of write folders deleted.

        Not to be run beside a writer: what it has not committed yet looks like what a dead one left.
        """
        numbers = self.numbers()
        live = None
        for n in numbers[-keep:]:
            files = self.files(self.version(n)).select("write").distinct()
            live = files if live is None else live.union(files).distinct()
        fs, data = file_system(self.spark, f"{self.path}/data")
        there = [s.getPath() for s in fs.listStatus(data)] if fs.exists(data) else []
        alive = {r.write for r in live.collect()} if live is not None else set()
        gone = [p for p in there if p.getName().split("=", 1)[-1] not in alive]
        for n in numbers[: len(numbers) - keep]:
            fs.delete(file_system(self.spark, self._commit_path(n))[1], False)
        for p in gone:
            fs.delete(p, True)
            fs.delete(file_system(self.spark, f"{self.path}/filters/{p.getName()}")[1], True)
        return len(gone)


def _seen(obs: Observation) -> dict:
    try:
        return obs.get
    except Py4JJavaError:  # the optimizer proved the rows empty and dropped the counter with them
        return {}


def same_parts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old files in the partitions that new files are in."""
    return old.join(new.select("part"), "part", "left_semi")
