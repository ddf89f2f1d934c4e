"""Exact duplicates through an extendible-hash index on shared files.

Every Arrow batch first collapses its own copies, so that a text with a third of all rows reaches its owner as
one row per batch. The 64-bit key of a text selects a bucket by its leading bits. The directory starts with one
bucket; a bucket with more keys than ``bucket_rows`` is split on its next bit, and the directory doubles when a
split needs more bits than it has. Copies of one key cannot be split; at ``max_depth`` bits a bucket stays as
it is, whatever its size, and overflows into its chain. Buckets are ranges of keys, and each owner task takes a
run of neighbouring buckets, reads them in key order, chains texts whose keys collide and tells them apart by
comparing bytes. What the owners find is the index: files in the shared folder, one row per entry.

The driver holds the directory only: at most 2**max_depth slots, however many documents there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import ROW, ascii_lower, map_batches, schema_of, wrapped, written

MAX_DEPTH = 16


class Directory:
    """Extendible-hash directory over key prefixes: ``slots[prefix]`` is a bucket, ``depth`` its global depth.

    ``counts`` holds the number of keys under each used prefix of ``max_depth`` bits. Buckets are numbered in
    the order of their keys; ``rows`` and ``local_depth`` belong to them.
    """

    def __init__(self, counts: dict[int, int], bucket_rows: int, max_depth: int = MAX_DEPTH):
        before = np.zeros((1 << max_depth) + 1, np.int64)
        for prefix, n in counts.items():
            before[prefix + 1] = n
        before = before.cumsum()

        def held(prefix: int, bits: int) -> int:
            low = prefix << (max_depth - bits)
            return int(before[low + (1 << (max_depth - bits))] - before[low])

        self.depth, self.rows, self.local_depth = 0, [], []
        settled, pending = [], [(0, 0)]
        while pending:
            prefix, bits = pending.pop()
            if held(prefix, bits) <= bucket_rows or bits == max_depth:
                settled.append((prefix, bits))
                continue
            self.depth = max(self.depth, bits + 1)  # the directory doubles
            pending += [(2 * prefix + 1, bits + 1), (2 * prefix, bits + 1)]
        self.slots = []
        for bucket, (prefix, bits) in enumerate(settled):  # in key order, the lower half of a split first
            self.rows.append(held(prefix, bits))
            self.local_depth.append(bits)
            self.slots += [bucket] * (1 << (self.depth - bits))

    def owners(self, tasks: int) -> list[int]:
        """An owner for each bucket: runs of neighbours with about as many rows each."""
        share, seen, out = max(1, sum(self.rows)) / tasks, 0, []
        for n in self.rows:
            out.append(min(tasks - 1, int((seen + n / 2) / share)))
            seen += n
        return out


def _collapse(batches: Iterator[pa.RecordBatch], text_at: int, id_at: int) -> Iterator[pa.RecordBatch]:
    """Rows with a row number, the number of their local group and, on its first row, the group's key and totals."""
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        rows = batch.column(0)
        texts = rows.field(text_at).cast(pa.binary()).to_pylist()
        ids = rows.field(id_at).to_pylist()
        first: dict[bytes, int] = {}
        group = []
        size = [0] * len(texts)
        top: list[tuple | None] = [None] * len(texts)
        for i, (text, doc) in enumerate(zip(texts, ids, strict=True)):
            g = first.setdefault(text.lower() if text else b"", i)
            group.append(number + g)
            size[g] += 1
            best = (doc is not None, doc or 0, -(number + i))
            if top[g] is None or best > top[g]:
                top[g] = best
        key: list[int | None] = [None] * len(texts)
        for text, g in first.items():
            key[g] = int.from_bytes(xxhash.xxh64_digest(text), "big", signed=True)
        row = pa.array([number + i for i in range(len(texts))], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                rows,
                row,
                pa.array(group, pa.int64()),
                pa.array(key, pa.int64()),
                pa.array([n if k is not None else None for n, k in zip(size, key, strict=True)], pa.int64()),
                pa.array([t[1] if t and t[0] else None for t in top], pa.int64()),
                pa.array([-t[2] if t else None for t in top], pa.int64()),
            ],
            names=[ROW, "row_no", "local_group", "key", "n", "top_id", "top_row"],
        )
        number += len(texts)


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in key order -> one index row per entry with the row that stays and the group's size."""
    names = ["bucket", "key", "chain", "local_group", "keep_id", "keep_row", "group_size", "text_sha256"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    at, chains, out = None, {}, []

    def close() -> None:
        for number, (text, entries) in enumerate(chains.items()):
            digest = hashlib.sha256(text).hexdigest()
            keep = max(entries, key=lambda e: (e[2] is not None, e[2] or 0, -e[3]))
            total = sum(e[1] for e in entries)
            out.extend((*at, number, e[0], keep[2], keep[3], total, digest) for e in entries)

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for bucket, key, text, *entry in zip(*columns, strict=True):
            if (bucket, key) != at:
                close()
                at, chains = (bucket, key), {}
            # the dictionary hashes the text once more and compares bytes on a match: equal keys alone prove nothing
            chains.setdefault(text, []).append(entry)
        if len(out) > 4096:
            yield flush()
            out.clear()
    close()
    yield flush()


INDEX = "bucket int, key long, chain int, local_group long, keep_id long, keep_row long, group_size long, text_sha256 string"


def index_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 16_384) -> tuple[DataFrame, DataFrame]:
    """Staged rows and their index, both written to the shared folder.

    Rows: ``doc`` (all columns), ``row_no``, ``local_group``; index: one row per local group. ``id_col`` is an
    integer column. Texts are equal when identical after lower-casing A-Z; null counts as empty.
    """
    spark = docs.sparkSession
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)
    rows = docs.withColumn(id_col, F.col(f"`{id_col}`").cast("long"))
    rows = wrapped(rows)
    columns = f"{schema_of(rows)}, row_no: long, local_group: long, key: long, n: long, top_id: long, top_row: long"
    staged = written(map_batches(rows, lambda batches: _collapse(batches, text_at, id_at), columns), "exact-rows")
    entries = staged.where(F.col("key").isNotNull())
    prefix = F.shiftrightunsigned("key", 64 - MAX_DEPTH).cast("int")
    counts = {r[0]: r[1] for r in entries.groupBy(prefix).count().collect()}  # at most 2**MAX_DEPTH rows
    directory = Directory(counts, bucket_rows)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    owners = directory.owners(tasks)
    slots = spark.createDataFrame(
        [(i, b, owners[b]) for i, b in enumerate(directory.slots)], "slot int, bucket int, owner int"
    )  # at most 2**MAX_DEPTH rows
    slot = F.shiftrightunsigned("key", 64 - directory.depth).cast("int") if directory.depth else F.lit(0)
    placed = (
        entries.withColumn("slot", slot)
        .join(F.broadcast(slots), "slot")
        .select("owner", "bucket", "key", ascii_lower(F.col(ROW)[text_col]).cast("binary").alias("text"), "local_group", "n", "top_id", "top_row")
        .repartitionById(tasks, "owner")
        .drop("owner")
        .sortWithinPartitions("bucket", "key")
    )
    return staged, written(map_batches(placed, _resolve, INDEX), "exact-index")


def with_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = 16_384) -> DataFrame:
    """Every row as ``doc``, with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of its class.

    Of equal texts the row with the largest id stays (null ids come last); of repeated rows with that id, one.
    The join is by local group, a group of at most one Arrow batch, so no text makes a key hot.
    """
    staged, index = index_documents(docs, id_col, text_col, bucket_rows)
    found = index.select("local_group", "keep_id", "keep_row", "group_size", "text_sha256")
    return staged.select(ROW, "row_no", "local_group").join(found, "local_group").select(
        ROW, "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), "text_sha256"
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with the columns they came with.

    Only the row numbers of the index travel; the rows that stay are found where they lie.
    """
    staged, index = index_documents(docs, id_col, text_col)
    stays = index.select(F.col("keep_row").alias("row_no")).distinct()
    kept = staged.join(stays, "row_no", "left_semi").select(f"{ROW}.*")
    return kept.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in docs.schema.fields])
