"""Token counts through a digest cache.

A count is stored under the digest of the content and the digest of the tokenizer: the tokenizer file's bytes and
the rules of encoding. Content digests are joined to the cache, misses are reduced to distinct texts, encoded,
and appended; then every row takes its count from the cache. Text travels only for misses: once per task and
distinct digest, compressed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.chunk_tokens import encoder, slices
from tallyloom.llm.common import ROW, map_batches
from tallyloom.session import path_exists

#: Part of the tokenizer digest; changes when the way of encoding does.
RULES = "null is empty; no added special tokens; no truncation; no padding"
SCHEMA = "tokenizer_digest string, content_digest binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer's file and the rules it is used by."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + RULES.encode()).hexdigest()


class Cache:
    """Stored counts: Parquet under a shared path, partitioned by tokenizer, append only.

    A run that is repeated after a failure appends the same counts again; readers take one of them.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def counts(self, digest: str) -> DataFrame | None:
        """(``content_digest``, ``n_tokens``) of one tokenizer, or None before the first append."""
        if not path_exists(self.spark, self.path):
            return None
        stored = self.spark.read.schema(SCHEMA).parquet(self.path).where(F.col("tokenizer_digest") == digest)
        return stored.groupBy("content_digest").agg(F.min("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, digest: str) -> None:
        rows = counts.select(F.lit(digest).alias("tokenizer_digest"), "content_digest", "n_tokens")
        rows.write.mode("append").partitionBy("tokenizer_digest").parquet(self.path)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First text of each digest in this task, compressed."""
    seen: set[bytes] = set()
    for batch in batches:
        digests, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
        new = [i for i, d in enumerate(digests) if d not in seen and not seen.add(d)]
        packed = [zlib.compress(texts[i].as_py(), 1) for i in new]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(new, pa.int64())), pa.array(packed, pa.binary())], names=["content_digest", "packed"])


def _encode(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    model = encoder(tokenizer, "counts")
    for batch in batches:
        texts = [zlib.decompress(p).decode() for p in batch.column(1).to_pylist()]
        counts = [n for run in slices(texts) for n in model.counts(run)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["content_digest", "n_tokens"])


def fill(texts: DataFrame, tokenizer: str, cache: Cache) -> DataFrame:
    """Encodes the misses among ``texts`` (``content_digest``, ``text``), appends them, and returns all stored counts."""
    digest = tokenizer_digest(tokenizer)
    local = map_batches(texts.select("content_digest", "text"), _distinct, "content_digest binary, packed binary")
    stored = cache.counts(digest)
    missing = local if stored is None else local.join(stored, "content_digest", "left_anti")
    missing = missing.groupBy("content_digest").agg(F.first("packed").alias("packed"))
    cache.append(map_batches(missing, lambda b: _encode(b, tokenizer), "content_digest binary, n_tokens long"), digest)
    return cache.counts(digest)


def with_counts(docs: DataFrame, tokenizer: str, cache: Cache, text_col: str = "text") -> DataFrame:
    """Every row as ``doc`` with ``n_bytes`` (UTF-8) and ``n_tokens`` of its whole text; null counts as empty.

    A digest may belong to many rows; the join is an equi-join that adaptive execution splits where it is skewed.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256)).alias("content_digest")
    stored = fill(docs.select(digest, text.alias("text")), tokenizer, cache)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias(ROW)
    rows = docs.select(row, F.octet_length(text).cast("long").alias("n_bytes"), digest)
    return rows.join(stored, "content_digest").select(ROW, "n_bytes", "n_tokens")
