"""What several operators share: written intermediates, the held-out rule and a row wrapper."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import fresh_dir

ROW = "doc"


def written(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written once under the shared scratch folder and read back.

    Cuts the lineage with a copy that outlives lost executors. Zstandard keeps it small.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def wrapped(df: DataFrame) -> DataFrame:
    """All columns as one struct, so that no name can clash with a column an operator adds."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW))


def unwrapped(df: DataFrame) -> DataFrame:
    """The columns that ``wrapped`` put away."""
    return df.select(f"{ROW}.*")


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver found it, if nothing else tells them."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", root)
    return df.mapInArrow(fn, schema)


def schema_of(df: DataFrame) -> str:
    """The columns of ``df`` as DDL."""
    return df.schema.simpleString()[len("struct<") : -1]


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; the rule that holds documents out. A null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Bits of the array that ``may_hold`` broadcasts: 8 MB, whatever the number of keys.
SLOTS = 1 << 26


def may_hold(rows: DataFrame, key: str, keys: DataFrame) -> Column:
    """A condition on ``rows`` that is true where the long column ``key`` is among those of ``keys``, and seldom elsewhere.

    A bit per hash of a key, of a fixed number of bits, is broadcast. It spares wide rows a shuffle before an exact join; with so many keys that
    most bits are set it spares little, and the join is as right as ever.
    """

    def slot(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(SLOTS))

    at = slot(F.col(key))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    words = keys.select((at / 64).cast("int").alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    held = np.zeros(SLOTS // 64, np.int64)  # at most SLOTS / 64 rows come here
    held[words["word"].to_numpy()] = words["bits"].to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(held)

    @F.pandas_udf("boolean")
    def found(slots: pd.Series) -> pd.Series:
        places = slots.to_numpy()
        return pd.Series((shared.value[places >> 6] >> (places & 63) & 1).astype(bool))

    return found(at)
