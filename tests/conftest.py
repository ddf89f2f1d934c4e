import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tallyloom-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect


@pytest.fixture
def skewed(spark):
    """Events of 20 keys over 10 days in which one key holds a third of all rows."""
    from pyspark.sql import functions as F

    base = spark.range(3000).withColumn("key", F.when(F.col("id") < 1000, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(20))))
    mixed = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1000))
    return base.select(
        F.col("key").cast("int").alias("key"),
        F.date_add(F.lit("2024-01-01").cast("date"), (mixed % 10).cast("int")).alias("day"),
        "id",
        (mixed / 4).alias("value"),
    )
