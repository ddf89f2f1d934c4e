"""Session settings and the few places where an operator needs to look at the session."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType


def build_session(app: str = "tallyloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    On a cluster the master, memory and shuffle width come from spark-submit; only settings
    that change results (time zone) or plan quality (AQE) are fixed here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    A cluster names it in ``spark.checkpoint.dir``; without it there is no folder that all executors see, which
    is an error. Only in local mode (one process, as in tests) a temporary folder is made, and kept as the session's
    checkpoint folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
        root = context.getCheckpointDir()
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the scratch root that nothing has written to yet."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def broadcast_days(df: DataFrame, column: str) -> DataFrame:
    """Broadcast the distinct days of a date column: a calendar, so a few thousand rows at most.

    The comparison holds for every day of the last twelve thousand years; NULL days, which match nothing, are all that it takes
    out. It tells the optimizer that the days may be used to prune the partitions of the other side at run time.
    """
    if df.schema[column].dataType != DateType():
        raise TypeError(f"{column} is not a date")
    days = df.where(F.col(column) >= F.lit("-9999-01-01").cast("date"))
    return F.broadcast(days.select(column).distinct())


def broadcast_within(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Ask for a broadcast of ``df`` if the optimizer's estimate of its size is within ``max_bytes``.

    Only the estimate is read, nothing is run. It fits scans with filters and projections; a frame whose rows multiply
    on the way is better left to adaptive execution.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= max_bytes else df


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object of a path, whatever storage it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)
