"""Row predicates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import day


def differs(c: Column, value) -> Column:
    """``c <> value`` that also keeps NULL."""
    return ~c.eqNullSafe(F.lit(value))


def matches_any(c: Column, patterns: list[str]) -> Column:
    """Case-blind LIKE against any of several patterns."""
    if not patterns:
        return F.lit(False)
    out = c.ilike(patterns[0])
    for p in patterns[1:]:
        out = out | c.ilike(p)
    return out


def on_day(column: str, d: date | str) -> Column:
    """Half-open range on a timestamp column, so the filter reaches the file scan."""
    start = F.lit(str(d)).cast("timestamp_ntz")
    return (F.col(column) >= start) & (F.col(column) < start + F.expr("INTERVAL 1 DAY"))


def stamp_on_day(column: str, d: date | str) -> Column:
    """14-digit text stamps of one day, as a prefix test that Parquet can use."""
    return F.col(column).startswith(str(d).replace("-", ""))


def valid_on(df: DataFrame, d: date | str, start: str = "start_date", end: str = "end_date") -> DataFrame:
    return df.where(day(d).between(F.col(start), F.col(end)))
