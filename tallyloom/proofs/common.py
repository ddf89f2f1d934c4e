"""Shared spellings, so that a proof and its oracle round and sum the same way."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.numbers import exact_sum

AS_OF = "2024-01-15"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(c: str | Column) -> Column:
    return exact_sum(col(c))


def net_total(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """Sum of price less discount; the product of two 2-decimal numbers has four decimals."""
    net = F.col(price).cast("decimal(18,2)") * (F.lit(1).cast("decimal(3,2)") - F.col(discount).cast("decimal(3,2)"))
    return exact_sum(net, 4)


def r6(c: Column) -> Column:
    return F.round(c, 6)


def sql_total(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def ship_day() -> Column:
    return F.to_date("l_shipdate")


def order_day() -> Column:
    return F.to_date("o_orderdate")


def event_day() -> Column:
    return F.to_date("ts")


def wall_time(ts: Column) -> Column:
    """A timestamp without zone, as the test tables hold them."""
    return ts.cast("timestamp_ntz")
