"""Arrays, key-value records and structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def kv_lookup(pairs: Column, key: str) -> Column:
    """Value of the first ``{key, value}`` record with this key, NULL when there is none."""
    return F.get(F.filter(pairs, lambda p: p["key"] == key), F.lit(0))["value"]


def pack(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def kth_smallest(values: Column, k: int) -> Column:
    """k-th (from 0) smallest element of a short array, NULL when there are fewer."""
    return F.get(F.sort_array(values), F.lit(k))


def start_of_last_run(days: Column) -> Column:
    """First day of the latest unbroken run in a short array of days."""
    ordered = F.array_sort(F.array_distinct(days))
    starts = F.filter(ordered, lambda d: ~F.array_contains(ordered, F.date_sub(d, 1)))
    return F.array_max(starts)
