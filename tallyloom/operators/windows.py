"""Row picks, running values and neighbours, written so that one hot key does not mean one hot task.

* picks of the first row(s) per key filter on a rank, which Spark applies before the shuffle too;
* "latest attribute", "share of total" and "best priority" are aggregates with map-side combine;
* running sums and neighbours over raw rows work per (key, segment), where the segment is a bounded
  slice such as a day, and only one row per segment crosses from slice to slice.

Rows under a NULL key form a group of their own, as in SQL windows. Where an aggregate is joined back, the join key
is a struct of the key columns: structs are equal when their fields are, NULLs included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_first(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key. ``order`` must break ties."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def latest(df: DataFrame, keys: list[str], order: list[str], columns: list[str] | None = None) -> DataFrame:
    """Columns of the newest row per key, as an aggregate."""
    cols = columns or [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*cols), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(newest).select(*keys, "_r.*")


def keep_best(df: DataFrame, keys: list[str], by: str, largest: bool = False) -> DataFrame:
    """Every row that ties with the best ``by`` of its key."""
    best = df.groupBy(*keys).agg((F.max if largest else F.min)(by).alias(by))
    at = F.struct(*keys, by).alias("_at")
    return df.withColumn("_at", at).join(best.select(at), "_at", "left_semi").drop("_at")


def share_of_total(df: DataFrame, keys: list[str], value: str, out: str, total: str = "total") -> DataFrame:
    at = F.struct(*keys).alias("_at")
    totals = df.groupBy(*keys).agg(F.sum(value).alias(total)).select(at, total)
    joined = df.withColumn("_at", at).join(totals, "_at").drop("_at")
    return joined.withColumn(out, F.try_divide(F.col(value), F.col(total)))


def running_sum(
    df: DataFrame, keys: list[str], segment: str, order: list[str], value: str, out: str
) -> DataFrame:
    """Running sum over (segment, order) per key; ``order`` must be unique within a segment."""
    before = Window.partitionBy(*keys).orderBy(segment).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*keys, segment).agg(F.sum(value).alias("_s"))
        .select(F.struct(*keys, segment).alias("_at"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_at").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("_at", F.struct(*keys, segment)).withColumn("_in", F.sum(value).over(inside))
    return local.join(offsets, "_at").withColumn(out, F.col("_before") + F.col("_in")).drop("_at", "_before", "_in")


def neighbours(
    df: DataFrame,
    keys: list[str],
    segment: str,
    order: list[str],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
) -> DataFrame:
    """``lag`` / ``lead`` by one row over (segment, order) per key.

    ``previous`` and ``following`` map an output name to the column whose neighbour value it takes.
    """
    previous, following = previous or {}, following or {}
    taken = sorted(set(previous.values()) | set(following.values()))
    edge = F.struct(*order)
    edges = df.groupBy(*keys, segment).agg(
        F.max_by(F.struct(*taken), edge).alias("_hi"), F.min_by(F.struct(*taken), edge).alias("_lo")
    )
    across = Window.partitionBy(*keys).orderBy(segment)
    edges = edges.select(
        F.struct(*keys, segment).alias("_at"), F.lag("_hi").over(across).alias("_prev"), F.lead("_lo").over(across).alias("_next")
    )
    inside = Window.partitionBy("_at").orderBy(*order)
    local = df.withColumn("_at", F.struct(*keys, segment)).withColumns(
        {"_lag": F.lag(F.struct(*taken)).over(inside), "_lead": F.lead(F.struct(*taken)).over(inside)}
    )
    joined = local.join(edges, "_at").drop("_at")
    out = {n: F.coalesce("_lag", "_prev")[c] for n, c in previous.items()}
    out |= {n: F.coalesce("_lead", "_next")[c] for n, c in following.items()}
    return joined.withColumns(out).drop("_lag", "_lead", "_prev", "_next")


def trailing_sum(
    daily: DataFrame, keys: list[str], day: str, value: str, out: str, days: int
) -> DataFrame:
    """Sum over the last ``days`` calendar days of a frame with one row per key and day."""
    n = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*keys).orderBy(n).rangeBetween(-(days - 1), 0)
    return daily.withColumn(out, F.sum(value).over(w))


QUOTA_SLICES = 32


def top_by_quota(
    df: DataFrame, keys: list[str], order: list[Column], quota: str
) -> DataFrame:
    """First rows per key up to the row's own quota column.

    Nothing runs while the plan is built. A hot key is spread first: within each of its slices no row beyond the row's own quota can be within it
    over the whole key, so slices are cut before the rows of a key meet.
    """
    slices = F.pmod(F.monotonically_increasing_id(), F.lit(QUOTA_SLICES))
    sliced = df.withColumn("_slice", slices)
    local = F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*order))
    cut = sliced.withColumn("_rn", local).where(F.col("_rn") <= F.col(quota)).drop("_rn", "_slice")
    ranked = cut.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") <= F.col(quota)).drop("_rn")


def trailing_sums(
    daily: DataFrame, keys: list[str], day: str, measures: list[str], horizons: list[int], out: str, last: Column
) -> DataFrame:
    """Sums over the last h calendar days, for every h and every day with a row in the longest horizon.

    ``daily`` has one row per key and day. A trailing sum only changes when a day enters or leaves its
    window, so each row becomes one entry and one exit per horizon; the running sum of these changes
    holds until the next change and is then repeated per day. Nothing is multiplied by the length of a
    horizon, and days without rows get their sums too. Measures should be whole or decimal: entries and
    exits then cancel exactly. Results are named ``measure_{h}d``.
    """
    longest = max(horizons)
    names = [f"{m}_{h}d" for h in horizons for m in measures]

    def change(offset: int, sign: int, of: list[int]) -> Column:
        sums = [
            (F.col(m) * sign if h in of else F.lit(None).cast(daily.schema[m].dataType)).alias(f"{m}_{h}d")
            for h in horizons
            for m in measures
        ]
        present = F.lit(sign if longest in of else 0).alias("_n")
        return F.struct(F.date_add(F.col(day), offset).alias("_at"), present, *sums)

    changes = [change(0, 1, horizons), *[change(h, -1, [h]) for h in horizons]]
    moved = daily.select(*keys, F.inline(F.array(*changes))).where(F.col("_at") <= last)
    per_day = moved.groupBy(*keys, "_at").agg(F.sum("_n").alias("_n"), *[F.sum(n).alias(n) for n in names])
    w = Window.partitionBy(*keys).orderBy("_at")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    until = F.coalesce(F.date_sub(F.lead("_at").over(w), 1), last)
    running = per_day.select(
        *keys, "_at", until.alias("_to"), F.sum("_n").over(upto).alias("_n"), *[F.sum(n).over(upto).alias(n) for n in names]
    )
    live = running.where(F.col("_n") > 0)
    return live.select(*keys, F.explode(F.sequence("_at", "_to")).alias(out), *names)
