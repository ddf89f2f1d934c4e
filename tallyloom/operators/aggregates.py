"""Aggregations beyond a plain ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_if(condition: Column, identity: Column) -> Column:
    """COUNT(DISTINCT identity) over the rows where ``condition`` holds."""
    return F.count_distinct(F.when(condition, identity))


def distinct_flags(
    df: DataFrame, keys: list[str], identity: list[str], flags: dict[str, Column]
) -> DataFrame:
    """Several conditional distinct counts of one identity.

    Two plain aggregates (any row of the identity has the flag, then count) instead of one copy of
    the rows per distinct expression.
    """
    once = df.groupBy(*keys, *identity).agg(*[F.max(F.when(c, 1).otherwise(0)).alias(n) for n, c in flags.items()])
    return once.groupBy(*keys).agg(*[F.sum(n).cast("bigint").alias(n) for n in flags])


def zero_fill(df: DataFrame, entities: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """A row for every entity; absent measures are zero."""
    return entities.join(df, keys, "left").select(*keys, *[F.coalesce(m, F.lit(0)).alias(m) for m in measures])


#: Ranks of a quantile sketch are off by at most one in ``ACCURACY``; brackets reach three times as far to either side.
ACCURACY = 10_000


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], few_values: bool = False, accuracy: int = ACCURACY
) -> DataFrame:
    """Exact linearly interpolated percentiles per group (or of the whole, without keys).

    ``few_values`` says that a group has a bounded number of distinct values (whole quantities, weeks
    of a calendar): then one aggregate does it, whose state per group is a count per value.

    Otherwise no task holds a group. A mergeable quantile sketch per group, combined on the map side, brackets the values at
    the wanted ranks. A second pass counts: rows inside a bracket by value, all others only by the gap between brackets that they lie in, so that a
    group shrinks to a few thousandths of its values before it is shuffled. The running count over what is left gives the ranks, and the rows at
    the wanted ones are picked. Groups too small for a sketch to be sure (twice ``accuracy`` rows) are counted by value as a whole.
    """
    rows = df.where(F.col(value).isNotNull())
    if few_values:
        wanted = F.percentile(value, F.array(*[F.lit(p) for p in probabilities.values()])).alias("_p")
        picked = rows.groupBy(*keys).agg(wanted)
        return picked.select(*keys, *[F.col("_p")[i].alias(n) for i, n in enumerate(probabilities)])
    reach, names = 3.0 / accuracy, list(probabilities)
    edges = [e for p in probabilities.values() for e in (max(0.0, p - reach), min(1.0, p + reach))]
    sketch = [F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), F.percentile_approx(value, edges, accuracy).alias("at")]
    bounds = rows.groupBy(*keys).agg(*sketch)
    bound = F.struct("n", "low", "high", "at")
    if keys:
        at = F.struct(*keys).alias("_at")  # equal structs may hold NULL keys
        # hashed brackets, so that a task streams its rows; a sort-merge join would sort all rows of a group in one task
        met = rows.select(*keys, F.col(value).alias("_v"), at).join(bounds.select(at, bound.alias("_b")).hint("shuffle_hash"), "_at")
    else:
        met = rows.select(F.col(value).alias("_v"), bounds.select(bound).scalar().alias("_b"))
    v, b = F.col("_v"), F.col("_b")
    small = b["n"] <= 2 * accuracy
    lows = [F.when(small, b["low"]).otherwise(b["at"][2 * i]) for i in range(len(names))]
    highs = [F.when(small, b["high"]).otherwise(b["at"][2 * i + 1]) for i in range(len(names))]
    inside = reduce(lambda x, y: x | y, [v.between(lo, hi) for lo, hi in zip(lows, highs, strict=True)])
    # values that lie above the same brackets are in one zone; in it those outside of all brackets come first
    zone = reduce(lambda x, y: x + y, [(v > hi).cast("int") for hi in highs])
    counts = met.select(*keys, zone.alias("_zone"), F.when(inside, v).alias("_v")).groupBy(*keys, "_zone", "_v").agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_zone", F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumns({"_upto": F.sum("_n").over(upto), "_total": F.sum("_n").over(group)})

    def position(p: float) -> Column:
        return (F.col("_total") - 1) * F.lit(p)

    def at_rank(where: Column) -> Column:
        here = (F.col("_upto") - F.col("_n") <= where) & (where < F.col("_upto"))
        missed = F.raise_error(F.lit(f"a bracket of {value} misses its rank")).cast(df.schema[value].dataType)
        return F.max(F.when(here, F.coalesce("_v", missed)))

    picks = []
    for name, p in probabilities.items():
        picks += [at_rank(F.floor(position(p))).alias(f"_l_{name}"), at_rank(F.ceil(position(p))).alias(f"_u_{name}")]
    picked = ranked.groupBy(*keys).agg(F.first("_total").alias("_total"), *picks)
    out = []
    for name, p in probabilities.items():
        low, high = F.col(f"_l_{name}"), F.col(f"_u_{name}")
        out.append((low + (high - low) * (position(p) - F.floor(position(p)))).alias(name))
    return picked.select(*keys, *out)


@dataclass(frozen=True)
class MeasureSet:
    """Measures of the rows that meet a condition, at keys worked out from the row; ``measures`` maps a name to (aggregate, column)."""

    at: dict[str, Column]
    where: Column
    measures: dict[str, tuple[Callable[[Column], Column], Column]]


def merged_measures(fact: DataFrame, keys: list[str], sets: list[MeasureSet]) -> DataFrame:
    """Measure sets of one fact as one wide row per key, like aggregates of each set merged by full joins, from one scan and one aggregate.

    A row of the fact is repeated only for sets that see it at different keys (a ship day and an order day). Measures of a set that has no row at a key are NULL.
    """
    places: list[dict[str, Column]] = []
    for s in sets:
        if not any(s.at is p for p in places):
            places.append(s.at)
    tagged = []
    for place in places:
        fields = [place[k].alias(k) for k in keys]
        for i, s in enumerate(sets):
            met = F.coalesce(s.where, F.lit(False)) if s.at is place else F.lit(False)
            fields.append(met.alias(f"_met{i}"))
            fields += [F.when(met, column).alias(name) for name, (_, column) in s.measures.items()]
        seen = reduce(lambda a, b: a | b, [F.coalesce(s.where, F.lit(False)) for s in sets if s.at is place])
        tagged.append([*fields, seen.alias("_seen")])
    rows = fact.select(*tagged[0]) if len(tagged) == 1 else fact.select(F.inline(F.array(*[F.struct(*fields) for fields in tagged])))
    rows = rows.where("_seen")
    aggregates = [agg(F.col(name)).alias(name) for s in sets for name, (agg, _) in s.measures.items()]
    merged = rows.groupBy(*keys).agg(*[F.count_if(f"_met{i}").alias(f"_n{i}") for i in range(len(sets))], *aggregates)
    return merged.select(*keys, *[F.when(F.col(f"_n{i}") > 0, F.col(name)).alias(name) for i, s in enumerate(sets) for name in s.measures])


def leveled(df: DataFrame, levels: dict[str, tuple[Column, Column]], level: str = "level", key: str = "level_key") -> DataFrame:
    """Each row once per level that it belongs to: ``levels`` maps a name to (condition, key as text). One scan serves all levels, and the
    aggregate that follows needs one shuffle."""
    tags = [F.struct(F.coalesce(where, F.lit(False)).alias("_in"), F.lit(name).alias(level), k.cast("string").alias(key)) for name, (where, k) in levels.items()]
    placed = df.where(reduce(lambda a, b: a | b, [where for where, _ in levels.values()]))  # reaches the scan
    return placed.select("*", F.inline(F.array(*tags))).where("_in").drop("_in")


def sum_with_latest(
    df: DataFrame, keys: list[str], sums: dict[str, Column], attributes: list[str], order: list[str]
) -> DataFrame:
    """Sums per key together with the attributes of the key's newest row, in one shuffle."""
    newest = F.max_by(F.struct(*attributes), F.struct(*order)).alias("_latest")
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in sums.items()], newest).select(*keys, *sums, "_latest.*")


def kth_per_group(df: DataFrame, keys: list[str], value: str, names: list[str]) -> DataFrame:
    """The 1st, 2nd, .. smallest value per group as columns; only that many rows per group move."""
    w = Window.partitionBy(*keys).orderBy(value)
    top = df.select(*keys, value).withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= len(names))
    return top.groupBy(*keys).agg(*[F.max(F.when(F.col("_k") == i + 1, F.col(value))).alias(n) for i, n in enumerate(names)])
