"""Stock: running balances carried to every day, first-in-first-out aging, rolling unit cost."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.dates import day
from tallyloom.functions.numbers import least_positive
from tallyloom.operators.windows import trailing_sums


def balance_from_movements(
    movements: DataFrame,
    keys: list[str],
    move_day: str,
    quantity: str,
    last: date | str,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Balance of every day from movements and an opening balance.

    Movements are summed per key and day, so a key's window is no longer than the calendar. Each
    balance holds until the key's next movement, which makes it a period that is repeated per day; no
    range join is needed. A zero balance is written once only, on the first day of the first period
    whose whole-number part is zero, and so is not repeated at all.
    """
    moved = movements.select(*keys, move_day, quantity)
    if opening is not None:
        moved = moved.unionByName(opening.select(*keys, move_day, quantity))
    daily = moved.where(F.col(move_day) <= day(last)).groupBy(*keys, move_day).agg(F.sum(quantity).alias("_m"))
    w = Window.partitionBy(*keys).orderBy(move_day)
    running = F.round(F.sum("_m").over(w.rowsBetween(Window.unboundedPreceding, 0)), 3)
    until = F.coalesce(F.date_sub(F.lead(move_day).over(w), 1), day(last))
    periods = daily.select(*keys, F.col(move_day).alias("_from"), running.alias("balance"), until.alias("_to"))
    small = F.col("balance").cast("bigint") == 0
    first_small = F.min(F.when(small, F.col("_from"))).over(Window.partitionBy(*keys))
    kept = periods.withColumn("_first", first_small).where((F.col("balance") != 0) | (F.col("_from") == F.col("_first")))
    end = F.when(F.col("balance") == 0, F.col("_from")).otherwise(F.col("_to"))
    return kept.select(*keys, F.explode(F.sequence("_from", end)).alias("calday"), "balance")


def balances_from_movements(
    movements: DataFrame,
    keys: list[str],
    move_day: str,
    measures: dict[str, int | None],
    first: date | str,
    last: date | str,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Balances of several measures, such as quantity and value, for every day from ``first`` to ``last``.

    ``measures`` names the movement columns and the digits that each balance is rounded to (None: as summed). All measures are summed in one
    aggregate and one window; a period is a run of days with equal balances of all of them. Days on which all are zero are left out, but
    for the first day on which the rounded balances are all zero. ``opening`` has the balances of a day before ``first``.
    """
    moved = movements.select(*keys, move_day, *measures)
    if opening is not None:
        moved = moved.unionByName(opening.select(*keys, move_day, *measures))
    daily = moved.where(F.col(move_day) <= day(last)).groupBy(*keys, move_day).agg(*[F.sum(m).alias(m) for m in measures])
    w = Window.partitionBy(*keys).orderBy(move_day)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    running = {m: F.sum(m).over(upto) if digits is None else F.round(F.sum(m).over(upto), digits) for m, digits in measures.items()}
    until = F.coalesce(F.date_sub(F.lead(move_day).over(w), 1), day(last))
    periods = daily.select(*keys, F.greatest(F.col(move_day), day(first)).alias("_from"), until.alias("_to"), *[c.alias(m) for m, c in running.items()])
    periods = periods.where("_from <= _to")
    nothing = reduce(lambda a, b: a & b, [F.col(m) == 0 for m in measures])
    small = reduce(lambda a, b: a & b, [F.round(F.col(m), 0) == 0 for m in measures])
    first_small = F.min(F.when(small, F.col("_from"))).over(Window.partitionBy(*keys))
    kept = periods.withColumn("_first", first_small).where(~nothing | (F.col("_from") == F.col("_first")))
    end = F.when(nothing, F.col("_from")).otherwise(F.col("_to"))
    return kept.select(*keys, F.explode(F.sequence("_from", end)).alias("calday"), *measures)


EPS = 0.001  # fixed value: quantities and values at or below this are treated as nothing
OLDEST_AGE = 721  # fixed value: age in days given to stock no receipt explains


def fifo_aging(
    stock: DataFrame,
    receipts: DataFrame,
    keys: list[str],
    as_of: date | str,
    bands: list[tuple[str, int, int]],
    oldest: str,
) -> DataFrame:
    """Closing stock allocated to receipts, newest first, with the age band of each part.

    ``stock`` has ``keys, stock_qty, stock_value``; ``receipts`` has ``keys, gr_date, gr_qty, gr_value``
    and is summed per day first. ``bands`` lists ``(id, above, up to)`` over the age in days plus one.
    Stock that receipts do not explain goes to the band ``oldest``: quantity with its value as round 2,
    value alone as round 3.
    """
    daily = receipts.groupBy(*keys, "gr_date").agg(F.sum("gr_qty").alias("gr_qty"), F.sum("gr_value").alias("gr_value"))
    age = F.datediff(day(as_of), F.col("gr_date"))
    band = reduce(lambda c, b: c.when((age + 1 > b[1]) & (age + 1 <= b[2]), b[0]), bands, F.when(F.lit(False), ""))
    aged = daily.withColumns({"aging_days": age, "band_id": band}).where(F.col("band_id").isNotNull() & (F.col("gr_qty") > 0))
    newest_first = Window.partitionBy(*keys).orderBy("aging_days")
    upto = newest_first.rowsBetween(Window.unboundedPreceding, 0)
    run = aged.withColumns({"_q": F.sum("gr_qty").over(upto), "_v": F.sum("gr_value").over(upto)}).withColumns(
        {"_q_before": F.col("_q") - F.col("gr_qty"), "_v_before": F.col("_v") - F.col("gr_value")}
    )
    met = stock.join(run, keys, "left")

    def share(total: str, before: str, own: str) -> Column:
        left = F.col(total) - F.coalesce(F.col(before), F.lit(0.0))
        return F.when(F.col(own).isNull(), F.col(total)).when(left > 0, F.least(left, F.col(own))).otherwise(0.0)

    value = F.when(F.col("stock_value") < 0, F.col("stock_value")).otherwise(share("stock_value", "_v_before", "gr_value"))
    shared = met.select(
        *keys,
        "gr_date",
        F.coalesce("aging_days", F.lit(OLDEST_AGE)).alias("aging_days"),
        F.coalesce("band_id", F.lit(oldest)).alias("band_id"),
        share("stock_qty", "_q_before", "gr_qty").alias("aging_qty"),
        value.alias("aging_value"),
        "stock_qty",
        "stock_value",
    )

    def something(c: Column) -> Column:
        return F.round(c, 3) > EPS

    # what the first round leaves per key decides rounds two and three together; a key has at most one row per receipt day
    whole = Window.partitionBy(*keys)
    given = F.coalesce(something(F.col("aging_qty")) | something(F.col("aging_value")), F.lit(False))
    shared = shared.withColumn("_given", given).withColumns(
        {
            "_gq": F.sum(F.when(F.col("_given"), F.col("aging_qty"))).over(whole),
            "_gv": F.sum(F.when(F.col("_given"), F.col("aging_value"))).over(whole),
            "_last": F.row_number().over(whole.orderBy(F.desc("aging_days"))) == 1,
        }
    )
    rest_qty, rest_value = F.col("stock_qty") - F.col("_gq"), F.col("stock_value") - F.col("_gv")
    short = F.round("stock_qty", 3) > F.round("_gq", 3)
    second = F.coalesce(short & (something(rest_qty) | something(rest_value)), F.lit(False))
    third = ~second & something(rest_value)

    def part(when: Column, gr_date: Column, age: Column, band: Column, flag: Column, qty: Column, value: Column) -> Column:
        fields = {"gr_date": gr_date, "aging_days": age, "band_id": band, "flag": flag, "aging_qty": qty, "aging_value": value}
        return F.when(when, F.struct(*[c.alias(n) for n, c in fields.items()]))

    parts = F.array(
        part(F.col("_given"), *map(F.col, ("gr_date", "aging_days", "band_id")), F.lit(1), F.col("aging_qty"), F.col("aging_value")),
        part(
            F.col("_last") & (second | third),
            F.lit(None).cast("date"),
            F.lit(OLDEST_AGE),
            F.lit(oldest),
            F.when(second, 2).otherwise(3),
            F.when(second, rest_qty).otherwise(0.0),
            rest_value,
        ),
    )
    return shared.select(*keys, F.inline(F.filter(parts, lambda p: p.isNotNull())))


def aging_cluster(aged: DataFrame, group: list[str], site: str, old_bands: list[str]) -> DataFrame:
    """How widely old stock is spread over the sites of a group: No, Local, Local - Regional, Regional.

    ``old_bands`` names the bands that count as old.
    """
    once = aged.groupBy(*group, site).agg(F.max(F.col("band_id").isin(*old_bands).cast("int")).alias("_old"))
    spread = once.groupBy(*group).agg(F.sum("_old").alias("_n_old"), F.count("*").alias("_n"))
    label = (
        F.when(F.col("_n_old") == 0, "No")
        .when(F.col("_n_old") < F.lit(0.33) * F.col("_n"), "Local")
        .when(F.col("_n_old") > F.lit(0.67) * F.col("_n"), "Regional")
        .otherwise("Local - Regional")
    )
    return spread.select(*group, label.alias("aging_cluster"))


def remaining_shelf_life(shelf_life: Column, origin: Column, aging_days: Column, local: float, imported: float) -> Column:
    """Days left of the share of shelf life that an item of this origin may use."""
    share = F.when(origin == "VN", F.lit(local)).otherwise(F.lit(imported))
    return F.greatest(shelf_life * share - aging_days, F.lit(0.0))


def rolling_cost(
    costs: DataFrame, keys: list[str], cost_day: str, cost: str, qty: str, horizons: list[int], last: date | str
) -> DataFrame:
    """Trailing cost and quantity sums for every day that has any cost in the longest horizon.

    Costs are summed per key and day; the unit value takes the shortest horizon with a quantity.
    """
    daily = costs.groupBy(*keys, cost_day).agg(F.sum(cost).alias("cost"), F.sum(qty).alias("qty"))
    rolled = trailing_sums(daily, keys, cost_day, ["cost", "qty"], horizons, "calday", day(last))
    unit = F.coalesce(*[unit_cost(f"cost_{h}d", f"qty_{h}d") for h in sorted(horizons)])
    return rolled.withColumn("unit_value", unit)


def unit_cost(cost: str, qty: str) -> Column:
    return F.try_divide(F.col(cost).cast("double"), F.round(F.col(qty).cast("double"), 3))


def least_positive_cost(rows: DataFrame, names: list[str]) -> DataFrame:
    """Least positive of several unit costs of a row, as ``cost_per_unit``; absent ones count as zero.

    A day's own cost is the trailing cost of one day, so ``rolling_cost`` with a horizon of 1 gives it along with the longer ones.
    """
    filled = rows.withColumns({n: F.coalesce(F.col(n), F.lit(0.0)) for n in names})
    return filled.withColumn("cost_per_unit", least_positive(*[F.col(n) for n in names]))
