"""Sales statistics: lead times, percentile bounds, outlier correction, seasonality, sell rate, bundles."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.dates import day
from tallyloom.functions.numbers import clamp
from tallyloom.operators.aggregates import exact_percentiles
from tallyloom.session import broadcast_days

MIN_LEADTIME, MAX_LEADTIME = 2, 10  # fixed values: shortest gap that counts, longest lead time reported


def leadtime_stats(df: DataFrame, keys: list[str], ordered: Column, received: Column) -> DataFrame:
    """Mean, spread and quartiles of the days from order to receipt, in one aggregate.

    Gaps are whole days, so the exact quartiles (a value that occurs) hold one count per distinct gap.
    """
    gap = F.datediff(received, ordered)
    gaps = df.select(*keys, gap.alias("_gap")).where(F.col("_gap") >= MIN_LEADTIME)
    mean = F.avg("_gap")
    quartiles = [
        F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY _gap)").cast("int").alias(f"q{i}_leadtime") for i, p in enumerate((0.25, 0.5, 0.75), 1)
    ]
    return gaps.groupBy(*keys).agg(
        clamp(F.ceil(mean), MIN_LEADTIME, MAX_LEADTIME).cast("bigint").alias("leadtime"),
        mean.alias("avg_leadtime"),
        F.min("_gap").alias("min_leadtime"),
        F.max("_gap").alias("max_leadtime"),
        F.coalesce(F.stddev_samp("_gap"), F.lit(0.0)).alias("stddev_leadtime"),
        *quartiles,
    )


def upper_bounds(sales: DataFrame, keys: list[str], value: str, sale_day: str, excluded_days: DataFrame) -> DataFrame:
    """80/85/90/95th percentile of positive sales per group, without the excluded days.

    Measured weights may be any number, so no bound on the distinct values of a group is assumed.
    """
    kept = sales.where(F.col(value) > 0).join(broadcast_days(excluded_days, sale_day), sale_day, "left_anti")
    wanted = {"pct_80": 0.8, "pct_85": 0.85, "pct_90": 0.9, "pct_95": 0.95}
    return exact_percentiles(kept, keys, value, wanted)


def bom_explode(sales: DataFrame, bom: DataFrame, keys: list[str], item: str, qty: str) -> DataFrame:
    """Sales per item with bundle sales added to their components by component ratio.

    ``bom`` has ``item, component_id, component_quantity, base_quantity``. The bundle's own row stays.
    Sales are multiplied out row by row, and one aggregate with map-side combine sums the bundles' own rows and the components.
    """
    ratio = F.col("component_quantity") / F.col("base_quantity")
    parts = sales.join(bom, item).select(*keys, F.col("component_id").alias(item), (F.col(qty) * ratio).alias(qty))
    return sales.select(*keys, item, qty).unionByName(parts).groupBy(*keys, item).agg(F.sum(qty).alias(qty))


def sell_rate(
    history: DataFrame,
    keys: list[str],
    value: str,
    sale_day: str,
    as_of: date | str,
    horizons: tuple[int, int, int],
    note: str | None = None,
) -> DataFrame:
    """Means over three trailing horizons and the trend short / middle, in one conditional aggregate.

    ``history`` has one row per key and day up to the day before ``as_of``. The rate is the middle mean,
    or zero for a key whose ``note`` of yesterday says that it is inactive; a trend of zero or without
    a middle mean counts as 1.
    """
    short, middle, long = horizons
    d = F.col(sale_day)

    def mean(days: int) -> Column:
        return F.avg(F.when(d >= F.date_sub(day(as_of), days), F.coalesce(F.col(value), F.lit(0.0))))

    recent = history.where((d >= F.date_sub(day(as_of), long)) & (d < day(as_of)))
    yesterday = F.lit(None).cast("string") if note is None else F.max(F.when(d == F.date_sub(day(as_of), 1), F.col(note)))
    means = recent.groupBy(*keys).agg(
        mean(short).alias("ma_short"), mean(middle).alias("ma_middle"), mean(long).alias("ma_long"), yesterday.alias("_note")
    )
    trend = F.when(F.coalesce(F.col("ma_middle"), F.lit(0.0)) == 0, 0.0).otherwise(F.col("ma_short") / F.col("ma_middle"))
    rate = F.when(F.col("_note") == INACTIVE_NOTE, 0.0).otherwise(F.col("ma_middle"))
    return means.withColumns(
        {"sell_rate": rate, "sale_trend": F.when(F.coalesce(trend, F.lit(0.0)) == 0, 1.0).otherwise(trend)}
    ).drop("_note")


def iso_week_key(on: date | str) -> Column:
    """``yyyy.ww`` of a day's ISO week. The year is the week's, so that the days around New Year that share a week share its key."""
    d = day(on)
    year, week = (F.extract(F.lit(part), d).cast("string") for part in ("YEAROFWEEK", "WEEK"))
    return F.concat(year, F.lit("."), F.lpad(week, 2, "0"))


def with_seasonality(rates: DataFrame, index: DataFrame, keys: list[str], as_of: date | str) -> DataFrame:
    """``rates`` with the ``seasonality_index`` that applies to the week of ``as_of``, 1 where there is none.

    ``index`` is what ``seasonality_index`` gives: ``keys, year_week_apply, rn, seasonality_index``. Of several indexes for a key and week, the one of
    the lowest ``rn`` counts. Only the week's rows are aggregated, to one per key.
    """
    week = index.where(F.col("year_week_apply") == iso_week_key(as_of))
    best = week.groupBy(*keys).agg(F.min_by("seasonality_index", "rn").alias("seasonality_index"))
    joined = rates.join(best, keys, "left")
    return joined.withColumn("seasonality_index", F.coalesce("seasonality_index", F.lit(1.0)))


def clip_to(df: DataFrame, column: str, low: Column, high: Column) -> DataFrame:
    """Winsorise a column; bounds that are NULL do not clip."""
    c = F.col(column)
    return df.withColumn(column, F.when(c < low, low).when(c > high, high).otherwise(c))


def seasonality_index(
    weekly: DataFrame,
    keys: list[str],
    weeks: DataFrame,
    value: str,
    recent_from: str,
    calendar_override: DataFrame | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Seasonality per group and week.

    ``weekly`` has ``keys, calyear, calweek, value``; ``weeks`` has ``calyear, calweek, cnt_isoweek``. ``groups``, with
    ``keys``, is the dimension of groups: those in it without sales get an index of 1. Every group gets every week, absent weeks being zero. The index is the mean of this and the three
    following weeks over the mean of the year, winsorised at the group's 5th and 95th percentile of
    positive indexes since ``recent_from`` (``yyyy.ww``), and applied two weeks earlier next year unless
    ``calendar_override`` (``year_week, year_week_apply``) names another week.
    """
    calendar = weeks.agg(F.array_sort(F.collect_set(F.struct("calyear", "calweek", "cnt_isoweek")))).scalar()
    number = F.col("calyear") * 100 + F.col("calweek")
    known = F.map_from_entries(F.collect_list(F.when(F.col("calweek").isNotNull(), F.struct(number, F.col(value)))))
    if groups is not None:
        weekly = weekly.unionByName(groups.select(*keys).distinct(), allowMissingColumns=True)
    # one shuffle by group; the windows, bounds and join below stay on its partitioning
    grid = (
        weekly.groupBy(*keys).agg(known.alias("_known"))
        .select(*keys, "_known", F.inline(calendar))
        .select(*keys, "calyear", "calweek", "cnt_isoweek", F.coalesce(F.col("_known")[number], F.lit(0.0)).alias(value))
    )
    year = Window.partitionBy(*keys, "calyear")
    ahead = year.orderBy("calweek").rowsBetween(0, 3)
    index = F.coalesce(F.try_divide(F.avg(value).over(ahead), F.avg(value).over(year)), F.lit(1.0))
    year_week = F.concat(F.col("calyear").cast("string"), F.lit("."), F.lpad(F.col("calweek").cast("string"), 2, "0"))
    indexed = grid.withColumns({"year_week": year_week, "seasonality_index": index})
    # a group has one row per week of the calendar, so its bounds are a window over them
    counted = F.when((F.col("seasonality_index") > 0) & (F.col("year_week") >= recent_from), F.col("seasonality_index"))
    both = F.percentile(counted, F.array(F.lit(0.05), F.lit(0.95))).over(Window.partitionBy(*keys))
    bounded = indexed.withColumn("_b", both).withColumns({"lower_value": F.col("_b")[0], "upper_value": F.col("_b")[1]}).drop("_b")
    clipped = clip_to(bounded, "seasonality_index", F.col("lower_value"), F.col("upper_value"))
    early = F.col("calweek") - 2 <= 0
    apply_year = F.when(early, F.col("calyear")).otherwise(F.col("calyear") + 1)
    apply_week = F.when(early, F.col("calweek") - 2 + F.col("cnt_isoweek")).otherwise(F.col("calweek") - 2)
    shifted = F.concat(apply_year.cast("string"), F.lit("."), F.lpad(apply_week.cast("string"), 2, "0"))
    out = clipped.withColumn("year_week_apply", shifted)
    if calendar_override is None:
        out = out.withColumn("_moved", F.lit(None).cast("string"))
    else:
        out = out.join(calendar_override.select("year_week", F.col("year_week_apply").alias("_moved")), "year_week", "left")
    out = out.withColumn("year_week_apply", F.coalesce("_moved", "year_week_apply"))
    # where several weeks apply to one, the override comes first; readers take rn = 1
    same = Window.partitionBy(*keys, "year_week_apply").orderBy(F.col("_moved").isNull(), "year_week")
    return out.withColumn("rn", F.row_number().over(same)).drop("_moved")


# fixed values of the correction rules
HISTORY_DAYS = 180  # corrected history behind the quartiles
MEAN_DAYS = 30  # corrected history behind the replacement mean
SETTLE_DAYS = 30  # an item younger than this has no outlier test
INACTIVE_DAYS = 30  # out-of-stock days within the window that make an item inactive
COSTLY = 300_000  # unit cost above which the group bound does not widen the item bound
INITIAL_RATE = 0.03  # corrected quantity of an item that is too young
INITIAL_NOTE = "INITIAL CORRECTED SALES"
INACTIVE_NOTE = "TEMPORARY INNACTIVE"

CORRECTED_SCHEMA = (
    "inactive_range BIGINT, base_qty DOUBLE, is_promotion INT, is_oos INT, upper_outlier DOUBLE, lower_outlier DOUBLE, "
    "is_outlier INT, is_corrected INT, avg_corrected DOUBLE, corrected_qty DOUBLE, note STRING"
)


def correct_day(
    today: DataFrame,
    history: DataFrame,
    keys: list[str],
    on: date | str,
    history_days: int = HISTORY_DAYS,
    mean_days: int = MEAN_DAYS,
    settle_days: int = SETTLE_DAYS,
    inactive_days: int = INACTIVE_DAYS,
) -> DataFrame:
    """Corrected sales of one day.

    ``today`` has ``keys, first_day, base_qty, promo_qty, coupon_qty, stock_qty, unit_cost, pct_95,
    has_gift, is_component``; ``history`` has ``keys, calday, corrected_qty, is_oos`` with one row per
    key and day, so a key never has more than ``history_days`` rows in the single aggregate below.
    """
    d = day(on)
    c = F.col("calday")
    past = history.where((c >= F.date_sub(d, history_days)) & (c < d)).groupBy(*keys).agg(
        F.percentile("corrected_qty", F.array(F.lit(0.25), F.lit(0.75))).alias("_q"),
        F.avg(F.when(c >= F.date_sub(d, mean_days), F.coalesce("corrected_qty", F.lit(0.0)))).alias("_mean"),
        F.sum(F.when(c > F.date_sub(d, inactive_days), F.col("is_oos"))).alias("_oos"),
    )
    rows = today.join(past, keys, "left")
    q = F.col("_q")
    found = _corrected(F.struct(*today.columns), F.struct(q[0].alias("q1"), q[1].alias("q3"), F.col("_mean").alias("mean"), F.col("_oos").alias("oos")), d, settle_days, inactive_days)
    return rows.select(d.alias("calday"), *keys, F.inline(F.array(found)))


def _corrected(x: Column, past: Column, d: Column, settle_days: int, inactive_days: int) -> Column:
    """The corrected row of one day from its input and what the days before it say (quartiles, mean, out-of-stock days)."""

    def not_negative(name: str) -> Column:
        return F.greatest(F.coalesce(x[name], F.lit(0.0)), F.lit(0.0))

    def flag(c: Column) -> Column:
        return c.cast("int")

    base, q1, q3 = not_negative("base_qty"), past["q1"], past["q3"]
    settled = d >= F.date_add(x["first_day"], settle_days)
    group_bound = F.when(F.coalesce(x["unit_cost"], F.lit(0.0)) > COSTLY, 0.0).otherwise(F.coalesce(x["pct_95"], F.lit(0.0)))
    promoted = (not_negative("coupon_qty") > base * 0.5) | (x["has_gift"] & (base > 0))
    oos = (base == 0) & (F.coalesce(x["stock_qty"], F.lit(0.0)) <= 0)
    # no history, no bound: greatest() would otherwise skip the missing quartiles
    upper = F.when(settled & q1.isNotNull(), F.greatest(q3 + (q3 - q1) * 1.5, group_bound))
    above = F.coalesce(base > upper, F.lit(False))
    range_ = F.coalesce(past["oos"], F.lit(0)) + flag(oos)
    inactive, replaced, outlier = range_ >= inactive_days, F.coalesce(promoted, F.lit(False)) | oos, settled & above
    young = ~settled & ~x["is_component"]
    quantity = (
        F.when(young, INITIAL_RATE)
        .when(inactive, 0.0)
        .when(replaced, F.coalesce(past["mean"], F.lit(0.0)))
        .when(outlier, upper)
        .otherwise(base)
    )
    return F.struct(
        range_.cast("bigint").alias("inactive_range"),
        base.alias("base_qty"),
        flag(promoted).alias("is_promotion"),
        flag(oos).alias("is_oos"),
        upper.alias("upper_outlier"),
        F.when(settled, q1 - (q3 - q1) * 1.5).alias("lower_outlier"),
        F.when(settled, flag(above)).alias("is_outlier"),
        flag(replaced | outlier).alias("is_corrected"),
        F.when(inactive, 0.0).otherwise(past["mean"]).alias("avg_corrected"),
        quantity.alias("corrected_qty"),
        F.when(young, INITIAL_NOTE).when(inactive, INACTIVE_NOTE).alias("note"),
    )


def _given(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, inside a row."""
    return F.transform(F.array(value), then)[0]


def _quartile(ordered: Column, p: float) -> Column:
    """Interpolated percentile of a sorted array; NULL for an empty one."""
    n = F.size(ordered)
    at = (n - 1) * F.lit(p)
    low, high = F.floor(at), F.ceil(at)
    below, above = (F.try_element_at(ordered, (i + 1).cast("int")) for i in (low, high))
    return F.when(n == 0, F.lit(None).cast("double")).when(low == high, below).otherwise((high - at) * below + (at - low) * above)


def corrected_days(
    daily: DataFrame,
    history: DataFrame,
    keys: list[str],
    history_days: int = HISTORY_DAYS,
    mean_days: int = MEAN_DAYS,
    settle_days: int = SETTLE_DAYS,
    inactive_days: int = INACTIVE_DAYS,
) -> DataFrame:
    """Corrected sales of all days of ``daily`` (input of ``correct_day`` with ``calday``), each from the corrected days before it.

    One shuffle brings a key's days together, history and new ones; they are folded in order with the corrected days of the window as state, so that
    the state of a key is at most ``history_days`` values. ``history`` has one row per key and day before the first of ``daily``.
    """
    state = "STRUCT<past: ARRAY<STRUCT<calday: DATE, corrected_qty: DOUBLE, is_oos: INT>>, done: ARRAY<STRUCT<calday: DATE, " + CORRECTED_SCHEMA.replace(" ", ": ").replace(",: ", ", ") + ">>>"
    inputs = ["calday", "first_day", "base_qty", "promo_qty", "coupon_qty", "stock_qty", "unit_cost", "pct_95", "has_gift", "is_component"]
    old = history.select(*keys, F.struct("calday", F.col("corrected_qty").cast("double"), F.col("is_oos").cast("int")).alias("_past"))
    new = daily.select(*keys, F.struct(*inputs).alias("_day"))
    held = old.unionByName(new, allowMissingColumns=True).groupBy(*keys).agg(F.array_sort(F.collect_list("_past")).alias("past"), F.array_sort(F.collect_list("_day")).alias("days"))

    def window(past: Column, since: Column) -> Column:
        return F.filter(past, lambda p: p["calday"] >= since)

    def summary(past: Column, d: Column) -> Column:
        ordered = F.array_sort(F.filter(F.transform(past, lambda p: p["corrected_qty"]), lambda q: q.isNotNull()))
        recent = window(past, F.date_sub(d, mean_days))
        total = F.aggregate(recent, F.lit(0.0), lambda a, p: a + F.coalesce(p["corrected_qty"], F.lit(0.0)))
        oos = F.aggregate(window(past, F.date_sub(d, inactive_days - 1)), F.lit(0), lambda a, p: a + F.coalesce(p["is_oos"], F.lit(0)))
        return _given(ordered, lambda a: F.struct(_quartile(a, 0.25).alias("q1"), _quartile(a, 0.75).alias("q3"), F.try_divide(total, F.size(recent)).alias("mean"), oos.alias("oos")))

    def step(s: Column, x: Column) -> Column:
        d = x["calday"]

        def grown(past: Column, row: Column) -> Column:
            seen = F.struct(d.alias("calday"), row["corrected_qty"].alias("corrected_qty"), row["is_oos"].alias("is_oos"))
            result = F.struct(d.alias("calday"), *[row[c.split()[0]].alias(c.split()[0]) for c in CORRECTED_SCHEMA.split(", ")])
            return F.struct(F.array_append(past, seen).alias("past"), F.array_append(s["done"], result).alias("done")).cast(state)

        def with_past(past: Column) -> Column:
            return _given(summary(past, d), lambda m: _given(_corrected(x, m, d, settle_days, inactive_days), lambda row: grown(past, row)))

        return _given(window(s["past"], F.date_sub(d, history_days)), with_past)

    start = F.struct(F.col("past"), F.array().alias("done")).cast(state)
    return held.select(*keys, F.inline(F.aggregate("days", start, step)["done"])).select("calday", *keys, *[c.split()[0] for c in CORRECTED_SCHEMA.split(", ")])


def outlier_correct(
    daily: DataFrame, table: str, keys: list[str], first: date, last: date, **rules: int
) -> None:
    """Correct the days ``first`` .. ``last`` into the day-partitioned ``table`` (``corrected_days``), by one read of its history and one commit.

    The written table is the state: a later call goes on from the corrected days that it holds, and a call that is
    repeated replaces the days that it wrote. History must already lie in ``table``.
    """
    from tallyloom.sinks.tables import align_schema, read_table, replace_days

    written = read_table(daily.sparkSession, table)
    c, since = F.col("calday"), rules.get("history_days", HISTORY_DAYS)
    back = max(since, rules.get("mean_days", MEAN_DAYS), rules.get("inactive_days", INACTIVE_DAYS))
    history = written.where((c >= F.date_sub(day(first), back)) & (c < day(first)))
    days = daily.where(c.between(day(first), day(last)))
    corrected = align_schema(corrected_days(days, history, keys, **rules), written.schema)
    replace_days(corrected, table, "calday", "outlier_correct")
