"""Versioned dimensions (type 2): build from snapshots, apply a batch, presence periods, as-of."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.dates import OPEN_END, day
from tallyloom.functions.keys import surrogate_key
from tallyloom.operators.filters import valid_on
from tallyloom.operators.joins import following_days


def _open() -> Column:
    return day(OPEN_END)


def scd2_build(
    snapshots: DataFrame, keys: list[str], attrs: list[str], load_ts: str, tie_break: list[str] | None = None
) -> DataFrame:
    """Versions from repeated snapshots.

    The first row per key and load day counts. A version starts where the attributes differ from the
    day before and ends one day before the next start; the newest stays open.
    """
    others = [c for c in attrs]
    order = F.struct(load_ts, *(tie_break or []), *others)
    daily = snapshots.groupBy(*keys, F.to_date(load_ts).alias("start_date")).agg(
        F.min_by(F.struct(*others, F.col(load_ts).alias("_ts")), order).alias("_r")
    )
    daily = daily.select(*keys, "start_date", "_r.*").withColumn(
        "hash_id", surrogate_key(*[F.col(c) for c in [*keys, *attrs]])
    )
    # one row per key and day from here on: a key's window is bounded by the number of load days
    w = Window.partitionBy(*keys).orderBy("start_date")
    changed = daily.withColumn("_prev", F.lag("hash_id").over(w)).where(
        F.col("_prev").isNull() | (F.col("hash_id") != F.col("_prev"))
    )
    end = F.coalesce(F.date_sub(F.lead("start_date").over(w), 1), _open())
    return changed.withColumn("end_date", end).drop("_prev").withColumnRenamed("_ts", "loaded_at")


def close_versions(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """End the open version of every key whose open batch version has another fingerprint."""
    fresh = batch.where(F.col("end_date") == _open()).groupBy(*keys).agg(
        F.max_by(F.struct("hash_id", "start_date"), "start_date").alias("_new")
    )
    joined = target.join(fresh, keys, "left")
    closes = (F.col("end_date") == _open()) & (F.col("hash_id") != F.col("_new.hash_id"))
    ended = F.when(closes, F.date_sub(F.col("_new.start_date"), 1)).otherwise(F.col("end_date"))
    return joined.withColumn("end_date", ended).drop("_new").select(*target.columns)


def scd2_apply(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Continue a dimension with the versions of a batch, in one pass over target and batch.

    The key's first batch version decides: if it repeats the open version, that version takes its end
    and the repeat is dropped; else the open version ends the day before. All later batch versions are
    added, so periods of a key never overlap. A key has at most one version per load day.
    """
    w = Window.partitionBy(*keys)
    both = target.withColumn("_new", F.lit(False)).unionByName(batch.select(*target.columns).withColumn("_new", F.lit(True)))
    is_open = ~F.col("_new") & (F.col("end_date") == _open())
    first = F.min(F.when(F.col("_new"), F.struct("start_date", "end_date", "hash_id"))).over(w)
    marked = both.withColumns(
        {"_open": is_open, "_first": first, "_open_hash": F.max(F.when(is_open, F.col("hash_id"))).over(w)}
    )
    same = F.col("_first.hash_id") == F.col("_open_hash")
    repeat = F.col("_new") & (F.col("start_date") == F.col("_first.start_date")) & same
    ended = (
        F.when(F.col("_open") & same, F.col("_first.end_date"))
        .when(F.col("_open") & F.col("_first").isNotNull(), F.date_sub("_first.start_date", 1))
        .otherwise(F.col("end_date"))
    )
    return marked.where(~F.coalesce(repeat, F.lit(False))).withColumn("end_date", ended).select(*target.columns)


def soft_delete(
    target: DataFrame, snapshot: DataFrame, keys: list[str], on: date | str
) -> DataFrame:
    """Mark live rows whose key the snapshot no longer has."""
    present = snapshot.select(*keys).distinct().withColumn("_here", F.lit(True))
    joined = target.join(present, keys, "left")
    gone = F.col("_here").isNull() & (F.col("is_delete") == 0)
    return joined.withColumns(
        {
            "end_date": F.when(gone, day(on)).otherwise(F.col("end_date")),
            "is_delete": F.when(gone, 1).otherwise(F.col("is_delete")).cast("int"),
        }
    ).select(*target.columns)


def scd2_presence(snapshots: DataFrame, keys: list[str], snapshot_day: str, last: date | str) -> DataFrame:
    """ACTIVE / DELETE periods per key by whether each snapshot day lists the key.

    Only days on which any snapshot was taken can end a presence, so the periods are worked out from
    the key's own days and the calendar of snapshot days: no key-by-day grid is built.
    """
    seen = snapshots.select(*keys, F.col(snapshot_day).alias("_d")).distinct()
    following = following_days(seen, "_d", "_next_snapshot")  # one row per snapshot day
    w = Window.partitionBy(*keys).orderBy("_d")
    marked = seen.join(F.broadcast(following), "_d").withColumn("_next_seen", F.lead("_d").over(w))
    # the key is absent from the next snapshot on
    left_at = F.when(
        F.col("_next_snapshot").isNotNull() & ~F.col("_next_seen").eqNullSafe(F.col("_next_snapshot")),
        F.col("_next_snapshot"),
    )
    came_back = F.lag(left_at).over(w)
    starts = marked.withColumns({"_left": left_at, "_starts": came_back.isNotNull() | F.lag("_d").over(w).isNull()})
    events = starts.select(
        *keys,
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.when(F.col("_starts"), F.col("_d")).alias("start_date"), F.lit("ACTIVE").alias("status")),
                    F.struct(F.col("_left").alias("start_date"), F.lit("DELETE").alias("status")),
                ),
                lambda e: e["start_date"].isNotNull(),
            )
        ).alias("_e"),
    ).select(*keys, "_e.*")
    v = Window.partitionBy(*keys).orderBy("start_date")
    return events.where(F.col("start_date") <= day(last)).withColumns(
        {
            "end_date": F.coalesce(F.date_sub(F.lead("start_date").over(v), 1), _open()),
            "is_delete": (F.col("status") == "DELETE").cast("int"),
        }
    )


def as_of(versions: DataFrame, d: date | str) -> DataFrame:
    return valid_on(versions, d)


def in_out_diff(snapshots: DataFrame, keys: list[str], snapshot_day: str, before: date | str, after: date | str) -> DataFrame:
    """Keys that entered (IN) or left (OUT) between two snapshot days, in one aggregate."""
    d = F.col(snapshot_day)
    marks = (
        snapshots.where(d.isin(day(before), day(after)))
        .groupBy(*keys)
        .agg(F.max(d == day(before)).alias("_was"), F.max(d == day(after)).alias("_is"))
    )
    kind = F.when(F.col("_is") & ~F.col("_was"), "IN").when(F.col("_was") & ~F.col("_is"), "OUT")
    return marks.withColumn("in_out_type", kind).where(F.col("in_out_type").isNotNull()).select(*keys, "in_out_type")


def start_of_last_run(days: DataFrame, keys: list[str], d: str, out: str) -> DataFrame:
    """First day of the latest unbroken run of days per key (gaps and islands).

    A day starts a run when its key has no row the day before; the latest such day is the answer.
    """
    once = days.select(*keys, F.col(d).alias("_d")).distinct()
    before = F.lag("_d").over(Window.partitionBy(*keys).orderBy("_d"))
    starts = once.withColumn("_b", before).where(F.col("_b").isNull() | (F.datediff("_d", "_b") > 1))
    return starts.groupBy(*keys).agg(F.max("_d").alias(out))
