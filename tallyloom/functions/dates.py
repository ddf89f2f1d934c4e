"""Date and time columns. Nothing here reads the clock: the processing day is a parameter."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "2400-01-01"  # fixed value: end date of a version that is still open
LOCAL_ZONE = "Asia/Ho_Chi_Minh"  # fixed value: the business zone, UTC+7
STAMP_FORMAT = "yyyyMMddHHmmss"  # fixed value: 14-digit load stamp


def day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def local_ts(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(ts, zone)


def local_day(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(local_ts(ts, zone))


def parse_compact_date(c: Column) -> Column:
    """``yyyyMMdd`` text; blanks and the all-zero sentinel are NULL."""
    return F.to_date(F.try_to_timestamp(F.when(~c.isin("", "00000000"), c), F.lit("yyyyMMdd")))


def parse_compact_ts(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit(STAMP_FORMAT))


def parse_first(c: Column, formats: list[str]) -> Column:
    """Parse by the first format that fits, NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def parse_ampm(c: Column) -> Column:
    """12-hour clock text. The pattern letter ``a`` already yields 24-hour time."""
    return F.try_to_timestamp(c, F.lit("M/d/yyyy h:m:s a"))


def last_weekday_of_month(c: Column, weekday: str = "WED") -> Column:
    return F.next_day(F.date_sub(F.last_day(c), 7), weekday)


def epoch_ms(c: Column) -> Column:
    return F.timestamp_millis(c)


def normalize_stamp(c: Column, now: Column) -> Column:
    """Missing -> ``now``; 14 digits kept; ``yyyy-MM-dd HH:mm:ss`` reformatted; else NULL."""
    return (
        F.when(c.isNull(), F.date_format(now, STAMP_FORMAT))
        .when(c.rlike("^[0-9]{14}$"), c)
        .otherwise(F.date_format(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")), STAMP_FORMAT))
    )


def stamp_from_filename(name: Column, suffix: str = ".xml") -> Column:
    """The 14-digit stamp in the last ``_`` part of a file name, as a timestamp."""
    last = F.regexp_replace(F.element_at(F.split(name, "_"), -1), suffix.replace(".", r"\.") + "$", "")
    return parse_compact_ts(last)


def last_year_start(as_of: date | str) -> Column:
    """The first day of the year before a day's."""
    return F.trunc(F.add_months(day(as_of), -12), "YEAR")


def clean_date_list(c: Column, as_of: date | str, first: Column | None = None) -> Column:
    """Comma list of days: trimmed, distinct, from ``first`` (last year's start unless given) to ``as_of``."""
    bare = F.transform(F.split(c, ","), lambda x: F.trim(F.regexp_replace(x, "[\"' ]", "")))
    kept = F.filter(bare, lambda x: x.try_cast("date").between(last_year_start(as_of) if first is None else first, day(as_of)))
    return F.array_join(F.array_distinct(kept), ",")


def add_partition_columns(df, column: str):
    """``yyyy``, ``mm``, ``dd`` text columns from a date, a timestamp or date-like text."""
    digits = F.substring(F.regexp_replace(F.col(column).cast("string"), "-", ""), 1, 8)
    d = F.to_date(F.try_to_timestamp(digits, F.lit("yyyyMMdd")))
    return df.withColumns(
        {
            "yyyy": F.date_format(d, "yyyy"),
            "mm": F.date_format(d, "MM"),
            "dd": F.date_format(d, "dd"),
        }
    )
