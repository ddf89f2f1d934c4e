"""Text cleaning."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip_zeros(c: Column) -> Column:
    """Leading zeros off; text made of zeros only (or empty) becomes NULL."""
    return F.nullif(F.ltrim(c, F.lit("0")), F.lit(""))


def blank_to_null(c: Column, sentinels: Iterable[str] = ("",)) -> Column:
    return F.when(~c.isin(*sentinels), c)


def normalize_numeric_text(c: Column) -> Column:
    """One spelling per number: ``007`` -> ``7``, ``12.0`` -> ``12``; other text is unchanged.

    Done on the text, so that codes of any length keep all their digits.
    """
    return F.when(c.rlike(r"^[0-9]+(\.0+)?$"), F.regexp_extract(c, r"^0*([0-9]+?)(\.0+)?$", 1)).otherwise(c)


def clean_mobile(c: Column) -> Column:
    """National form of a phone number; the first rule that fits decides."""
    return (
        F.when(c.startswith("840"), F.substr(c, F.lit(3)))
        .when(c.startswith(".0"), F.substr(c, F.lit(2)))
        .when(c.startswith("84") & (F.length(c) > 10), F.concat(F.lit("0"), F.substr(c, F.lit(3))))
        .when(F.left(c, F.lit(1)).between("1", "9"), F.concat(F.lit("0"), c))
        .otherwise(c)
    )


def normalize_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def missing_attributes(attributes: dict[str, Column], sep: str = ", ") -> Column:
    """The labels of the NULL attributes as one text, in the order given."""
    return F.concat_ws(sep, *[F.when(c.isNull(), F.lit(label)) for label, c in attributes.items()])


def join_reasons(reasons: dict[str, Column], sep: str = ", ") -> Column:
    """The labels of the conditions that hold, as one text."""
    return F.concat_ws(sep, *[F.when(c, F.lit(label)) for label, c in reasons.items()])


def map_codes(c: Column, mapping: dict[str, object], default: Column | None = None) -> Column:
    """Code to value by a fixed mapping."""
    if not mapping:
        return default if default is not None else F.lit(None)
    out = None
    for code, value in mapping.items():
        out = F.when(c == code, F.lit(value)) if out is None else out.when(c == code, F.lit(value))
    return out.otherwise(default) if default is not None else out


def _plain(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9]+", "_", name)


def _rename(df: DataFrame, names: list[str]) -> DataFrame:
    clash = {n for n in names if names.count(n) > 1}
    if clash:
        raise ValueError(f"renaming makes duplicate columns: {sorted(clash)}")
    return df.toDF(*names)


def clean_columns(df: DataFrame) -> DataFrame:
    """Runs of characters other than letters and digits become one underscore."""
    return _rename(df, [_plain(n) for n in df.columns])


def snake_case_columns(df: DataFrame, keep_punctuation: bool = False) -> DataFrame:
    """camelCase to snake_case for each ``/``-separated part of a column name."""

    def one(part: str) -> str:
        spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", part)
        return spaced.lower() if keep_punctuation else _plain(spaced).strip("_").lower()

    return _rename(df, ["/".join(map(one, n.split("/"))) for n in df.columns])


def slash_to_underscore(df: DataFrame) -> DataFrame:
    return _rename(df, [n.replace("/", "_") for n in df.columns])


def first_label(rules: list[tuple[str, Column]], default: str) -> Column:
    """Label of the first condition that holds, in the order given."""
    out = None
    for label, condition in rules:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return F.lit(default) if out is None else out.otherwise(default)
