"""Arithmetic rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(c, F.lit(low)))


def least_positive(*columns: Column) -> Column:
    """Least of the positive values; NULL when none is positive."""
    return F.array_min(F.filter(F.array(*columns), lambda x: x > 0))


def safe_ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)


def noise_floor(c: Column, eps: float = 1e-6) -> Column:
    """Sums that are only rounding noise become zero."""
    return F.when(F.abs(c) < eps, F.lit(0.0)).otherwise(c)


def signed(indicator: Column, quantity: Column, outgoing: str = "H") -> Column:
    """Magnitude with the sign of the movement indicator."""
    return F.when(indicator == outgoing, -F.abs(quantity)).otherwise(F.abs(quantity))


def round_to_pack(quantity: Column, pack: Column) -> Column:
    """Round up to whole packs; an absent or zero pack size gives NULL."""
    size = F.nullif(pack, F.lit(0))
    return F.ceil(quantity / size) * size


def picking_type(quantity: Column, case_size: Column) -> Column:
    """``Case`` when the quantity is whole cases of more than one piece, else ``Piece``."""
    cases = F.try_divide(quantity, case_size)
    return F.when((F.coalesce(case_size, F.lit(1)) != 1) & (cases == F.floor(cases)), "Case").otherwise("Piece")


def convert_unit(quantity: Column, numerator: Column, denominator: Column) -> Column:
    return F.try_divide(quantity * numerator, denominator)


def exact_sum(c: Column, scale: int = 6) -> Column:
    """Sum that does not depend on row order: decimals of ``scale`` places are added, and become a double once.

    Totals may have 38 - ``scale`` digits before the point. Digits of a value beyond ``scale`` places are rounded off,
    which for doubles of up to nine digits before the point is below their own precision at the default.
    """
    return F.sum(c.cast(f"decimal(38,{scale})")).cast("double")


def band(c: Column, cuts: list[tuple[float, str]], top: str) -> Column:
    """Label of the first cut whose upper limit is above the value; ``top`` beyond the last."""
    if not cuts:
        return F.lit(top)
    out = None
    for upper, label in cuts:
        out = F.when(c < upper, label) if out is None else out.when(c < upper, label)
    return out.otherwise(top)
