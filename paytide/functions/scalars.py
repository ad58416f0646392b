"""Small expressions shared by the layers. All stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """Two-valued form of a predicate: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def bucketize(value: Column, upper_bounds: Mapping[str, float], otherwise: str) -> Column:
    """Label of the first bucket whose exclusive upper bound lies above `value`.

    NULL takes the `otherwise` label, as every comparison with it is unknown.
    """
    candidates = [
        F.when(value < bound, F.lit(label))
        for label, bound in sorted(upper_bounds.items(), key=lambda item: item[1])
    ]
    return F.coalesce(*candidates, F.lit(otherwise))


def rate_pct(part: Column, whole: Column) -> Column:
    """Share in percent at two decimals; NULL instead of a division by zero."""
    return F.round(F.try_divide(part, whole) * 100, 2)


def money(value: Column) -> Column:
    return F.round(value, 2)


def grouped_number(value: Column, sign: str = "") -> Column:
    """Whole number with thousands separators, e.g. `₹1,234,568`."""
    return F.concat(F.lit(sign), F.format_number(value, 0))
