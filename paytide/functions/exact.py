"""Sums that do not depend on the order of rows.

Doubles are added as fixed-point decimals, taken from their shortest decimal form. Adding
decimals is exact, so any split into tasks, partial aggregates or stored days gives the same
digits. A value that fixed point cannot hold (NaN, infinite, 1e18 or more) is added as a
double beside it, so that it shows in the total instead of vanishing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ten decimal places; sums of these have 28 digits before the point.
FIXED = "decimal(28,10)"


def fixed(value: Column) -> Column:
    """`value` in fixed point, at ten decimal places; NULL where it does not fit."""
    return value.try_cast(FIXED)


def exact_sum(value: Column) -> Column:
    """Sum of what fits, to be merged by `sum` and shown by `exact_total`."""
    return F.sum(fixed(value))


def misfit_sum(value: Column) -> Column:
    """Sum of what does not fit; NULL if all values do."""
    return F.sum(F.when(fixed(value).isNull(), value.cast("double")))


def exact_total(exact: Column, misfit: Column) -> Column:
    """The double closest to the sum of all values; NULL if there were none."""
    return F.when(
        misfit.isNotNull(), F.coalesce(exact.cast("double"), F.lit(0.0)) + misfit
    ).otherwise(exact.cast("double"))


def total(value: Column) -> Column:
    """Sum of `value` as a double, whatever the order of rows."""
    return exact_total(exact_sum(value), misfit_sum(value))


def mean(value: Column) -> Column:
    """Mean of `value`, whatever the order of rows; NULL if there are no values."""
    return F.try_divide(total(value), F.count(value))
