"""Derived Silver columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytide import schema as s
from paytide.functions.scalars import bucketize, flag


def enrich(
    df: DataFrame,
    *,
    high_value_from: float = s.HIGH_VALUE_FROM,
    odd_hours: tuple[int, int] = s.ODD_HOURS,
    with_processed_at: bool = True,
) -> DataFrame:
    """Add the value, time and routing attributes analysts group by."""
    amount, day = F.col("amount"), F.col("txn_date")
    derived = {
        "is_high_value": flag(amount >= high_value_from),
        "is_odd_hour": flag(F.col("txn_hour").between(*odd_hours)),
        "amount_bucket": bucketize(amount, s.AMOUNT_BUCKETS, s.TOP_BUCKET),
        "is_same_bank": flag(F.col("sender_bank") == F.col("receiver_bank")),
        "day_of_week": F.date_format(day, "EEEE"),
        "week_of_year": F.weekofyear(day),
    }
    if with_processed_at:
        derived["processed_at"] = F.current_timestamp()
    return df.withColumns(derived)
