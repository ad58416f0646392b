"""Named predicates: what makes a row valid, and what makes it suspicious."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paytide import schema as s


def validation_rules(
    *,
    max_amount: float = s.MAX_AMOUNT,
    statuses: tuple[str, ...] = s.STATUSES,
    txn_types: tuple[str, ...] = s.TXN_TYPES,
) -> dict[str, Column]:
    """The business rules a transaction has to meet, by name."""
    return {
        "amount_positive": F.col("amount") > 0,
        "amount_within_limit": F.col("amount") <= max_amount,
        "known_status": F.col("status").isin(*statuses),
        "known_type": F.col("txn_type").isin(*txn_types),
        "sender_vpa_has_handle": F.contains("sender_vpa", F.lit(s.VPA_SEPARATOR)),
        "receiver_vpa_has_handle": F.contains("receiver_vpa", F.lit(s.VPA_SEPARATOR)),
    }


def detection_rules(
    *,
    spike_from: float = s.SPIKE_FROM,
    night_hours: tuple[int, int] = s.NIGHT_HOURS,
    round_amounts: tuple[float, ...] = s.ROUND_AMOUNTS,
) -> dict[str, Column]:
    """Single-row signs of an anomaly, by name of the flag they set."""
    return {
        "is_spike": F.col("amount") >= spike_from,
        "is_night": F.col("txn_hour").between(*night_hours),
        "is_round_amount": F.col("amount").isin(*[float(a) for a in round_amounts]),
    }


def all_of(rules: dict[str, Column]) -> Column:
    return reduce(Column.__and__, rules.values())


def any_of(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions)
