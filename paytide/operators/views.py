"""The data behind the dashboard, from the four Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytide.functions.exact import mean, total
from paytide.functions.scalars import grouped_number

CURRENCY_SIGN = "₹"


def hourly_volume(hourly: DataFrame) -> DataFrame:
    """One point per date and hour, ordered by hour of day (dates interleave)."""
    return hourly.select("txn_date", "txn_hour", "total_txns").orderBy("txn_hour", "txn_date")


def bank_ranking(banks: DataFrame) -> DataFrame:
    return banks.select("sender_bank", "failure_rate_pct").orderBy(
        F.desc("failure_rate_pct"), "sender_bank"
    )


def merchant_ranking(merchants: DataFrame) -> DataFrame:
    return merchants.select("merchant_category", "total_spend").orderBy(
        F.desc("total_spend"), "merchant_category"
    )


def anomaly_table(anomalies: DataFrame) -> DataFrame:
    return anomalies.select(
        "txn_date", "sender_bank", "anomaly_count", "total_anomaly_amount"
    ).orderBy(F.desc("anomaly_count"), "txn_date", "sender_bank")


def kpis(hourly: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Headline numbers as one row.

    `avg_transaction` is the plain mean of the hourly averages, so a quiet hour weighs as
    much as a busy one; `weighted_avg_amount` is the mean per transaction. Neither depends
    on the order of the tables' rows.
    """
    facts = hourly.select("total_txns", "total_amount", "avg_amount").unionByName(
        anomalies.select("anomaly_count"), allowMissingColumns=True
    )
    txns, volume = F.sum("total_txns"), total(F.col("total_amount"))
    return facts.agg(
        F.coalesce(txns, F.lit(0)).alias("total_txns"),
        F.coalesce(volume, F.lit(0.0)).alias("total_volume"),
        mean(F.col("avg_amount")).alias("avg_transaction"),
        F.try_divide(volume, txns).alias("weighted_avg_amount"),
        F.coalesce(F.sum("anomaly_count"), F.lit(0)).alias("total_anomalies"),
    )


def kpi_cards(kpi_row: DataFrame, sign: str = CURRENCY_SIGN) -> DataFrame:
    """The headline numbers as (label, value) text for display."""
    shown = {
        "Total Transactions": grouped_number(F.col("total_txns")),
        f"Total Volume ({sign})": grouped_number(F.col("total_volume"), sign),
        f"Avg Transaction ({sign})": grouped_number(F.col("avg_transaction"), sign),
        "Total Anomalies": grouped_number(F.col("total_anomalies")),
    }
    cards = [
        F.struct(F.lit(label).alias("label"), value.alias("value"))
        for label, value in shown.items()
    ]
    return kpi_row.select(F.inline(F.array(*cards)))
