"""Table schemas and the fixed values every layer agrees on."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _struct(**fields: str) -> StructType:
    schema = StructType()
    for name, type_name in fields.items():
        schema = schema.add(name, type_name)
    return schema


# Names, order and types of the transaction record.
BRONZE = _struct(
    txn_id="string",
    txn_timestamp="string",
    txn_date="string",
    txn_hour="long",
    txn_type="string",
    sender_vpa="string",
    receiver_vpa="string",
    sender_bank="string",
    receiver_bank="string",
    amount="double",
    currency="string",
    status="string",
    failure_reason="string",
    merchant_category="string",
    merchant_name="string",
    utr_number="string",
    device_type="string",
    app_name="string",
    is_anomaly="boolean",
)

# Bronze columns whose cleaned type differs from the raw one.
_RETYPED = {"txn_timestamp": "timestamp", "txn_date": "date", "txn_hour": "integer"}

TYPED = _struct(
    **{f.name: _RETYPED.get(f.name, f.dataType.typeName()) for f in BRONZE}
)

# Names, order and types of the enrichment columns.
DERIVED = _struct(
    is_high_value="boolean",
    is_odd_hour="boolean",
    amount_bucket="string",
    is_same_bank="boolean",
    day_of_week="string",
    week_of_year="integer",
    processed_at="timestamp",
)

SILVER = StructType(TYPED.fields + DERIVED.fields)

# The four serving tables.
GOLD = {
    "hourly_txn_summary": _struct(
        txn_date="date",
        txn_hour="integer",
        total_txns="long",
        successful_txns="long",
        failed_txns="long",
        pending_txns="long",
        total_amount="double",
        avg_amount="double",
        max_amount="double",
        success_rate="double",
        failure_rate="double",
        processed_at="timestamp",
    ),
    "bank_failure_analysis": _struct(
        sender_bank="string",
        total_txns="long",
        failed_txns="long",
        total_amount="double",
        avg_amount="double",
        failure_rate_pct="double",
        processed_at="timestamp",
    ),
    "merchant_spend_analysis": _struct(
        merchant_category="string",
        total_txns="long",
        total_spend="double",
        avg_spend="double",
        max_spend="double",
        successful_txns="long",
        success_rate="double",
        processed_at="timestamp",
    ),
    "anomaly_summary": _struct(
        txn_date="date",
        sender_bank="string",
        anomaly_count="long",
        total_anomaly_amount="double",
        avg_anomaly_amount="double",
        max_anomaly_amount="double",
        processed_at="timestamp",
    ),
}

# Mergeable measures of a set of transactions.
_MEASURES = {
    "n": "long",
    "n_success": "long",
    "n_failed": "long",
    "n_pending": "long",
    "amount_sum": "decimal(38,10)",
    "amount_misfit": "double",
    "amount_n": "long",
    "amount_max": "double",
}

# Silver per day and whatever else a Gold table groups by.
ROLLUP = _struct(
    txn_date="date",
    txn_hour="integer",
    sender_bank="string",
    txn_type="string",
    merchant_category="string",
    is_anomaly="boolean",
    **_MEASURES,
)

# Silver per hour of event time.
HOURS = _struct(window_start="timestamp", **_MEASURES)

# Accepted codes, text formats, limits and fill-ins.
STATUSES = ("SUCCESS", "FAILED", "PENDING")
TXN_TYPES = ("P2P", "P2M")
MERCHANT_TYPE = "P2M"
VPA_SEPARATOR = "@"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
CRITICAL_COLUMNS = ("txn_id", "txn_timestamp", "amount", "status")
FILL_VALUES = {
    "failure_reason": "N/A",
    "merchant_category": "UNKNOWN",
    "merchant_name": "UNKNOWN",
}
MAX_AMOUNT = 1_000_000
HIGH_VALUE_FROM = 50_000
ODD_HOURS = (1, 5)
AMOUNT_BUCKETS = {"micro": 500, "small": 5_000, "medium": 50_000}
TOP_BUCKET = "large"

# The injected anomaly patterns the detection rules look for.
SPIKE_FROM = 150_000
NIGHT_HOURS = (2, 4)
ROUND_AMOUNTS = (100_000, 200_000, 250_000, 500_000)
