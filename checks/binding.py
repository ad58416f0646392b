"""Reads the `events` table as raw transactions, for checks and benchmarks only.

Every expression is plain SQL that Spark and DuckDB evaluate alike, so both sides start
from the same rows. `k` is the event id; its remainders place nulls, invalid values and
retried copies. Amounts have cents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Invented names the raw transactions draw from.
BANKS = "Alder,Birch,Cedar,Dogwood,Elm,Fir,Ginkgo,Hazel,Ironwood,Juniper"
FAILURE_REASONS = "No cover,No answer,Unknown payee,Over limit,Wrong code"
MERCHANT_CATEGORIES = (
    "Bakery,Books,Cycling,Dairy,Flowers,Garden,Hardware,Music,Optics,Paper,Shoes,Toys"
)
DEVICES = "Phone,Tablet,Desk"
APPS = "Alpha,Beta,Gamma,Delta,Epsilon"


def _pick(names: str, position: str) -> str:
    size = names.count(",") + 1
    return f"split_part('{names}', ',', cast(({position}) % {size} + 1 as int))"


_STATUS = (
    "case when event_id % 89 = 0 then null when event_id % 83 = 0 then 'REVERSED'"
    " when (event_id * 7) % 100 < 88 then 'SUCCESS'"
    " when (event_id * 7) % 100 < 97 then 'FAILED' else 'PENDING' end"
)
_TYPE = (
    "case when event_id % 97 = 0 then 'REFUND'"
    " when event_id % 20 < 9 then 'P2P' else 'P2M' end"
)

COLUMNS = {
    "txn_id": "case when event_id % 211 = 0 then null"
    " else concat('TXN-', lpad(cast(event_id as string), 10, '0')) end",
    "txn_timestamp": "case when event_id % 223 = 0 then 'garbage'"
    " else substr(cast(ts as string), 1, 19) end",
    "txn_date": "substr(cast(ts as string), 1, 10)",
    "txn_hour": "cast(hour(ts) as bigint)",
    "txn_type": _TYPE,
    "sender_vpa": "concat('user', cast(user_id as string),"
    " case when event_id % 101 = 0 then '' else '@sbi' end)",
    "receiver_vpa": "concat('payee', cast(event_id % 500 as string),"
    " case when event_id % 109 = 0 then '' else '@icici' end)",
    "sender_bank": _pick(BANKS, "user_id"),
    "receiver_bank": _pick(BANKS, "user_id * 3 + event_id"),
    "amount": "case when event_id % 103 = 0 then cast(1500000 as double)"
    " when event_id % 107 = 0 then cast(-25 as double)"
    " else cast(cast(value as decimal(12,2)) * 2500"
    " + cast(event_id % 100 as decimal(4,0)) * cast(0.01 as decimal(3,2)) as double) end",
    "currency": "'INR'",
    "status": _STATUS,
    "failure_reason": f"case when {_STATUS} = 'FAILED'"
    f" then {_pick(FAILURE_REASONS, 'event_id')} end",
    "merchant_category": f"case when {_TYPE} = 'P2M'"
    f" then {_pick(MERCHANT_CATEGORIES, 'event_id')} end",
    "merchant_name": f"case when {_TYPE} = 'P2M'"
    " then concat('Merchant-', cast(event_id % 50 as string)) end",
    "utr_number": "concat('UTR', cast(100000000000 + event_id as string))",
    "device_type": _pick(DEVICES, "event_id"),
    "app_name": _pick(APPS, "event_id"),
    "is_anomaly": "event_id % 19 = 0",
}

_SELECT = ", ".join(f"{expression} as {name}" for name, expression in COLUMNS.items())

BRONZE_SQL = (
    f"select {_SELECT} from (select event_id, ts, user_id, value from events"
    " union all select event_id, ts + interval '1' minute, user_id, value"
    " from events where event_id % 20 = 0) as attempts"
)


#: The same transactions with every column as text, and values that do not convert.
TEXT_COLUMNS = {
    **COLUMNS,
    "txn_date": "case when event_id % 71 = 0 then '21/03' else substr(cast(ts as string), 1, 10) end",
    "txn_hour": "case when event_id % 59 = 0 then 'noon' else cast(hour(ts) as string) end",
    "amount": "case when event_id % 61 = 0 then 'n/a' when event_id % 103 = 0 then '1500000'"
    " when event_id % 107 = 0 then '-25'"
    " else cast(cast(value as decimal(12,2)) * 2500"
    " + cast(event_id % 100 as decimal(4,0)) * cast(0.01 as decimal(3,2)) as string) end",
    "is_anomaly": "case when event_id % 67 = 0 then 'maybe' when event_id % 19 = 0 then 'true' else 'false' end",
}

_TEXT_SELECT = ", ".join(f"{expression} as {name}" for name, expression in TEXT_COLUMNS.items())

BRONZE_TEXT_SQL = BRONZE_SQL.replace(_SELECT, _TEXT_SELECT)


def bronze_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attempts(spark, sf_dir, TEXT_COLUMNS)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions from one scan of `events`, with a late copy of every 20th."""
    return _attempts(spark, sf_dir, COLUMNS)


def _attempts(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    attempts = events.selectExpr(
        "event_id",
        "user_id",
        "value",
        "explode(if(event_id % 20 = 0, array(ts, ts + interval '1' minute), array(ts))) as ts",
    )
    return attempts.selectExpr(
        *[f"{expression} as {name}" for name, expression in columns.items()]
    )
