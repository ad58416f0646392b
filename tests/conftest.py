import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paytide import schema as s  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("paytide-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DEFAULTS = {
    "txn_id": "t1",
    "txn_timestamp": "2026-03-21 10:00:00",
    "txn_date": "2026-03-21",
    "txn_hour": 10,
    "txn_type": "P2P",
    "sender_vpa": "a@sbi",
    "receiver_vpa": "b@hdfc",
    "sender_bank": "SBI",
    "receiver_bank": "HDFC",
    "amount": 1500.0,
    "currency": "INR",
    "status": "SUCCESS",
    "failure_reason": None,
    "merchant_category": None,
    "merchant_name": None,
    "utr_number": "UTR123",
    "device_type": "Android",
    "app_name": "GPay",
    "is_anomaly": False,
}


@pytest.fixture(scope="session")
def bronze_rows(spark):
    """Builds a Bronze frame from partial records; unnamed columns take a default."""

    def build(*records):
        rows = [tuple({**DEFAULTS, **record}[c] for c in s.BRONZE.names) for record in records]
        return spark.createDataFrame(rows, s.BRONZE)

    return build


@pytest.fixture(scope="session")
def sample(bronze_rows):
    """Four rows: an exact duplicate, a failed merchant payment, a large one at night."""
    first = {"txn_id": "txn_001"}
    return bronze_rows(
        first,
        {
            "txn_id": "txn_002",
            "txn_timestamp": "2026-03-21 11:00:00",
            "txn_hour": 11,
            "txn_type": "P2M",
            "amount": 500.0,
            "sender_bank": "ICICI",
            "receiver_bank": "Axis",
            "status": "FAILED",
            "failure_reason": "Insufficient funds",
            "merchant_category": "Grocery",
            "merchant_name": "DMart",
        },
        first,
        {
            "txn_id": "txn_003",
            "txn_timestamp": "2026-03-21 03:00:00",
            "txn_hour": 3,
            "amount": 75000.0,
            "sender_bank": "Kotak",
            "receiver_bank": "PNB",
            "is_anomaly": True,
        },
    )


@pytest.fixture(scope="session")
def typed_rows(bronze_rows):
    from paytide.operators.cleansing import enforce_schema

    return lambda *records: enforce_schema(bronze_rows(*records))


@pytest.fixture(scope="session")
def silver_rows(bronze_rows):
    from paytide.plans.silver import silver

    return lambda *records: silver(bronze_rows(*records))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_records(df) -> list[int]:
    """Rows written by each shuffle of an executed frame, outermost first."""
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        if kind == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return found
