import datetime as dt

import pytest

from paytide import schema as s
from paytide.operators import audit, views
from paytide.operators.summaries import (
    anomaly_summary,
    bank_failure_analysis,
    hourly_txn_summary,
    merchant_spend_analysis,
)
from tests.conftest import plan_of


def test_profile(bronze_rows):
    raw = bronze_rows(
        {"txn_id": "1"},
        {"txn_id": "2", "status": "FAILED", "is_anomaly": True},
        {"txn_id": "3", "status": None, "is_anomaly": True},
        {"txn_id": "4", "is_anomaly": None},
    )
    facts = {(r.metric, r.item): r.value for r in audit.bronze_profile(raw).collect()}
    assert facts == {
        ("rows", "all"): 4,
        ("columns", "all"): 19,
        ("anomalies", "all"): 2,
        ("status", "SUCCESS"): 2,
        ("status", "FAILED"): 1,
    }
    assert [tuple(r) for r in audit.status_counts(raw).collect()] == [("SUCCESS", 2), ("FAILED", 1)]
    assert audit.anomaly_total(raw).first().anomalies == 2
    shape = audit.table_shape(raw).first()
    assert (shape.row_count, shape.column_count) == (4, 19)
    assert shape.column_names.split(",") == s.BRONZE.names


def test_profile_of_an_empty_table(bronze_rows):
    empty = bronze_rows()
    assert audit.bronze_profile(empty).isEmpty()
    assert audit.table_shape(empty).first().row_count == 0
    assert audit.anomaly_total(empty).first().anomalies == 0


def test_profile_scans_once(spark, bronze_rows, tmp_path):
    path = str(tmp_path / "b")
    bronze_rows({}, {"txn_id": "2"}).write.parquet(path)
    plan = plan_of(audit.bronze_profile(spark.read.parquet(path)))
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<status:string,is_anomaly:boolean>" in plan


def test_first_rows_is_a_top_n(bronze_rows):
    raw = bronze_rows(*[{"txn_id": str(i)} for i in (5, 3, 9, 1)])
    peek = audit.first_rows(raw, 3, order_by=("txn_id",))
    assert [r.txn_id for r in peek.collect()] == ["1", "3", "5"]
    assert "TakeOrderedAndProject" in plan_of(peek)
    assert audit.first_rows(raw).count() == 3


@pytest.fixture(scope="module")
def gold(silver_rows):
    def p(i, **change):
        return {"txn_id": f"t{i}", **change}

    rows = silver_rows(
        p(1, amount=100.0, txn_hour=9),
        p(2, amount=300.0, txn_hour=9, is_anomaly=True),
        p(3, amount=1000.5, txn_hour=8, status="FAILED", sender_bank="HDFC"),
        p(4, amount=10.0, txn_hour=9, txn_date="2026-03-20"),
        p(5, amount=70.0, txn_type="P2M", merchant_category="Fuel", txn_hour=23),
        p(6, amount=90.0, txn_type="P2M", merchant_category="Food", txn_hour=23),
    )
    return {
        "hourly": hourly_txn_summary(rows),
        "banks": bank_failure_analysis(rows),
        "merchants": merchant_spend_analysis(rows),
        "anomalies": anomaly_summary(rows),
    }


def test_hourly_volume_interleaves_dates(gold):
    points = [tuple(r) for r in views.hourly_volume(gold["hourly"]).collect()]
    d20, d21 = dt.date(2026, 3, 20), dt.date(2026, 3, 21)
    assert points == [(d21, 8, 1), (d20, 9, 1), (d21, 9, 2), (d21, 23, 2)]


def test_rankings(gold):
    assert [tuple(r) for r in views.bank_ranking(gold["banks"]).collect()] == [
        ("HDFC", 100.0),
        ("SBI", 0.0),
    ]
    assert [tuple(r) for r in views.merchant_ranking(gold["merchants"]).collect()] == [
        ("Food", 90.0),
        ("Fuel", 70.0),
    ]
    assert [tuple(r) for r in views.anomaly_table(gold["anomalies"]).collect()] == [
        (dt.date(2026, 3, 21), "SBI", 1, 300.0)
    ]


def test_kpis(gold):
    row = views.kpis(gold["hourly"], gold["anomalies"]).first()
    assert (row.total_txns, row.total_volume, row.total_anomalies) == (6, 1570.5, 1)
    assert row.avg_transaction == pytest.approx((1000.5 + 10.0 + 200.0 + 80.0) / 4)
    assert row.weighted_avg_amount == pytest.approx(1570.5 / 6)


def test_kpis_use_no_cross_join(gold):
    plan = plan_of(views.kpis(gold["hourly"], gold["anomalies"]))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_kpi_cards(spark):
    row = spark.sql(
        "select 1234567L as total_txns, 1234567.5D as total_volume, 2.5D as avg_transaction,"
        " 0L as total_anomalies"
    )
    assert [tuple(r) for r in views.kpi_cards(row).collect()] == [
        ("Total Transactions", "1,234,567"),
        ("Total Volume (₹)", "₹1,234,568"),
        ("Avg Transaction (₹)", "₹2"),
        ("Total Anomalies", "0"),
    ]


def test_kpis_of_empty_tables(silver_rows):
    empty = silver_rows()
    row = views.kpis(hourly_txn_summary(empty), anomaly_summary(empty)).first()
    assert (row.total_txns, row.total_volume, row.total_anomalies) == (0, 0.0, 0)
    assert row.avg_transaction is None and row.weighted_avg_amount is None
