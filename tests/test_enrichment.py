import pytest

from paytide import schema as s
from paytide.operators.enrichment import enrich


def one(typed_rows, **change):
    return enrich(typed_rows(change)).first()


def test_columns(typed_rows):
    assert enrich(typed_rows({})).schema.names == s.SILVER.names
    kinds = [f.dataType for f in enrich(typed_rows({})).schema]
    assert kinds == [f.dataType for f in s.SILVER]
    assert enrich(typed_rows({}), with_processed_at=False).columns == s.SILVER.names[:-1]


def test_sample_flags(sample):
    from paytide.operators.cleansing import enforce_schema

    rows = enrich(enforce_schema(sample).dropDuplicates(["txn_id"])).collect()
    assert [r.txn_id for r in rows if r.is_high_value] == ["txn_003"]
    assert [r.txn_id for r in rows if r.is_odd_hour] == ["txn_003"]
    buckets = {r.txn_id: r.amount_bucket for r in rows}
    assert buckets == {"txn_001": "small", "txn_002": "small", "txn_003": "large"}


@pytest.mark.parametrize(
    "amount, bucket, high",
    [
        (0.01, "micro", False),
        (499.99, "micro", False),
        (500.0, "small", False),
        (4999.99, "small", False),
        (5000.0, "medium", False),
        (49999.99, "medium", False),
        (50000.0, "large", True),
        (1_000_000.0, "large", True),
        (None, "large", False),
    ],
)
def test_amount_boundaries(typed_rows, amount, bucket, high):
    row = one(typed_rows, amount=amount)
    assert (row.amount_bucket, row.is_high_value) == (bucket, high)


@pytest.mark.parametrize(
    "hour, odd", [(0, False), (1, True), (5, True), (6, False), (23, False), (None, False)]
)
def test_odd_hours(typed_rows, hour, odd):
    assert one(typed_rows, txn_hour=hour).is_odd_hour is odd


@pytest.mark.parametrize(
    "sender, receiver, same",
    [("SBI", "SBI", True), ("SBI", "HDFC", False), (None, "SBI", False), (None, None, False)],
)
def test_same_bank(typed_rows, sender, receiver, same):
    assert one(typed_rows, sender_bank=sender, receiver_bank=receiver).is_same_bank is same


@pytest.mark.parametrize(
    "day, name, week",
    [
        ("2026-03-21", "Saturday", 12),
        ("2024-01-01", "Monday", 1),
        ("2027-01-01", "Friday", 53),
        (None, None, None),
    ],
)
def test_calendar(typed_rows, day, name, week):
    row = one(typed_rows, txn_date=day)
    assert (row.day_of_week, row.week_of_year) == (name, week)
