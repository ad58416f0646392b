import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from paytide import schema as s
from paytide.operators.audit import validation_audit
from paytide.operators.cleansing import (
    deduplicate,
    drop_critical_nulls,
    enforce_schema,
    handle_nulls,
    validate,
)
from paytide.plans.silver import cleaned, silver
from tests.conftest import plan_of, shuffled_records


def ids(df):
    return sorted(r.txn_id for r in df.select("txn_id").collect())


# --- schema ---------------------------------------------------------------------------


def test_enforced_types_and_order(sample):
    typed = enforce_schema(sample)
    assert typed.columns == s.BRONZE.names
    assert [f.dataType for f in typed.schema] == [f.dataType for f in s.TYPED]


def test_extra_columns_pass_through(sample):
    typed = enforce_schema(sample.withColumn("note", F.lit("x")))
    assert typed.columns == [*s.BRONZE.names, "note"]


def test_missing_column_is_an_error(sample):
    with pytest.raises(AnalysisException):
        enforce_schema(sample.drop("utr_number")).collect()


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-03-21 10:00:00", dt.datetime(2026, 3, 21, 10)),
        ("2026-03-21 10:00:00.123", dt.datetime(2026, 3, 21, 10)),
        ("2026-03-21 10:00:00abc", dt.datetime(2026, 3, 21, 10)),
        ("2026-03-21", None),
        ("2026-03-21T10:00:00", None),
        ("2026-03-21 10:00", None),
        ("2026-03-21 10:00+05", None),
        ("2026-13-21 10:00:00", None),
        ("2026-02-30 10:00:00", None),
        ("2026-03-21 24:00:00", None),
        ("2026-03-21 10:60:00", None),
        ("x2026-03-21 10:00:00", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_timestamp_text(bronze_rows, text, expected):
    row = enforce_schema(bronze_rows({"txn_timestamp": text})).first()
    assert row.txn_timestamp == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-03-21", dt.date(2026, 3, 21)),
        ("2026-03-21 23:59:59", dt.date(2026, 3, 21)),
        ("2026-02-29", None),
        ("2026-03", None),
        ("21-03-2026", None),
        (None, None),
    ],
)
def test_date_text(bronze_rows, text, expected):
    assert enforce_schema(bronze_rows({"txn_date": text})).first().txn_date == expected


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_text_is_read_in_the_session_zone(spark, bronze_rows, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = enforce_schema(bronze_rows({}))
        shown = df.select(F.date_format("txn_timestamp", "yyyy-MM-dd HH:mm:ss").alias("t"))
        parsed = df.select(
            F.to_timestamp(F.lit("2026-03-21 10:00:00"), "yyyy-MM-dd HH:mm:ss").alias("t")
        )
        assert shown.first().t == "2026-03-21 10:00:00"
        assert df.first().txn_timestamp == parsed.first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_typed_input_is_kept(spark, sample):
    typed = enforce_schema(sample)
    again = enforce_schema(typed)
    assert again.exceptAll(typed).isEmpty() and typed.exceptAll(again).isEmpty()
    ntz = typed.withColumn("txn_timestamp", F.col("txn_timestamp").cast("timestamp_ntz"))
    assert enforce_schema(ntz).exceptAll(typed).isEmpty()


def test_bad_values_become_null_under_ansi(spark, sample):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    odd = sample.withColumns(
        {
            "txn_hour": F.lit("noon"),
            "amount": F.lit("much"),
            "is_anomaly": F.lit("maybe"),
            "txn_date": F.lit("yesterday"),
        }
    )
    row = enforce_schema(odd).first()
    assert (row.txn_hour, row.amount, row.is_anomaly, row.txn_date) == (None,) * 4


def test_numeric_ids_become_text(sample):
    row = enforce_schema(sample.withColumn("txn_id", F.lit(42))).first()
    assert row.txn_id == "42"


def test_date_from_event(bronze_rows):
    late = bronze_rows({"txn_timestamp": "2026-03-20 23:59:00", "txn_date": "2026-03-21"})
    assert enforce_schema(late).first().txn_date == dt.date(2026, 3, 21)
    assert enforce_schema(late, date_from_event=True).first().txn_date == dt.date(2026, 3, 20)


# --- nulls ----------------------------------------------------------------------------


@pytest.mark.parametrize("column", s.CRITICAL_COLUMNS)
def test_critical_null_drops_the_row(typed_rows, column):
    df = typed_rows({"txn_id": "keep"}, {"txn_id": "drop", column: None})
    assert ids(handle_nulls(df)) == ["keep"]


def test_nan_amount_counts_as_missing(typed_rows):
    df = typed_rows({"txn_id": "keep"}, {"txn_id": "drop", "amount": float("nan")})
    kept = handle_nulls(df)
    assert ids(kept) == ["keep"]
    reference = df.na.drop(subset=list(s.CRITICAL_COLUMNS))
    assert ids(reference) == ids(kept)


def test_optional_columns_never_drop_a_row(typed_rows):
    optional = [c for c in s.BRONZE.names if c not in s.CRITICAL_COLUMNS]
    df = typed_rows(*[{"txn_id": c, c: None} for c in optional])
    assert ids(handle_nulls(df)) == sorted(optional)


def test_fill_values(sample):
    rows = handle_nulls(enforce_schema(sample)).collect()
    assert not [r for r in rows if r.failure_reason is None]
    plain = [r for r in rows if r.txn_id == "txn_001"][0]
    assert (plain.failure_reason, plain.merchant_category, plain.merchant_name) == (
        "N/A",
        "UNKNOWN",
        "UNKNOWN",
    )


def test_null_filters_reach_the_scan(spark, sample, tmp_path):
    path = str(tmp_path / "b")
    sample.write.parquet(path)
    plan = plan_of(drop_critical_nulls(enforce_schema(spark.read.parquet(path))))
    assert "PushedFilters: [IsNotNull(txn_id), IsNotNull(amount), IsNotNull(status)]" in plan


# --- duplicates -----------------------------------------------------------------------


def test_exact_duplicate(sample):
    assert ids(deduplicate(enforce_schema(sample))) == ["txn_001", "txn_002", "txn_003"]


def test_earliest_copy_wins(typed_rows):
    df = typed_rows(
        {"txn_timestamp": "2026-03-21 10:05:00", "amount": 2.0},
        {"txn_timestamp": "2026-03-21 10:00:00", "amount": 1.0},
    )
    assert [r.amount for r in deduplicate(df).collect()] == [1.0]


def test_tied_copies_resolve_the_same_way_in_any_order(typed_rows):
    copies = [{"amount": float(a), "utr_number": f"U{a % 3}"} for a in range(1, 9)]
    chosen = set()
    for seed in range(4):
        random.Random(seed).shuffle(copies)
        chosen.add(deduplicate(typed_rows(*copies).repartition(4)).first().amount)
    assert chosen == {1.0}


def test_invalid_first_copy_takes_the_id_with_it(silver_rows):
    df = silver_rows(
        {"txn_timestamp": "2026-03-21 10:00:00", "amount": -5.0},
        {"txn_timestamp": "2026-03-21 10:01:00", "amount": 5.0},
    )
    assert ids(df) == []


def test_incomplete_first_copy_does_not_shadow_a_later_one(silver_rows):
    df = silver_rows(
        {"txn_timestamp": "2026-03-21 10:00:00", "status": None},
        {"txn_timestamp": "2026-03-21 10:01:00"},
    )
    assert [r.txn_timestamp.minute for r in df.collect()] == [1]


def test_duplicates_shrink_before_the_shuffle(typed_rows):
    plan = plan_of(deduplicate(typed_rows({})))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_a_flooding_key_shuffles_one_row_per_task(spark, sample, tmp_path):
    """One id holds a third of all rows; its copies must not reach the reducer."""
    n, files = 3000, 4
    path = str(tmp_path / "b")
    (
        spark.range(0, n, 1, files)
        .select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
            F.col("id").alias("at"),
        )
        .write.parquet(path)
    )
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 * 1024 * 1024))
    df = deduplicate(spark.read.parquet(path), keys=("k",), order_by=("at",))
    (sent,) = shuffled_records(df)
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sent == n - n // 3 + files
    assert df.count() == n - n // 3 + 1


# --- validation -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "change, valid",
    [
        ({}, True),
        ({"amount": 0.0}, False),
        ({"amount": 0.01}, True),
        ({"amount": -1.0}, False),
        ({"amount": 1_000_000.0}, True),
        ({"amount": 1_000_000.01}, False),
        ({"status": "PENDING"}, True),
        ({"status": "FAILED"}, True),
        ({"status": "success"}, False),
        ({"status": "REVERSED"}, False),
        ({"txn_type": "P2M"}, True),
        ({"txn_type": "p2p"}, False),
        ({"txn_type": None}, False),
        ({"sender_vpa": "nohandle"}, False),
        ({"sender_vpa": "@"}, True),
        ({"sender_vpa": None}, False),
        ({"receiver_vpa": "nohandle"}, False),
        ({"receiver_vpa": None}, False),
    ],
)
def test_validation_rules(typed_rows, change, valid):
    df = typed_rows(change)
    assert (validate(df).count() == 1) is valid
    audit = validation_audit(df).first().asDict()
    failed = [k for k, v in audit.items() if k.startswith("failed_") and v]
    assert audit["input_rows"] == 1 and audit["output_rows"] == int(valid)
    assert bool(failed) is not valid


def test_sample_amounts_are_valid(sample):
    assert validate(enforce_schema(sample)).count() == 4


def test_empty_input(bronze_rows):
    empty = bronze_rows()
    assert cleaned(empty).count() == 0
    assert silver(empty).columns == s.SILVER.names
    audit = validation_audit(cleaned(empty)).first()
    assert audit.input_rows == 0 and audit.failed_known_status == 0
