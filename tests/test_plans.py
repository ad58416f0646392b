import datetime as dt

import pytest

from paytide import schema as s
from paytide.operators import views
from paytide.operators.summaries import SUMMARIES
from paytide.plans.export import run_export
from paytide.plans.gold import run_gold
from paytide.plans.pipeline import Paths, run_pipeline
from paytide.plans.silver import run_silver, silver
from paytide.sources import lake, warehouse


@pytest.fixture
def paths(tmp_path):
    return Paths(*[str(tmp_path / layer) for layer in ("bronze", "silver", "gold")])


def rows_of(df):
    return sorted((tuple(r) for r in df.drop("processed_at").collect()), key=str)


def test_silver_run_reports_counters(spark, sample, bronze_rows, paths):
    bad = bronze_rows({"txn_id": "bad", "amount": 0.0}, {"txn_id": "null", "status": None})
    lake.append_bronze(sample.union(bad), paths.bronze)
    report = run_silver(spark, paths.bronze, paths.silver)
    assert report["bronze_rows"] == 6
    assert report["input_rows"] == 4 and report["output_rows"] == 3
    assert report["failed_amount_positive"] == 1 and report["failed_known_type"] == 0
    assert report["silver_columns"] == 26
    written = lake.read_silver(spark, paths.silver)
    direct = silver(lake.read_bronze(spark, paths.bronze))
    assert rows_of(written) == rows_of(direct)


def test_reruns_change_nothing(spark, sample, paths):
    first = run_pipeline(spark, paths, batch=sample)
    before = rows_of(lake.read_gold_table(spark, paths.gold, "hourly_txn_summary"))
    again = run_pipeline(spark, paths)
    assert first == again
    after = rows_of(lake.read_gold_table(spark, paths.gold, "hourly_txn_summary"))
    assert before == after


def test_pipeline_takes_in_further_batches(spark, sample, bronze_rows, paths):
    run_pipeline(spark, paths, batch=sample, batch_date="2026-03-21")
    retry = bronze_rows(
        {"txn_id": "txn_001", "txn_timestamp": "2026-03-21 10:02:00"}, {"txn_id": "txn_004"}
    )
    report = run_pipeline(spark, paths, batch=retry, batch_date="2026-03-22")
    assert report["silver"]["output_rows"] == 4
    assert report["gold"] == {
        "hourly_txn_summary": 4,
        "bank_failure_analysis": 3,
        "merchant_spend_analysis": 1,
        "anomaly_summary": 1,
    }
    days = {r.txn_id: r.txn_date for r in lake.read_silver(spark, paths.silver).collect()}
    assert days["txn_001"] == dt.date(2026, 3, 21) and days["txn_004"] == dt.date(2026, 3, 22)


def test_gold_tables_equal_direct_summaries(spark, sample, paths):
    run_pipeline(spark, paths, batch=sample)
    cleaned = lake.read_silver(spark, paths.silver)
    for name, summary in SUMMARIES.items():
        stored = lake.read_gold_table(spark, paths.gold, name)
        assert stored.schema == s.GOLD[name]
        assert rows_of(stored) == rows_of(summary.of_rows(cleaned))


def test_incremental_days(spark, bronze_rows, paths):
    rows = [{"txn_id": str(d), "txn_date": f"2026-03-{d}"} for d in range(10, 14)]
    lake.append_bronze(bronze_rows(*rows), paths.bronze)
    run_silver(spark, paths.bronze, paths.silver)
    lake.append_bronze(bronze_rows({"txn_id": "new", "txn_date": "2026-03-11"}), paths.bronze)
    report = run_silver(
        spark, paths.bronze, paths.silver,
        since="2026-03-11", until="2026-03-11", incremental=True,
    )
    assert report["bronze_rows"] == 2
    kept = sorted(r.txn_id for r in lake.read_silver(spark, paths.silver).collect())
    assert kept == ["10", "11", "12", "13", "new"]
    # No stored rollup yet: all days are read, whatever the range.
    first = run_gold(spark, paths.silver, paths.gold, since="2026-03-12")
    assert first["hourly_txn_summary"] == 4


def days_and_counts(spark, paths):
    hours = lake.read_gold_table(spark, paths.gold, "hourly_txn_summary").collect()
    return {str(r.txn_date): r.total_txns for r in hours}


def test_a_range_of_gold_leaves_other_days(spark, bronze_rows, paths):
    rows = [{"txn_id": str(d), "txn_date": f"2026-03-{d}"} for d in range(10, 14)]
    lake.append_bronze(bronze_rows(*rows, {"txn_id": "x", "txn_date": None}), paths.bronze)
    run_silver(spark, paths.bronze, paths.silver)
    run_gold(spark, paths.silver, paths.gold)
    more = [{"txn_id": f"new{d}", "txn_date": f"2026-03-{d}"} for d in (11, 12, 12, 13)]
    lake.append_bronze(bronze_rows(*more), paths.bronze)
    run_silver(spark, paths.bronze, paths.silver)
    run_gold(spark, paths.silver, paths.gold, since="2026-03-12", until="2026-03-12")
    assert days_and_counts(spark, paths) == {
        "2026-03-10": 1, "2026-03-11": 1, "2026-03-12": 2, "2026-03-13": 1, "None": 1,
    }
    run_gold(spark, paths.silver, paths.gold, days=["2026-03-11"])
    assert days_and_counts(spark, paths)["2026-03-11"] == 2
    banks = lake.read_gold_table(spark, paths.gold, "bank_failure_analysis").first()
    assert (banks.total_txns, banks.total_amount) == (7, 7 * 1500.0)


def test_days_gone_from_silver_leave_gold(spark, bronze_rows, paths):
    rows = [{"txn_id": str(d), "txn_date": f"2026-03-{d}"} for d in range(10, 14)]
    lake.append_bronze(bronze_rows(*rows, {"txn_id": "x", "txn_date": None}), paths.bronze)
    run_silver(spark, paths.bronze, paths.silver)
    run_gold(spark, paths.silver, paths.gold)
    lake.drop_days(spark, paths.silver, ["2026-03-11", None, "2026-03-13", "2030-01-01"])
    run_gold(spark, paths.silver, paths.gold, until="2026-03-12")  # the 13th was not asked for
    assert days_and_counts(spark, paths).keys() == {"2026-03-10", "2026-03-12", "2026-03-13", "None"}
    run_gold(spark, paths.silver, paths.gold, days=[None])
    assert days_and_counts(spark, paths).keys() == {"2026-03-10", "2026-03-12", "2026-03-13"}


def test_a_range_of_gold_reads_no_other_day(spark, bronze_rows, paths, tmp_path):
    rows = [{"txn_id": str(d), "txn_date": f"2026-03-{d}"} for d in range(10, 13)]
    lake.append_bronze(bronze_rows(*rows), paths.bronze)
    run_pipeline(spark, paths)
    for file in (tmp_path / "silver" / "txn_date=2026-03-10").glob("*.parquet"):
        file.write_bytes(b"unreadable")
        (file.parent / f".{file.name}.crc").unlink()
    assert run_gold(spark, paths.silver, paths.gold, since="2026-03-11")["hourly_txn_summary"] == 3


def test_part_of_a_day_never_replaces_the_day(spark, paths):
    with pytest.raises(ValueError, match="event days"):
        run_silver(
            spark, paths.bronze, paths.silver,
            since="2026-03-11", incremental=True, date_from_event=True,
        )


def test_empty_bronze(spark, bronze_rows, paths):
    report = run_pipeline(spark, paths, batch=bronze_rows())
    assert report["silver"]["bronze_rows"] == 0
    assert set(report["gold"].values()) == {0}


# --- export ---------------------------------------------------------------------------


def test_prepared_columns(spark, sample, paths):
    run_pipeline(spark, paths, batch=sample)
    for name, df in lake.read_gold_tables(spark, paths.gold).items():
        out = warehouse.prepare_df(df)
        assert out.columns == [c.upper() for c in df.columns]
        kinds = dict(out.dtypes)
        assert kinds["PROCESSED_AT"] == "string"
        assert kinds.get("TXN_DATE", "string") == "string"
        assert out.count() == df.count(), name


def test_missing_date_stays_null(spark):
    df = spark.sql("select cast(null as date) as txn_date, 1 as n union all select date'2026-03-21', 2")
    rows = {r.N: r.TXN_DATE for r in warehouse.prepare_df(df).collect()}
    assert rows == {1: None, 2: "2026-03-21"}


def test_export_replaces_folders(spark, sample, paths, tmp_path):
    run_pipeline(spark, paths, batch=sample)
    target = str(tmp_path / "out")
    for _ in range(2):
        run_export(spark, paths.gold, root=target)
    assert spark.read.parquet(f"{target}/HOURLY_TXN_SUMMARY").count() == 3
    assert spark.read.parquet(f"{target}/ANOMALY_SUMMARY").count() == 1


def test_export_through_a_named_sink(spark, sample, paths):
    run_pipeline(spark, paths, batch=sample)
    run_export(spark, paths.gold, fmt="noop", options={"any": "thing"})


def test_export_to_catalog_and_presentation_order(spark, bronze_rows, paths):
    batch = bronze_rows(
        {"txn_id": "1", "txn_hour": 9, "sender_bank": "A"},
        {"txn_id": "2", "txn_hour": 7, "sender_bank": "B", "status": "FAILED"},
        {"txn_id": "3", "txn_hour": 8, "txn_date": "2026-03-22", "sender_bank": "B"},
    )
    run_pipeline(spark, paths, batch=batch)
    for _ in range(2):
        warehouse.export_to_catalog(lake.read_gold_tables(spark, paths.gold))
    tables = warehouse.load_data(spark)
    assert [r.TXN_HOUR for r in tables["HOURLY_TXN_SUMMARY"].collect()] == [7, 8, 9]
    assert [r.SENDER_BANK for r in tables["BANK_FAILURE_ANALYSIS"].collect()] == ["B", "A"]
    assert tables["MERCHANT_SPEND_ANALYSIS"].count() == 0
    volume = views.hourly_volume(tables["HOURLY_TXN_SUMMARY"])
    assert [tuple(r) for r in volume.collect()] == [
        ("2026-03-21", 7, 1),
        ("2026-03-22", 8, 1),
        ("2026-03-21", 9, 1),
    ]
    kpi = views.kpis(tables["HOURLY_TXN_SUMMARY"], tables["ANOMALY_SUMMARY"]).first()
    assert (kpi.total_txns, kpi.total_volume, kpi.total_anomalies) == (3, 4500.0, 0)


def test_silver_range_leaves_other_days(spark, bronze_rows, tmp_path):
    from paytide.plans.silver import run_silver
    from paytide.sources import lake

    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    lake.append_bronze(bronze_rows({"txn_id": "a"}, {"txn_id": "b"}), bronze, "2026-03-21")
    run_silver(spark, bronze, silver)
    run_silver(spark, bronze, silver, since="2030-01-01")
    assert lake.read_silver(spark, silver).count() == 2


def test_timestamps_of_short_fields_and_leading_blanks(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from paytide.functions.casting import conform

    texts = ["2026-3-21 9:05:00", " 2026-03-21 10:00:00", "2026-03-21 10:00:00.5", "garbage", "2026-13-21 10:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    read = conform(F.col("t"), T.StringType(), T.TimestampType()).cast("string")
    got = [r[0] for r in df.select(read).collect()]
    assert got == ["2026-03-21 09:05:00", "2026-03-21 10:00:00", "2026-03-21 10:00:00", None, None]


def test_leading_blanks_cost_no_digits(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from paytide.functions.casting import conform

    def read(texts, kind):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        return [r[0] for r in df.select(conform(F.col("t"), T.StringType(), kind).cast("string")).collect()]

    times = [" 2026-03-21 10:00:45", "   2026-03-21 10:00:45.9", "\t2026-3-21 9:05:07", " 2026-03-21"]
    assert read(times, T.TimestampType()) == [
        "2026-03-21 10:00:45",
        "2026-03-21 10:00:45",
        "2026-03-21 09:05:07",
        None,
    ]
    days = [" 2026-03-21", "  2026-03-21", "    2026-03-21 10:00:45", " 2026-3-21", " 2026-13-21"]
    assert read(days, T.DateType()) == ["2026-03-21"] * 4 + [None]
