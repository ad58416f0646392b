import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from paytide import schema as s
from paytide.operators.summaries import bank_failure_analysis
from paytide.plans.silver import silver
from paytide.sources import lake, staging
from tests.conftest import plan_of


def same(left, right):
    left, right = left.drop("processed_at"), right.drop("processed_at")
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def days(path):
    return sorted(os.path.basename(p) for p in glob.glob(f"{path}/txn_date=*"))


# --- Bronze ---------------------------------------------------------------------------


def test_bronze_batches_add_up(bronze_rows, tmp_path, spark):
    path = str(tmp_path / "bronze")
    first, second = bronze_rows({"txn_id": "1"}), bronze_rows({"txn_id": "2"})
    lake.append_bronze(first, path)
    lake.append_bronze(second, path)
    back = lake.read_bronze(spark, path)
    assert back.schema == s.BRONZE
    assert same(back, first.union(second))


def test_batch_date_is_the_folder(bronze_rows, tmp_path, spark):
    path = str(tmp_path / "bronze")
    late = {"txn_timestamp": "2026-03-20 23:59:00", "txn_date": "2026-03-20"}
    lake.append_bronze(bronze_rows(late), path, batch_date=dt.date(2026, 3, 21))
    assert days(path) == ["txn_date=2026-03-21"]
    raw = lake.read_bronze(spark, path)
    assert raw.first().txn_date == "2026-03-21"
    assert silver(raw).first().txn_date == dt.date(2026, 3, 21)
    assert silver(raw, date_from_event=True).first().txn_date == dt.date(2026, 3, 20)


def test_folder_wins_over_a_column_inside_the_file(bronze_rows, tmp_path, spark):
    path = str(tmp_path / "bronze")
    bronze_rows({"txn_date": "2026-03-20"}).write.parquet(f"{path}/txn_date=2026-03-21")
    back = lake.read_bronze(spark, path)
    assert back.columns == s.BRONZE.names
    assert back.first().txn_date == "2026-03-21"


def test_a_column_without_values_keeps_its_type(bronze_rows, tmp_path, spark):
    """Untyped nulls in one batch must not spoil the table for the others."""
    path = str(tmp_path / "bronze")
    void = bronze_rows({"txn_id": "1"}).withColumn("failure_reason", F.lit(None))
    lake.append_bronze(void, path)
    lake.append_bronze(bronze_rows({"txn_id": "2", "failure_reason": "x"}), path)
    back = lake.read_bronze(spark, path)
    assert back.schema == s.BRONZE
    assert {r.txn_id: r.failure_reason for r in back.collect()} == {"1": None, "2": "x"}


def test_bronze_range_prunes_folders(bronze_rows, tmp_path, spark):
    path = str(tmp_path / "bronze")
    rows = [{"txn_id": str(d), "txn_date": f"2026-03-{d}"} for d in range(10, 20)]
    lake.append_bronze(bronze_rows(*rows), path)
    some = lake.read_bronze(spark, path, since="2026-03-12", until=dt.date(2026, 3, 14))
    assert sorted(r.txn_id for r in some.collect()) == ["12", "13", "14"]
    assert "PartitionFilters: [isnotnull(txn_date" in plan_of(some)


# --- Silver ---------------------------------------------------------------------------


def test_silver_round_trip(silver_rows, tmp_path, spark):
    path = str(tmp_path / "silver")
    rows = silver_rows({"txn_id": "1"}, {"txn_id": "2", "txn_date": None})
    lake.write_silver(rows, path)
    back = lake.read_silver(spark, path)
    assert back.schema == s.SILVER
    assert same(back, rows)
    assert days(path) == ["txn_date=2026-03-21", "txn_date=__HIVE_DEFAULT_PARTITION__"]


def test_silver_with_null_days_only(silver_rows, tmp_path, spark):
    path = str(tmp_path / "silver")
    lake.write_silver(silver_rows({"txn_date": None}), path)
    back = lake.read_silver(spark, path)
    assert back.schema == s.SILVER and back.first().txn_date is None


def test_full_overwrite_replaces_every_day(silver_rows, tmp_path, spark):
    path = str(tmp_path / "silver")
    lake.write_silver(silver_rows({"txn_id": "1"}, {"txn_id": "2", "txn_date": "2026-03-22"}), path)
    lake.write_silver(silver_rows({"txn_id": "3"}), path)
    assert [r.txn_id for r in lake.read_silver(spark, path).collect()] == ["3"]


def test_incremental_overwrite_keeps_other_days(silver_rows, tmp_path, spark):
    path = str(tmp_path / "silver")
    lake.write_silver(silver_rows({"txn_id": "1"}, {"txn_id": "2", "txn_date": "2026-03-22"}), path)
    for _ in range(2):
        lake.write_silver(silver_rows({"txn_id": "3"}), path, incremental=True)
        kept = sorted(r.txn_id for r in lake.read_silver(spark, path).collect())
        assert kept == ["2", "3"]


def test_compaction_writes_few_files_per_day(silver_rows, tmp_path, spark):
    rows = silver_rows(
        *[{"txn_id": str(i), "txn_date": f"2026-03-{10 + i % 5}"} for i in range(200)]
    ).repartition(16)
    loose, tight = str(tmp_path / "loose"), str(tmp_path / "tight")
    lake.write_silver(rows, loose, compact=False)
    lake.write_silver(rows, tight)
    assert len(glob.glob(f"{loose}/*/*.parquet")) > 50
    assert len(glob.glob(f"{tight}/*/*.parquet")) == 5
    assert same(lake.read_silver(spark, loose), lake.read_silver(spark, tight))


def test_a_heavy_day_is_split_over_tasks(silver_rows, tmp_path, spark):
    """One day with nearly all rows may not become a single task."""
    rows = silver_rows(
        *[{"txn_id": str(i), "txn_date": "2026-03-10"} for i in range(3000)],
        {"txn_id": "x", "txn_date": "2026-03-11"},
    ).repartition(8)
    path = str(tmp_path / "silver")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    # Keeps the tiny input on several map tasks, as it would be with real sizes.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lake.write_silver(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(glob.glob(f"{path}/txn_date=2026-03-10/*.parquet")) > 1
    assert lake.read_silver(spark, path).count() == 3001


# --- Gold -----------------------------------------------------------------------------


def test_gold_write_counts_and_replaces(silver_rows, tmp_path, spark):
    root = str(tmp_path / "gold")
    table = "bank_failure_analysis"
    two = bank_failure_analysis(silver_rows({"txn_id": "1"}, {"txn_id": "2", "sender_bank": "A"}))
    assert lake.write_gold_table(two, root, table) == 2
    assert lake.write_gold_table(two.limit(1), root, table) == 1
    assert lake.read_gold_table(spark, root, table).schema == s.GOLD[table]
    assert lake.read_gold_table(spark, root, table).count() == 1


def test_gold_write_of_nothing(silver_rows, tmp_path, spark):
    root = str(tmp_path / "gold")
    assert lake.write_gold_table(bank_failure_analysis(silver_rows()), root, "bank_failure_analysis") == 0
    assert lake.read_gold_table(spark, root, "bank_failure_analysis").count() == 0


# --- scratch --------------------------------------------------------------------------


def test_scratch_lies_in_the_configured_folder(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert staging.shared_dir(spark) == named
    one, two = staging.scratch_path(spark, "x"), staging.scratch_path(spark, "x")
    assert one.startswith(named) and one != two


def test_staged_cuts_the_plan(spark):
    df = staging.staged(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count())
    assert "FileScan" in plan_of(df) and "Exchange" not in plan_of(df)
    assert df.count() == 3


class _Cluster:
    """A session that names no shared folder and is not local."""

    class sparkContext:
        master = "spark://somewhere:7077"

        @staticmethod
        def getConf():
            return {}

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_dir(_Cluster())


# --- evolving Bronze ------------------------------------------------------------------


def test_undeclared_columns_are_kept(bronze_rows, tmp_path, spark):
    path = str(tmp_path / "bronze")
    lake.append_bronze(bronze_rows({"txn_id": "1"}), path)
    assert lake.read_bronze(spark, path, extras=True).columns == s.BRONZE.names
    more = bronze_rows({"txn_id": "2"}).withColumns({"risk": F.lit(0.5), "a b": F.lit("x"), "nothing": F.lit(None)})
    lake.append_bronze(more, path)
    other = bronze_rows({"txn_id": "3"}).withColumns({"RISK": F.lit("0.25"), "risky": F.lit(7)})
    lake.append_bronze(other, path)
    unfit = bronze_rows({"txn_id": "4"}).withColumn("risk", F.lit("high"))
    lake.append_bronze(unfit, path)
    back = lake.read_bronze(spark, path, extras=True)
    assert back.columns == [*s.BRONZE.names, "a b", "nothing", "risk", "risky"]
    rows = {r.txn_id: (r["a b"], r.nothing, r.risk, r.risky) for r in back.collect()}
    assert rows == {
        "1": (None,) * 4, "2": ("x", None, 0.5, None), "3": (None, None, 0.25, 7), "4": (None,) * 4,
    }
    assert lake.read_bronze(spark, path).schema == s.BRONZE
    assert "risk" in silver(back).columns


def test_missing_columns_become_null(bronze_rows, tmp_path, spark):
    path = str(tmp_path / "bronze")
    lake.append_bronze(bronze_rows({"txn_id": "1"}).drop("merchant_name", "amount"), path)
    row = lake.read_bronze(spark, path).first()
    assert (row.txn_id, row.merchant_name, row.amount) == ("1", None, None)


def test_files_that_do_not_agree(bronze_rows, tmp_path, spark):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "bronze")
    assert lake.read_mixed(spark, _made(landing)).count() == 0
    plain = bronze_rows({"txn_id": "1"}, {"txn_id": "2", "txn_date": None})
    empty = plain.withColumns({c: F.lit(None).cast("int") for c in ("failure_reason", "merchant_name", "note")})
    failed = bronze_rows({"txn_id": "3", "status": "FAILED", "failure_reason": "No cover"}).withColumns(
        {"note": F.lit("late"), "amount": F.col("amount").cast("string"), "score": F.lit(3)}
    )
    for df in (empty, failed.drop("device_type")):
        df.write.mode("append").partitionBy("txn_date").parquet(landing)
    with pytest.raises(Exception):  # what the plain scan makes of it
        lake.read_bronze(spark, landing).collect()
    mixed = lake.read_mixed(spark, landing)
    assert mixed.columns == [*s.BRONZE.names, "note", "score"]
    rows = {r.txn_id: (r.failure_reason, r.note, r.score, r.amount, r.txn_date, r.device_type) for r in mixed.collect()}
    assert rows == {
        "1": (None, None, None, 1500.0, "2026-03-21", "Android"),
        "2": (None, None, None, 1500.0, None, "Android"),
        "3": ("No cover", "late", 3, 1500.0, "2026-03-21", None),
    }
    lake.append_bronze(mixed, path)
    assert lake.read_bronze(spark, path).count() == 3


def _made(path):
    os.makedirs(path)
    return path


# --- what conversion loses ------------------------------------------------------------


def test_lost_values_are_counted_and_kept(spark, bronze_rows):
    from pyspark.sql import Observation

    from paytide.operators.cleansing import enforce_schema

    texts = {
        "amount": ["12.5", " 7 ", "n/a", "", None, "1e3"],
        "txn_hour": ["13", "7.9", "noon", "99999999999", None, "-4."],
        "is_anomaly": ["true", "F", "maybe", "2", None, "1"],
        "txn_timestamp": ["2026-03-21 10:00:00", "2026-3-1 1:02:03", "x", "", None, "2026-13-01 00:00:00"],
    }
    rows = [{c: v[i] for c, v in texts.items()} for i in range(6)]
    names = s.BRONZE.names
    raw = spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], ", ".join(f"{c} string" for c in names))
    lost = Observation("lost")
    typed = enforce_schema(raw, keep_raw="raw_values", losses=lost)
    assert typed.columns == [*names, "raw_values"]
    got = typed.collect()
    assert [r.amount for r in got] == [12.5, 7.0, None, None, None, 1000.0]
    assert [r.txn_hour for r in got] == [13, 7, None, None, None, -4]
    assert [r.is_anomaly for r in got] == [True, False, None, None, None, True]
    assert [r.raw_values for r in got] == [
        None,
        None,
        {"txn_timestamp": "x", "txn_hour": "noon", "amount": "n/a", "is_anomaly": "maybe"},
        {"txn_timestamp": "", "txn_hour": "99999999999", "amount": "", "is_anomaly": "2"},
        None,
        {"txn_timestamp": "2026-13-01 00:00:00"},
    ]
    assert lost.get == {"lost_txn_timestamp": 3, "lost_txn_date": 0, "lost_txn_hour": 2, "lost_amount": 2, "lost_is_anomaly": 2}
    from paytide.operators.audit import conversion_audit

    audited = {r.column_name: (r.n_values, r.n_lost) for r in conversion_audit(raw).collect()}
    assert audited["txn_timestamp"] == (5, 3) and audited["amount"] == (5, 2) and audited["txn_id"] == (0, 0)
    assert list(audited) == names


def test_silver_run_counts_lost_values(spark, bronze_rows, tmp_path):
    from paytide.plans.silver import run_silver

    bronze_path, silver_path = str(tmp_path / "b"), str(tmp_path / "s")
    lake.append_bronze(bronze_rows({"txn_id": "1"}, {"txn_id": "2", "txn_timestamp": "x"}), bronze_path)
    report = run_silver(spark, bronze_path, silver_path)
    assert report["lost_txn_timestamp"] == 1 and report["lost_txn_hour"] == 0
