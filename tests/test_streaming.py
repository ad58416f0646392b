import datetime as dt
import random

import pytest

from paytide.operators.summaries import SUMMARIES
from paytide.plans.silver import silver
from paytide.sources import lake
from paytide.sources.id_index import IdIndex
from paytide.streaming.hourly import (
    present_hours,
    read_hours,
    start_hourly,
    start_live_hours,
    update_hours,
)
from paytide.streaming.ingest import read_live, settle, start_ingest


@pytest.fixture
def folders(tmp_path):
    return [str(tmp_path / name) for name in ("bronze", "out", "checkpoint")]


def at(minutes):
    moment = dt.datetime(2026, 3, 21) + dt.timedelta(minutes=minutes)
    return {
        "txn_timestamp": moment.strftime("%Y-%m-%d %H:%M:%S"),
        "txn_date": moment.strftime("%Y-%m-%d"),
        "txn_hour": moment.hour,
    }


def ids(spark, path):
    return sorted(r.txn_id for r in read_live(spark, path).collect())


def test_stream_equals_batch(spark, bronze_rows, folders):
    bronze, out, checkpoint = folders
    rng = random.Random(2)
    records = []
    for i in range(300):
        change = {"txn_id": f"t{i}", "amount": float(rng.randrange(-20, 2000)), **at(i)}
        if i % 11 == 0:
            change["status"] = None
        if i % 13 == 0:
            change["txn_timestamp"] = "garbage"
        records.append(change)
    lake.append_bronze(bronze_rows(*records), bronze)
    start_ingest(spark, bronze, out, checkpoint).awaitTermination()
    live = read_live(spark, out).drop("processed_at")
    batch = silver(lake.read_bronze(spark, bronze)).drop("processed_at")
    assert live.exceptAll(batch).isEmpty() and batch.exceptAll(live).isEmpty()


def test_repeats_are_dropped_across_batches(spark, bronze_rows, folders):
    bronze, out, checkpoint = folders
    lake.append_bronze(
        bronze_rows({"txn_id": "a", **at(0)}, {"txn_id": "a", **at(1)}, {"txn_id": "b", **at(2)}),
        bronze,
    )
    start_ingest(spark, bronze, out, checkpoint).awaitTermination()
    lake.append_bronze(
        bronze_rows({"txn_id": "a", **at(3)}, {"txn_id": "c", **at(4)}), bronze
    )
    start_ingest(spark, bronze, out, checkpoint).awaitTermination()
    assert ids(spark, out) == ["a", "b", "c"]


def test_restart_without_news_adds_nothing(spark, bronze_rows, folders):
    bronze, out, checkpoint = folders
    lake.append_bronze(bronze_rows({"txn_id": "a", **at(0)}), bronze)
    for _ in range(3):
        start_ingest(spark, bronze, out, checkpoint).awaitTermination()
    assert ids(spark, out) == ["a"]


def test_invalid_first_copy_also_takes_the_id_in_a_stream(spark, bronze_rows, folders):
    bronze, out, checkpoint = folders
    for change in ({"amount": -1.0, **at(0)}, {"amount": 1.0, **at(1)}):
        lake.append_bronze(bronze_rows({"txn_id": "a", **change}), bronze)
        start_ingest(spark, bronze, out, checkpoint).awaitTermination()
    assert ids(spark, out) == []


def test_flooding_id(spark, bronze_rows, folders):
    """A third of the rows repeat one id."""
    bronze, out, checkpoint = folders
    records = [
        {"txn_id": "hot" if i % 3 == 0 else f"t{i}", **at(i % 60)} for i in range(600)
    ]
    lake.append_bronze(bronze_rows(*records).repartition(8), bronze)
    start_ingest(spark, bronze, out, checkpoint).awaitTermination()
    assert len(ids(spark, out)) == 401


def test_hours_close_with_the_watermark(spark, bronze_rows, folders):
    bronze, out, checkpoint = folders
    records = [
        {"txn_id": f"t{i}", "amount": float(i), "status": "FAILED" if i % 4 == 0 else "SUCCESS", **at(i)}
        for i in range(1, 300)
    ]
    lake.append_bronze(bronze_rows(*records), bronze)
    start_hourly(spark, bronze, out, checkpoint).awaitTermination()
    live = present_hours(spark.read.parquet(out), with_processed_at=False)
    # The last event is at 04:59, so the watermark is 02:59 and two hours are closed.
    batch = SUMMARIES["hourly_txn_summary"].of_rows(
        silver(lake.read_bronze(spark, bronze)), with_processed_at=False
    )
    closed = [r for r in batch.collect() if r.txn_hour < 2]
    assert live.collect() == closed

    later = [{"txn_id": "late", **at(10)}, {"txn_id": "news", **at(600)}]
    lake.append_bronze(bronze_rows(*later), bronze)
    start_hourly(spark, bronze, out, checkpoint).awaitTermination()
    live = present_hours(spark.read.parquet(out), with_processed_at=False)
    hours = [(r.txn_hour, r.total_txns) for r in live.collect()]
    assert hours == [(0, 59), (1, 60), (2, 60), (3, 60), (4, 60)]


def test_small_steps_equal_one_step(spark, bronze_rows, folders):
    bronze, out, checkpoint = folders
    for batch in range(4):
        records = [
            {"txn_id": f"t{i}", "amount": float(i + 1), **at(20 * batch + i % 20)}
            for i in range(10 * batch, 10 * batch + 25)
        ]
        lake.append_bronze(bronze_rows(*records), bronze, batch_date="2026-03-21")
    start_ingest(
        spark, bronze, out, checkpoint, max_files_per_trigger=1
    ).awaitTermination()
    assert ids(spark, out) == sorted(f"t{i}" for i in range(55))


def test_hours_of_a_zone_off_by_half_an_hour(spark, bronze_rows, folders):
    bronze, out, checkpoint = folders
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        records = [{"txn_id": f"t{i}", **at(i)} for i in range(300)]
        lake.append_bronze(bronze_rows(*records), bronze)
        start_hourly(
            spark, bronze, out, checkpoint, window_offset="30 minutes"
        ).awaitTermination()
        live = present_hours(spark.read.parquet(out), with_processed_at=False)
        hours = [(str(r.txn_date), r.txn_hour, r.total_txns) for r in live.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert hours == [("2026-03-21", 0, 60), ("2026-03-21", 1, 60)]


def test_late_rows_and_late_repeats_end_as_in_batch(spark, bronze_rows, folders, tmp_path):
    """One file per trigger, far out of order; a repeat a day later; a late earlier copy."""
    bronze, out, checkpoint = folders
    day = 24 * 60
    steps = [
        [{"txn_id": "a", **at(600)}, {"txn_id": "x", "amount": 5.0, **at(600)}],
        [{"txn_id": "b", **at(1200)}],
        [{"txn_id": "c", **at(1320)}],
        [{"txn_id": "late", **at(720)}],
        [{"txn_id": "a", "amount": 7.0, **at(600 + day)}],
        [{"txn_id": "x", "amount": -5.0, **at(60)}, {"txn_id": "b", "amount": 3.0, **at(30)}],
    ]
    for records in steps:
        lake.append_bronze(bronze_rows(*records).coalesce(1), bronze)
        start_ingest(
            spark, bronze, out, checkpoint, max_files_per_trigger=1
        ).awaitTermination()
    settled = str(tmp_path / "settled")
    settle(spark, out, settled)
    batch = silver(lake.read_bronze(spark, bronze)).drop("processed_at")
    assert ids(spark, out) == ["a", "b", "c", "late"]
    for live in (read_live(spark, out), lake.read_silver(spark, settled)):
        live = live.drop("processed_at")
        assert live.exceptAll(batch).isEmpty() and batch.exceptAll(live).isEmpty()


def test_another_query_on_the_same_log_replaces_nothing(spark, bronze_rows, folders, tmp_path):
    bronze, out, checkpoint = folders
    lake.append_bronze(bronze_rows({"txn_id": "a", **at(0)}), bronze)
    start_ingest(spark, bronze, out, checkpoint).awaitTermination()
    other = str(tmp_path / "other")
    lake.append_bronze(bronze_rows({"txn_id": "b", **at(1)}), other)
    start_ingest(spark, other, out, str(tmp_path / "checkpoint2")).awaitTermination()
    assert ids(spark, out) == ["a", "b"]


# --- bounded log ----------------------------------------------------------------------


def data_files(folder):
    import pathlib

    return len(list(pathlib.Path(folder).rglob("*.parquet")))


def test_settling_takes_batches_out_of_the_log(spark, bronze_rows, folders, tmp_path):
    """Ten batches with late and earlier copies: files do not grow with them, days that no
    batch touches are not rewritten, and nothing is lost in between."""
    bronze, out, checkpoint = folders
    silver_path, day, counted = str(tmp_path / "settled"), 24 * 60, []
    for step in range(10):
        records = [{"txn_id": f"s{step}-{i}", "amount": float(i + 1), **at(day * (step % 3) + i)} for i in range(8)]
        if step > 2:
            records += [
                {"txn_id": "s1-3", "amount": 99.0, **at(day - step)},  # earlier each time
                {"txn_id": "s0-2", "amount": 98.0, **at(4 * day)},  # too late to count
            ]
        lake.append_bronze(bronze_rows(*records).coalesce(1), bronze)
        start_ingest(spark, bronze, out, checkpoint).awaitTermination()
        if step % 2:
            settle(spark, out, silver_path, buckets=2)
            counted.append(data_files(out))
        live = read_live(spark, out).drop("processed_at")
        batch = silver(lake.read_bronze(spark, bronze)).drop("processed_at")
        assert live.exceptAll(batch).isEmpty() and batch.exceptAll(live).isEmpty()
    settled = lake.read_silver(spark, silver_path).drop("processed_at")
    assert settled.exceptAll(batch).isEmpty() and batch.exceptAll(settled).isEmpty()
    assert not list((tmp_path / "out").rglob("batch_id=*/*.parquet")) and max(counted) <= 40
    assert settle(spark, out, silver_path) == 0


def test_settling_leaves_unfinished_batches_and_other_days(spark, bronze_rows, folders, tmp_path):
    bronze, out, checkpoint = folders
    silver_path = str(tmp_path / "settled")
    lake.append_bronze(bronze_rows({"txn_id": "a", **at(0)}, {"txn_id": "b", **at(2000)}), bronze)
    start_ingest(spark, bronze, out, checkpoint).awaitTermination()
    settle(spark, out, silver_path)
    first = sorted((tmp_path / "settled" / "txn_date=2026-03-21").glob("*.parquet"))
    lake.append_bronze(bronze_rows({"txn_id": "c", **at(2001)}), bronze)
    start_ingest(spark, bronze, out, checkpoint).awaitTermination()
    marker = next((tmp_path / "out").glob("query_id=*/batch_id=*/_SUCCESS"))
    marker.unlink()
    assert settle(spark, out, silver_path) == 0
    marker.touch()
    assert settle(spark, out, silver_path) == 1
    assert sorted((tmp_path / "settled" / "txn_date=2026-03-21").glob("*.parquet")) == first
    assert sorted(r.txn_id for r in lake.read_silver(spark, silver_path).collect()) == ["a", "b", "c"]


# --- hours that correct themselves ----------------------------------------------------


def hours_of(spark, path):
    return present_hours(read_hours(spark, path), with_processed_at=False).collect()


def hours_of_batch(spark, bronze):
    """Hours of event time of the batch Silver."""
    from pyspark.sql import functions as F

    rows = silver(lake.read_bronze(spark, bronze)).withColumns(
        {"txn_date": F.to_date("txn_timestamp"), "txn_hour": F.hour("txn_timestamp")}
    )
    return SUMMARIES["hourly_txn_summary"].of_rows(rows, with_processed_at=False).collect()


def test_hours_take_late_rows_and_earlier_copies(spark, bronze_rows, folders, tmp_path):
    bronze, hours, checkpoint = folders
    index, day = str(tmp_path / "index"), 24 * 60
    steps = [
        [{"txn_id": f"t{i}", "amount": 10.25 * i + 1, **at(7 * i)} for i in range(60)],
        [{"txn_id": "late", "amount": 5.5, **at(61)}, {"txn_id": "news", **at(3 * day)}],
        # An earlier copy of the largest of its hour: both hours change, one loses its maximum.
        [{"txn_id": "t59", "amount": 3.0, **at(1)}],
        # An earlier copy that breaks a rule: the id leaves its hour and enters none.
        [{"txn_id": "news", "amount": -1.0, **at(2)}, {"txn_id": "t8", "amount": 4.0, **at(55)}],
        [{"txn_id": "t3", "amount": 1e6, **at(5 * day)}],  # a later copy: nothing
        [{"txn_id": "t0", "status": None, **at(0)}],
    ]
    for records in steps:
        lake.append_bronze(bronze_rows(*records).coalesce(1), bronze)
        start_live_hours(spark, bronze, hours, index, checkpoint, buckets=2).awaitTermination()
        assert hours_of(spark, hours) == hours_of_batch(spark, bronze)
    assert len(list((tmp_path / "out").glob("version=*"))) == 2


def test_a_repeated_micro_batch_gives_the_same_hours(spark, typed_rows, tmp_path):
    from paytide.operators.cleansing import handle_nulls

    hours, index = str(tmp_path / "hours"), IdIndex(spark, str(tmp_path / "index"), buckets=2)

    def rows(*records):
        return typed_rows(*records).transform(handle_nulls)

    update_hours(rows({"txn_id": "a", "amount": 9.0, **at(70)}, {"txn_id": "b", **at(80)}), hours, index, 0, "q-0")
    change = rows({"txn_id": "a", "amount": 2.0, **at(5)}, {"txn_id": "c", "amount": 3.0, **at(90)})
    found = []
    for _ in range(3):
        update_hours(change, hours, index, 1, "q-1")
        found.append(hours_of(spark, hours))
    assert found[0] == found[1] == found[2]
    assert [(r.txn_hour, r.total_txns, r.total_amount, r.max_amount) for r in found[0]] == [
        (0, 1, 2.0, 2.0),
        (1, 2, 1503.0, 1500.0),
    ]


def test_no_hours_yet(spark, bronze_rows, folders, tmp_path):
    bronze, hours, checkpoint = folders
    lake.append_bronze(bronze_rows({"txn_id": "a", "amount": -1.0, **at(0)}), bronze)
    start_live_hours(spark, bronze, hours, str(tmp_path / "index"), checkpoint).awaitTermination()
    assert hours_of(spark, hours) == []
    assert hours_of(spark, str(tmp_path / "nowhere")) == []
