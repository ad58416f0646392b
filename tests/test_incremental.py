"""Incremental runs against full rebuilds, and what they read."""

import random

import numpy as np
import pytest

from paytide.functions.bloom import bloom, holds
from paytide.operators.cleansing import enforce_schema, handle_nulls
from paytide.plans.incremental import run_incremental
from paytide.plans.pipeline import Paths, run_pipeline
from paytide.plans.silver import cleaned
from paytide.sources import lake
from paytide.sources.id_index import IdIndex

GOLD = ("hourly_txn_summary", "bank_failure_analysis", "merchant_spend_analysis", "anomaly_summary")


def paths_below(root):
    return Paths(*[str(root / x) for x in ("bronze", "silver", "gold", "index")])


def rows_of(df):
    return sorted((tuple(r) for r in df.drop("processed_at").collect()), key=str)


def spoil(folder):
    """Make the data files below a folder unreadable."""
    files = list(folder.rglob("*.parquet"))
    for file in files:
        file.write_bytes(b"unreadable")
        (file.parent / f".{file.name}.crc").unlink()
    return len(files)


def batch_of(draw, day, known):
    """A day's records: new ids, later and earlier copies of known ones, and bad rows."""
    records = []
    for i in range(40):
        old = known and draw.random() < 0.4
        id_ = draw.choice(known) if old else f"t{day}-{i}"
        known.append(id_)
        records.append(
            {
                "txn_id": id_ if draw.random() > 0.05 else None,
                "txn_timestamp": f"2026-03-{draw.randint(10, day):02d} {draw.randint(0, 23):02d}:00:00",
                "txn_hour": draw.randint(0, 23),
                "amount": draw.choice([10.5, 700.25, 60_000.0, -1.0]),
                "status": draw.choice(["SUCCESS", "FAILED", "PENDING", "REVERSED", None]),
                "txn_type": draw.choice(["P2P", "P2M"]),
                "sender_bank": draw.choice(["A", "B", None]),
                "is_anomaly": draw.choice([True, False]),
            }
        )
    return records


def assert_same(spark, paths, other):
    assert rows_of(lake.read_silver(spark, paths.silver)) == rows_of(lake.read_silver(spark, other.silver))
    for name in GOLD:
        ours, theirs = (lake.read_gold_table(spark, p.gold, name) for p in (paths, other))
        assert rows_of(ours) == rows_of(theirs), name


def test_runs_equal_a_rebuild(spark, bronze_rows, tmp_path):
    draw, known, paths = random.Random(4), [], paths_below(tmp_path)
    rebuilt = Paths(paths.bronze, str(tmp_path / "silver2"), str(tmp_path / "gold2"))
    for step, day in enumerate([12, 13, 15, 14]):
        batch = bronze_rows(*batch_of(draw, day, known))
        run_incremental(spark, paths, batch, f"2026-03-{day}", buckets=4)
        if step:
            run_pipeline(spark, rebuilt)
            assert_same(spark, paths, rebuilt)
    winners = rows_of(IdIndex(spark, paths.index).winners())
    assert winners == rows_of(cleaned(lake.read_bronze(spark, paths.bronze)))
    again = run_incremental(spark, paths, days=["2026-03-13"])  # nothing new
    assert again["changed_ids"] == 0 and again["touched_days"] == 0
    assert_same(spark, paths, rebuilt)


def test_a_day_that_loses_all_rows_goes(spark, bronze_rows, tmp_path):
    paths = paths_below(tmp_path)
    run_incremental(spark, paths, bronze_rows({"txn_id": "a", "txn_timestamp": "2026-03-21 10:00:00"}), "2026-03-21")
    earlier = bronze_rows({"txn_id": "a", "txn_timestamp": "2026-03-20 10:00:00", "txn_date": None})
    run_incremental(spark, paths, earlier)
    assert [r.txn_date for r in lake.read_silver(spark, paths.silver).collect()] == [None]
    assert [r.txn_date for r in lake.read_gold_table(spark, paths.gold, GOLD[0]).collect()] == [None]
    invalid = bronze_rows({"txn_id": "a", "txn_timestamp": "2026-03-19 10:00:00", "amount": -1.0})
    run_incremental(spark, paths, invalid, "2026-03-22")
    assert lake.read_silver(spark, paths.silver).count() == 0
    assert lake.read_gold_table(spark, paths.gold, GOLD[1]).count() == 0


def test_days_that_are_no_dates(spark, bronze_rows, tmp_path):
    paths = paths_below(tmp_path)
    run_incremental(spark, paths, bronze_rows({"txn_id": "a"}))
    run_incremental(spark, paths, bronze_rows({"txn_id": "b", "txn_date": "21/03"}, {"txn_id": "c", "txn_date": "2026-3-2"}))
    run_incremental(spark, paths, bronze_rows({"txn_id": "d"}).drop("txn_date"))
    rebuilt = Paths(paths.bronze, str(tmp_path / "silver2"), str(tmp_path / "gold2"))
    run_pipeline(spark, rebuilt)
    assert_same(spark, paths, rebuilt)
    assert lake.read_silver(spark, paths.silver).count() == 4


def test_other_days_are_not_read(spark, bronze_rows, tmp_path):
    paths = paths_below(tmp_path)

    def day(number, ids):
        records = [{"txn_id": i, "txn_timestamp": f"2026-03-{number} 10:00:00"} for i in ids]
        return run_incremental(spark, paths, bronze_rows(*records), f"2026-03-{number}", buckets=4)

    day(10, [f"a{i}" for i in range(50)])
    day(11, [f"b{i}" for i in range(50)])
    runs = set(IdIndex(spark, paths.index).runs())
    day(12, [f"c{i}" for i in range(50)])
    other_days = [tmp_path / layer / f"txn_date=2026-03-{d}" for layer in ("bronze", "silver") for d in (10, 11)]
    copies = [next((tmp_path / "index").glob("buckets=4/copies")) / f"run={r}" for r in runs]
    assert all(spoil(folder) for folder in other_days + copies)
    report = day(13, [f"d{i}" for i in range(50)] + ["c7", "c8"])  # two later copies of the 12th
    assert report["touched_days"] == 1 and report["changed_ids"] == 50
    totals = lake.read_gold_table(spark, paths.gold, GOLD[0]).collect()
    assert [r.total_txns for r in totals] == [50, 50, 50, 50]


def test_a_repeated_half_run_changes_nothing(spark, bronze_rows, tmp_path, monkeypatch):
    paths = paths_below(tmp_path)
    first = [{"txn_id": f"t{i}", "txn_timestamp": "2026-03-21 10:00:00"} for i in range(9)]
    run_incremental(spark, paths, bronze_rows(*first), "2026-03-21")
    earlier = [{"txn_id": f"t{i}", "txn_timestamp": "2026-03-21 09:00:00", "amount": 7.0} for i in range(3)]

    def lost(self, run, added):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(IdIndex, "commit", lost)
        with pytest.raises(RuntimeError, match="lost"):
            run_incremental(spark, paths, bronze_rows(*earlier), "2026-03-22")
    report = run_incremental(spark, paths, days=["2026-03-22"])
    assert report["changed_ids"] == 3
    rebuilt = Paths(paths.bronze, str(tmp_path / "silver2"), str(tmp_path / "gold2"))
    run_pipeline(spark, rebuilt)
    assert_same(spark, paths, rebuilt)


def test_runs_are_merged(spark, typed_rows, tmp_path):
    index = IdIndex(spark, str(tmp_path / "index"), buckets=2)
    for step in range(9):
        rows = typed_rows(
            {"txn_id": "same", "txn_timestamp": f"2026-03-{20 - step} 10:00:00"},
            {"txn_id": f"own{step}", "txn_timestamp": "2026-03-21 10:00:00"},
        ).transform(handle_nulls)
        change = index.absorb(rows, f"r{step}")
        assert change.removed.count() == (1 if step else 0)
        index.commit(f"r{step}", change.added)
        index.compact(fan_in=3)
    assert [r[:3] for r in index.runs()] == ["t2-"]
    assert index.copies().count() == 10  # the superseded copies are gone
    assert {r.txn_id: str(r.txn_timestamp) for r in index.winners().collect()}["same"] == "2026-03-12 10:00:00"
    assert IdIndex(spark, str(tmp_path / "index"), buckets=99).buckets == 2


def test_equal_copies_and_ties(spark, typed_rows, tmp_path):
    index = IdIndex(spark, str(tmp_path / "index"), buckets=2)
    one = typed_rows({"txn_id": "a", "amount": 5.0}).transform(handle_nulls)
    index.commit("x", index.absorb(one.union(one), "x").added)
    assert index.absorb(one, "y").added.isEmpty()
    tied = index.absorb(typed_rows({"txn_id": "a", "amount": 4.0}).transform(handle_nulls), "y")
    assert [r.amount for r in tied.added.collect()] == [4.0] and tied.removed.count() == 1
    assert index.absorb(one.filter("false"), "z").added.isEmpty()
    assert [r.amount for r in index.absorb(one, "x").added.collect()] == [5.0]  # its own run is left out


def test_filters_lose_nothing():
    draw = np.random.default_rng(1)
    h1, h2 = draw.integers(-(2**63), 2**63, (2, 20_000), dtype=np.int64)
    made = bloom(h1[:10_000], h2[:10_000], 1e-3)
    found = holds(made, h1, h2, 1e-3)
    assert found[:10_000].all() and found[10_000:].mean() < 5e-3
    assert not holds(bloom(h1[:0], h2[:0], 1e-3), h1, h2, 1e-3).any()
