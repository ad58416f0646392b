import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paytide.operators import detection
from paytide.operators.summaries import bank_failure_analysis

START = dt.datetime(2026, 3, 21)
QUICK = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


# --- fixed rules ----------------------------------------------------------------------


@pytest.mark.parametrize(
    "change, fired",
    [
        ({"amount": 149_999.99}, set()),
        ({"amount": 150_000.0}, {"is_spike"}),
        ({"amount": 100_000.0}, {"is_round_amount"}),
        ({"amount": 250_000.0}, {"is_spike", "is_round_amount"}),
        ({"txn_hour": 1}, set()),
        ({"txn_hour": 2}, {"is_night"}),
        ({"txn_hour": 4}, {"is_night"}),
        ({"txn_hour": 5}, set()),
        ({"txn_hour": None, "amount": None}, set()),
    ],
)
def test_rules(typed_rows, change, fired):
    row = detection.rule_flags(typed_rows(change)).first()
    flags = {n for n in ("is_spike", "is_night", "is_round_amount") if row[n]}
    assert flags == fired
    assert row.is_suspect is bool(fired)


# --- velocity -------------------------------------------------------------------------


def events(spark, rows):
    """Rows of (sender, seconds after the start)."""
    data = [
        (f"t{i}", who, None if at is None else START + dt.timedelta(seconds=at))
        for i, (who, at) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data, "txn_id string, sender_vpa string, txn_timestamp timestamp"
    )


def expected_windows(rows, window):
    return {
        f"t{i}": sum(w == who and at - window <= t <= at for w, t in rows)
        for i, (who, at) in enumerate(rows)
    }


def test_velocity_window_is_inclusive(spark):
    df = events(spark, [("a", 0), ("a", 1800), ("a", 3600), ("b", 10)])
    flagged = detection.velocity_flags(df).collect()
    assert {r.txn_id: r.window_txns for r in flagged} == {
        "t0": None,
        "t1": None,
        "t2": 3,
        "t3": None,
    }
    assert [r.txn_id for r in flagged if r.is_velocity] == ["t2"]
    late = detection.velocity_flags(events(spark, [("a", 0), ("a", 1800), ("a", 3601)]))
    assert late.filter("is_velocity").isEmpty()


def test_velocity_same_second_and_null_keys(spark):
    df = events(spark, [("a", 5), ("a", 5), ("a", 5), (None, 7), (None, 8), (None, 9), ("a", None)])
    by_id = {r.txn_id: r for r in detection.velocity_flags(df).collect()}
    assert len(by_id) == 7
    assert [by_id[f"t{i}"].is_velocity for i in range(3)] == [True] * 3
    assert by_id["t5"].window_txns == 3 and not by_id["t4"].is_velocity
    assert by_id["t6"].is_velocity is False


@QUICK
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(-200, 400)),
        min_size=1,
        max_size=60,
    ),
    st.integers(1, 150),
)
def test_velocity_matches_brute_force(spark, rows, window):
    df = events(spark, rows)
    got = detection.velocity_flags(df, window_seconds=window, min_txns=2)
    expected = expected_windows(rows, window)
    assert {r.txn_id: r.window_txns for r in got.collect()} == {
        i: n if n >= 2 else None for i, n in expected.items()
    }


def test_velocity_with_a_flooding_sender(spark):
    """A third of all rows come from one sender, many of them in the same second."""
    rng = random.Random(3)
    rows = [("hot", rng.randrange(0, 600)) for _ in range(400)]
    rows += [(f"u{rng.randrange(200)}", rng.randrange(0, 600)) for _ in range(800)]
    df = events(spark, rows)
    got = detection.velocity_flags(df, window_seconds=60)
    expected = expected_windows(rows, 60)
    assert {r.txn_id: r.window_txns for r in got.collect()} == {
        i: n if n >= 3 else None for i, n in expected.items()
    }


def test_velocity_tasks_hold_seconds_not_rows(spark):
    df = events(spark, [("hot", i % 10) for i in range(1000)])
    counts = detection.velocity_counts(df)
    assert counts.count() == 10
    assert counts.agg(F.sum("n")).first()[0] == 1000


# --- z-score --------------------------------------------------------------------------


def amounts(spark, groups):
    data = [
        (f"{bank}{i}", bank, value)
        for bank, values in groups.items()
        for i, value in enumerate(values)
    ]
    return spark.createDataFrame(data, "txn_id string, sender_bank string, amount double")


def test_zscore_against_numpy(spark):
    rng = np.random.default_rng(1)
    groups = {
        "SBI": [*map(float, rng.normal(100, 5, 200)), 500.0],
        "HDFC": [*map(float, rng.normal(10, 1, 150)), -40.0],
    }
    rows = detection.zscore_flags(amounts(spark, groups)).collect()
    assert rows[0].asDict().keys() == {
        "txn_id", "sender_bank", "amount", "z_score", "is_zscore_outlier",
    }
    for row in rows:
        values = np.array(groups[row.sender_bank])
        z = (row.amount - values.mean()) / values.std(ddof=1)
        assert row.z_score == pytest.approx(z, rel=1e-9, abs=1e-12)
        assert row.is_zscore_outlier == (abs(z) > 3)
    assert sum(r.is_zscore_outlier for r in rows) == 2


def test_zscore_without_spread_or_bank(spark):
    df = amounts(spark, {"one": [5.0], "flat": [2.0, 2.0], None: [1.0, 2.0, 3.0]})
    rows = {r.txn_id: r for r in detection.zscore_flags(df).collect()}
    assert len(rows) == 6
    assert rows["one0"].z_score is None and rows["flat0"].z_score is None
    assert not rows["one0"].is_zscore_outlier
    assert rows["None0"].z_score == -1.0


def test_zscore_against_a_stored_profile(spark):
    history = detection.group_profile(amounts(spark, {"SBI": [1.0, 2.0, 3.0]}))
    row = detection.zscore_flags(amounts(spark, {"SBI": [10.0]}), history).first()
    assert row.z_score == 8.0 and row.is_zscore_outlier


# --- quartiles ------------------------------------------------------------------------


@QUICK
@given(
    st.dictionaries(
        st.sampled_from(["SBI", "HDFC", "Axis"]),
        st.lists(st.integers(-500, 3000).map(lambda v: v / 4), min_size=1, max_size=40),
        min_size=1,
    ),
    st.sampled_from([1.0, 100.0, 10_000.0]),
)
def test_percentiles_match_numpy(spark, groups, width):
    wanted = {"low": 0.0, "q1": 0.25, "mid": 0.5, "p90": 0.9, "top": 1.0}
    got = detection.group_percentiles(amounts(spark, groups), wanted, bucket_width=width)
    rows = {r.sender_bank: r for r in got.collect()}
    assert rows.keys() == groups.keys()
    for bank, values in groups.items():
        assert rows[bank].n == len(values)
        for name, p in wanted.items():
            assert rows[bank][name] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_percentiles_match_the_builtin(spark):
    rng = np.random.default_rng(5)
    groups = {"SBI": [float(v) for v in rng.integers(1, 100_000, 800)], "B": [7.0] * 50}
    df = amounts(spark, groups)
    ours = detection.group_percentiles(df, {"q1": 0.25, "q3": 0.75}).drop("n")
    builtin = df.groupBy("sender_bank").agg(
        F.percentile("amount", 0.25).alias("q1"), F.percentile("amount", 0.75).alias("q3")
    )
    assert ours.exceptAll(builtin).isEmpty() and builtin.exceptAll(ours).isEmpty()


def test_iqr_flags(spark):
    df = amounts(spark, {"SBI": [10.0, 11.0, 12.0, 13.0, 100.0], "B": [1.0, 2.0, -50.0, 3.0, 2.0]})
    flagged = detection.iqr_flags(df)
    assert flagged.columns == [*df.columns, "is_iqr_outlier"]
    assert sorted(r.txn_id for r in flagged.filter("is_iqr_outlier").collect()) == ["B2", "SBI4"]


def test_iqr_missing_amount_is_no_outlier(spark):
    df = amounts(spark, {"SBI": [1.0, 2.0, None], "void": [None]})
    rows = detection.iqr_flags(df).collect()
    assert len(rows) == 4 and not any(r.is_iqr_outlier for r in rows)


def test_percentile_plan_reuses_the_counted_values(spark, tmp_path):
    path = str(tmp_path / "a")
    amounts(spark, {"SBI": [1.0, 2.0], "B": [3.0]}).write.parquet(path)
    df = detection.iqr_fences(spark.read.parquet(path))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


# --- scoring --------------------------------------------------------------------------


def test_scores(spark):
    data = [(True, True)] * 3 + [(True, False)] + [(False, True)] * 2 + [(False, False)] * 4
    data += [(None, True), (True, None)]
    df = spark.createDataFrame(data, "is_anomaly boolean, guess boolean").withColumn(
        "never", F.lit(False)
    )
    rows = {r.detector: r for r in detection.detector_score(df, ["guess", "never"]).collect()}
    guess = rows["guess"]
    assert (guess.tp, guess.fp, guess.fn, guess.tn) == (3, 3, 2, 4)
    assert (guess.precision, guess.recall) == (0.5, 0.6)
    assert rows["never"].precision is None and rows["never"].recall == 0.0
    pairs = {(r.label, r.predicted): r.txns for r in detection.confusion(df, "guess").collect()}
    assert pairs == {(True, True): 3, (True, False): 2, (False, True): 3, (False, False): 4}


def test_alert_threshold_is_exclusive(silver_rows):
    records = []
    for bank, failed in {"A": 1, "B": 2, "C": 0}.items():
        for i in range(10):
            status = "FAILED" if i < failed else "SUCCESS"
            records.append({"txn_id": f"{bank}{i}", "sender_bank": bank, "status": status})
    banks = bank_failure_analysis(silver_rows(*records))
    alerts = detection.failure_alert(banks)
    assert [(r.sender_bank, r.failure_rate_pct) for r in alerts.collect()] == [("B", 20.0)]
    both = detection.failure_alert(banks, threshold_pct=5.0)
    assert [r.sender_bank for r in both.collect()] == ["B", "A"]


def test_empty_input(silver_rows):
    empty = silver_rows()
    assert detection.rule_flags(empty).count() == 0
    assert detection.velocity_flags(empty).count() == 0
    assert detection.zscore_flags(empty).count() == 0
    assert detection.iqr_flags(empty).count() == 0
    assert detection.confusion(empty, F.col("is_anomaly")).count() == 0
    assert Counter(r.tp for r in detection.detector_score(empty, ["is_anomaly"]).collect()) == {0: 1}


def test_iqr_flags_keep_the_callers_columns(spark):
    rows = [(f"t{i}", "SBI", float(i % 7), i, "own") for i in range(40)] + [("t99", "SBI", 900.0, 5, "own")]
    df = spark.createDataFrame(rows, "txn_id string, sender_bank string, amount double, n int, q1 string")
    out = detection.iqr_flags(df)
    assert out.columns == [*df.columns, "is_iqr_outlier"]
    assert {(r.txn_id, r.n, r.q1) for r in out.filter("is_iqr_outlier").collect()} == {("t99", 5, "own")}


def test_velocity_groups_are_bounded_whatever_the_window(spark):
    """A window of 30 days over a busy key: no group holds more than a slice's changes."""
    import numpy as np

    draw = np.random.default_rng(3)
    seconds = np.unique(draw.integers(0, 40 * 86_400, 6000))
    rows = [("hot", int(s)) for s in seconds for _ in range(1 + s % 3)] + [(None, 5), ("cold", 10**9)]
    df = spark.createDataFrame(rows, "k string, s long").withColumn("t", F.timestamp_seconds("s"))
    window = 30 * 86_400
    found = detection.velocity_counts(df, key="k", event_time="t", window_seconds=window)
    got = {(r.k, r.second): (r.n, r.n_window) for r in found.collect()}
    counts = np.array([1 + s % 3 for s in seconds])
    upto = np.concatenate([[0], np.cumsum(counts)])
    for i, s in enumerate(seconds):
        first = np.searchsorted(seconds, s - window)
        assert got["hot", int(s)] == (counts[i], upto[i + 1] - upto[first])
    assert got[None, 5] == (1, 1) and got["cold", 10**9] == (1, 1) and len(got) == len(seconds) + 2
    changes = [*seconds, *(seconds + window + 1)]
    largest = max(np.unique(np.array(changes) // detection.SLICE_SECONDS, return_counts=True)[1])
    assert largest <= 2 * detection.SLICE_SECONDS and largest < len(seconds) / 10


@pytest.mark.parametrize("low, high", [(0.0, 1.0), (0.0, 1e12), (-1e-9, 1e-9)])
def test_percentiles_of_any_range(spark, low, high):
    """Buckets follow the values, so the work is even and the result exact."""
    import numpy as np

    draw = np.random.default_rng(4)
    data = {"a": draw.uniform(low, high, 4000), "b": np.exp(draw.uniform(-20, 20, 3000)) * high}
    df = spark.createDataFrame([(k, float(v)) for k, x in data.items() for v in x], "sender_bank string, amount double")
    wanted = {"q1": 0.25, "q2": 0.5, "q9": 0.999}
    got = {r.sender_bank: r for r in detection.group_percentiles(df, wanted).collect()}
    for k, x in data.items():
        for name, p in wanted.items():
            assert got[k][name] == pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-24)
        edges = np.array(
            df.filter(f"sender_bank = '{k}'")
            .agg(F.percentile_approx("amount", F.array(*[F.lit(i / detection.BUCKETS) for i in range(1, detection.BUCKETS)]), detection.SKETCH_ACCURACY))
            .first()[0]
        )
        held = np.bincount(np.searchsorted(edges, x, side="right"))
        assert held.max() <= 2 * len(x) / detection.BUCKETS


def test_trailing_profile_merges_days(spark):
    import random as r

    draw = r.Random(5)
    rows = [("a" if draw.random() < 0.7 else "b", f"2026-03-{draw.randint(1, 12):02d}", round(draw.uniform(1, 9e5), 2)) for _ in range(600)]
    rows += [("a", "2026-03-09", None), (None, "2026-03-09", 5.0), ("a", None, 7.0)]
    df = spark.createDataFrame(rows, "sender_bank string, d string, amount double").selectExpr(
        "sender_bank", "cast(d as date) as txn_date", "amount", "uuid() as txn_id"
    )
    daily = detection.daily_profile(df)
    merged = {r.sender_bank: r for r in detection.merged_profile(daily.repartition(7)).collect()}
    again = {r.sender_bank: r for r in detection.merged_profile(daily.coalesce(1)).collect()}
    assert merged == again  # the same digits for any order
    direct = {r.sender_bank: r for r in detection.group_profile(df.filter("amount IS NOT NULL")).collect()}
    for k in ("a", "b"):
        assert merged[k].profile_rows == direct[k].profile_rows
        assert merged[k].profile_mean == pytest.approx(direct[k].profile_mean, rel=1e-13)
        assert merged[k].profile_stddev == pytest.approx(direct[k].profile_stddev, rel=1e-12)
    scored = detection.zscore_trailing(df, 3).filter("sender_bank = 'a' AND txn_date = '2026-03-09'").collect()
    before = [v for k, d, v in rows if k == "a" and d and "2026-03-06" <= d <= "2026-03-08"]
    import statistics

    mean, sd = statistics.fmean(before), statistics.stdev(before)
    for row in scored:
        if row.amount is None:
            assert row.z_score is None and not row.is_zscore_outlier
        else:
            assert row.z_score == pytest.approx((row.amount - mean) / sd, rel=1e-9)
    first = detection.zscore_trailing(df, 3).filter("txn_date = '2026-03-01' OR txn_date IS NULL").collect()
    assert {row.z_score for row in first} == {None}
