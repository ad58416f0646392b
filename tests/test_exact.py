"""Money does not depend on how rows are split, merged or stored."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paytide.functions.exact import mean, total
from paytide.operators import views
from paytide.operators.summaries import SUMMARIES, gold_tables, txn_rollup

AMOUNTS = [round(random.Random(1).uniform(0.01, 999_999.99), 2) for _ in range(3000)]


@pytest.fixture(scope="module")
def rows(silver_rows):
    return silver_rows(
        *[
            {"txn_id": f"t{i}", "amount": a, "txn_hour": i % 5, "is_anomaly": i % 7 == 0, "txn_type": "P2M"}
            for i, a in enumerate(AMOUNTS)
        ]
    )


def tables(rows, partitions, through_rollup):
    dealt = rows.repartition(partitions, F.xxhash64("txn_id", F.lit(partitions)))
    if through_rollup:
        return gold_tables(txn_rollup(dealt), with_processed_at=False)
    return {name: summary.of_rows(dealt, with_processed_at=False) for name, summary in SUMMARIES.items()}


@pytest.mark.parametrize("through_rollup", [False, True])
def test_equal_digits_under_any_split(rows, through_rollup):
    first = None
    for partitions in (1, 7, 200):
        gold = tables(rows, partitions, through_rollup)
        got = {name: df.collect() for name, df in gold.items()}
        got["kpis"] = views.kpis(gold["hourly_txn_summary"], gold["anomaly_summary"]).collect()
        first = first or got
        assert got == first
    volume = sum(Decimal(str(a)) for a in AMOUNTS)
    assert first["bank_failure_analysis"][0].total_amount == float(volume)


def test_sums_that_doubles_get_wrong(spark):
    df = spark.createDataFrame([(x,) for x in [1e16, 0.1, 0.2, -1e16, 1.0, None]], "x double").coalesce(1)
    got = df.agg(total(F.col("x")).alias("t"), mean(F.col("x")).alias("m")).first()
    assert (got.t, got.m) == (1.3, 1.3 / 5)


def test_values_without_a_fixed_form_show(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert df.agg(total(F.col("x")).alias("t")).first().t != df.agg(total(F.col("x")).alias("t")).first().t
    df = spark.createDataFrame([(1.0,), (1e300,)], "x double")
    assert df.agg(total(F.col("x")).alias("t")).first().t == 1e300
    empty = df.filter("false").agg(total(F.col("x")).alias("t"), mean(F.col("x")).alias("m")).first()
    assert (empty.t, empty.m) == (None, None)
