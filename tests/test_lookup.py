import pytest
from pyspark.sql import functions as F

from paytide.operators.lookup import attach
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows share one key, another part has none."""
    return spark.range(3000).select(
        F.col("id").cast("string").alias("txn_id"),
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 400))
        .alias("key"),
    )


@pytest.fixture(scope="module")
def lookup(rows):
    counted = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter("key IS NULL OR key <> 'k7'").withColumn("label", F.upper("key"))


def expected(rows, lookup):
    payload = {r.key: (r.n, r.label) for r in lookup.collect()}
    return {r.txn_id: payload.get(r.key, (None, None)) for r in rows.collect()}


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"broadcast_bytes": 0},
        {"broadcast_bytes": 0, "max_hot_keys": 5},
        {"broadcast_bytes": 0, "max_hot_keys": 1},
        {"broadcast_bytes": 0, "max_hot_keys": 10_000},
    ],
)
def test_every_way_gives_the_same_rows(rows, lookup, options):
    joined = attach(rows, lookup, ["key"], weight="n", spread_by=["txn_id"], **options)
    assert joined.columns == ["txn_id", "key", "n", "label"]
    got = joined.collect()
    assert len(got) == 3000
    assert {r.txn_id: (r.n, r.label) for r in got} == expected(rows, lookup)


def test_small_lookup_leaves_the_rows_in_place(rows, lookup):
    plan = plan_of(attach(rows, lookup, ["key"], weight="n", spread_by=["txn_id"]))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_large_lookup_spreads_the_hot_key(spark, rows, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = attach(
            rows, lookup, ["key"], weight="n", spread_by=["txn_id"],
            broadcast_bytes=0, max_hot_keys=5,
        )
        plan = plan_of(joined)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "SortMergeJoin" in plan and "_salt" in plan and "BroadcastHashJoin" in plan
    held = [r["count"] for r in sizes]
    assert sum(held) == 3000 and len(held) == 4 and max(held) < 1000


def test_empty_lookup(rows, lookup):
    joined = attach(rows, lookup.limit(0), ["key"], weight="n", spread_by=["txn_id"])
    assert joined.filter("n IS NOT NULL").isEmpty() and joined.count() == 3000


def test_heat_comes_from_the_rows_when_the_lookup_is_older(spark):
    """A key that history lacks and one that was rare there hold a third of the rows each."""
    rows = spark.range(6000).select(
        F.col("id").cast("string").alias("txn_id"),
        F.when(F.col("id") % 3 == 0, "absent")
        .when(F.col("id") % 3 == 1, "newly busy")
        .otherwise(F.concat(F.lit("k"), F.col("id") % 400))
        .alias("key"),
    )
    others = spark.range(400).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(9).alias("n"))
    lookup = others.union(spark.createDataFrame([("newly busy", 1)], "key string, n int"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = attach(
            rows, lookup, ["key"], weight=None, spread_by=["txn_id"],
            broadcast_bytes=0, max_hot_keys=20,
        )
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        got = {(r.key, r.n) for r in joined.select("key", "n").distinct().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held = [r["count"] for r in sizes]
    assert sum(held) == 6000 and max(held) < 2 * 6000 / len(held) and len(held) == 4
    assert {("absent", None), ("newly busy", 1), ("k2", 9)} <= got and len(got) == 402
