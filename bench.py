"""Times the headline jobs and prints one JSON line.

Set-up (not timed) stores the raw transactions as a Bronze table and runs the pipeline
once, so that every timed job starts from Parquet as it does in production.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all),
BENCH_RUNS (default 3; the best run counts).
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.binding import bronze
from checks.queries import QUERIES
from paytide.operators import audit, detection, summaries, views
from paytide.plans.export import run_export
from paytide.plans.gold import run_gold
from paytide.plans.pipeline import Paths
from paytide.plans.silver import cleaned, run_silver, silver
from paytide.sources import lake
from paytide.sources.staging import scratch_path
from paytide.streaming.hourly import start_hourly
from paytide.streaming.ingest import settle, start_ingest


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("paytide-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def jobs(spark: SparkSession, sf_dir: str, at: Paths) -> dict[str, Callable[[], DataFrame | None]]:
    def raw() -> DataFrame:
        return lake.read_bronze(spark, at.bronze)

    def clean() -> DataFrame:
        return lake.read_silver(spark, at.silver)

    def gold(name: str) -> DataFrame:
        return lake.read_gold_table(spark, at.gold, name)

    def fresh(label: str) -> str:
        return scratch_path(spark, label)

    def ingest_and_settle(log: str) -> None:
        start_ingest(spark, at.bronze, log, fresh("ingest")).awaitTermination()
        settle(spark, log, fresh("settled"))

    # Jobs that end in their own sink return nothing.
    ending: dict[str, Callable] = {
        "silver_job": lambda: run_silver(spark, at.bronze, fresh("silver")),
        "gold_job": lambda: run_gold(spark, at.silver, fresh("gold")),
        "export_job": lambda: run_export(spark, at.gold, root=fresh("warehouse")),
        "stream_ingest": lambda: ingest_and_settle(fresh("live")),
        "stream_hourly": lambda: start_hourly(
            spark, at.bronze, fresh("hours"), fresh("hourly")
        ).awaitTermination(),
    }

    def to_sink(job: Callable) -> Callable[[], None]:
        def run() -> None:
            job()

        return run

    frames: dict[str, Callable[[], DataFrame]] = {
        "silver": lambda: silver(raw()),
        "validation_audit": lambda: audit.validation_audit(cleaned(raw())),
        "bronze_profile": lambda: audit.bronze_profile(raw()),
        "hourly_txn_summary": lambda: summaries.hourly_txn_summary(clean()),
        "bank_failure_analysis": lambda: summaries.bank_failure_analysis(clean()),
        "merchant_spend_analysis": lambda: summaries.merchant_spend_analysis(clean()),
        "anomaly_summary": lambda: summaries.anomaly_summary(clean()),
        "kpis": lambda: views.kpis(gold("hourly_txn_summary"), gold("anomaly_summary")),
        "rule_flags": lambda: detection.rule_flags(clean()),
        "velocity": lambda: detection.velocity_flags(clean()),
        "zscore": lambda: detection.zscore_flags(clean()),
        "iqr": lambda: detection.iqr_flags(clean()),
        "detector_score": lambda: detection.detector_score(
            detection.rule_flags(clean()), ["is_spike", "is_night", "is_round_amount"]
        ),
        **{
            name: (lambda q=QUERIES[name]: q(spark, sf_dir))
            for name in (
                "lineitem_dedup",
                "lineitem_price_quartiles",
                "orders_rate_summary",
                "orders_velocity",
            )
        },
    }
    return {**frames, **{name: to_sink(job) for name, job in ending.items()}}


def timed(job: Callable[[], DataFrame | None]) -> float:
    started = time.perf_counter()
    df = job()
    if df is not None:
        # The noop sink computes every row and column without collecting any.
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)

    at = Paths(*[scratch_path(spark, layer) for layer in ("bronze", "silver", "gold")])
    lake.append_bronze(bronze(spark, sf_dir), at.bronze)
    run_silver(spark, at.bronze, at.silver)
    run_gold(spark, at.silver, at.gold)

    seconds = {
        name: round(min(timed(job) for _ in range(runs)), 3)
        for name, job in jobs(spark, sf_dir, at).items()
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_jobs_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    sys.exit(main())
