"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.binding import bronze, bronze_text
from paytide.functions.scalars import money
from paytide.operators import audit, cleansing, detection, summaries, views
from paytide.operators.enrichment import enrich as add_derived
from paytide.operators.summaries import SUMMARIES, Summary
from paytide.plans.export import run_export
from paytide.plans.gold import run_gold
from paytide.plans.incremental import run_incremental
from paytide.plans.pipeline import Paths, run_pipeline
from paytide.plans.silver import cleaned, run_silver, silver
from paytide.sources import lake, warehouse
from paytide.sources.staging import scratch_path, staged
from paytide.streaming.hourly import present_hours, read_hours, start_hourly, start_live_hours
from paytide.streaming.ingest import read_live, settle, start_ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def once(build: Callable[[SparkSession, str], str]) -> Callable[[SparkSession, str], str]:
    """The folder `build` makes, made once per session and tables: several queries read it."""
    made: dict[tuple[str, str], str] = {}

    def folder(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in made:
            made[key] = build(spark, sf_dir)
        return made[key]

    return folder


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(bronze(spark, sf_dir), with_processed_at=False)


def _gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return SUMMARIES[name].of_rows(_silver(spark, sf_dir), with_processed_at=False)


def _without_stamp(df: DataFrame) -> DataFrame:
    return df.drop("processed_at", "PROCESSED_AT")


# --- Silver, step by step -------------------------------------------------------------


def _bronze_folder(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "bronze")
    lake.append_bronze(bronze(spark, sf_dir), path)
    return path


@query
def bronze_scan(spark, sf_dir):
    return lake.read_bronze(spark, _bronze_folder(spark, sf_dir))


@query
def bronze_append(spark, sf_dir):
    """Two batches, the second appended to the first."""
    path = scratch_path(spark, "bronze")
    raw = bronze(spark, sf_dir)
    lake.append_bronze(raw.filter("txn_date < '2024-01-16'"), path)
    lake.append_bronze(raw.filter("txn_date >= '2024-01-16'"), path)
    return lake.read_bronze(spark, path)


@query
def bronze_append_extras(spark, sf_dir):
    """Two batches, the second with columns the table does not declare."""
    path = scratch_path(spark, "bronze")
    raw = bronze(spark, sf_dir)
    later = raw.filter("txn_date >= '2024-01-16'").withColumns(
        {"channel": F.concat(F.lit("app-"), "device_type"), "fee": F.col("amount") * 2}
    )
    lake.append_bronze(raw.filter("txn_date < '2024-01-16'"), path)
    lake.append_bronze(later, path)
    return lake.read_bronze(spark, path, extras=True)


@query
def bronze_mixed_files(spark, sf_dir):
    """Files of a foreign writer: in some a text column without any value is a number, and
    hours are text; taken over into a table of one schema."""
    landing, path = (scratch_path(spark, x) for x in ("landing", "bronze"))
    raw = bronze(spark, sf_dir)
    plain = F.col("failure_reason").isNull()
    empty = {"failure_reason": F.lit(None).cast("int"), "txn_hour": F.col("txn_hour").cast("string")}
    for rows in (raw.filter(plain).withColumns(empty), raw.filter(~plain)):
        rows.write.mode("append").partitionBy("txn_date").parquet(landing)
    lake.append_bronze(lake.read_mixed(spark, landing), path)
    return lake.read_bronze(spark, path)


@query
def enforce_schema_text(spark, sf_dir):
    """Every column arrives as text; what does not convert is kept beside the row."""
    typed = cleansing.enforce_schema(bronze_text(spark, sf_dir), keep_raw="raw_values")
    return typed.withColumn("raw_values", F.to_json("raw_values"))


@query
def conversion_audit(spark, sf_dir):
    """Values of each column, and those lost in conversion."""
    return bronze_text(spark, sf_dir).transform(audit.conversion_audit)


@query
def silver_text(spark, sf_dir):
    return silver(bronze_text(spark, sf_dir), with_processed_at=False)


@query
def enforce_schema(spark, sf_dir):
    return cleansing.enforce_schema(bronze(spark, sf_dir))


@query
def handle_nulls(spark, sf_dir):
    return enforce_schema(spark, sf_dir).transform(cleansing.handle_nulls)


@query
def deduplicate(spark, sf_dir):
    return handle_nulls(spark, sf_dir).transform(cleansing.deduplicate)


@query
def validate(spark, sf_dir):
    return deduplicate(spark, sf_dir).transform(cleansing.validate)


@query
def enrich(spark, sf_dir):
    return validate(spark, sf_dir).transform(add_derived, with_processed_at=False)


QUERIES["silver"] = _silver


@query
def validation_audit(spark, sf_dir):
    return cleaned(bronze(spark, sf_dir)).transform(audit.validation_audit)


# --- Gold -----------------------------------------------------------------------------


@query
def hourly_txn_summary(spark, sf_dir):
    return _gold(spark, sf_dir, "hourly_txn_summary")


@query
def bank_failure_analysis(spark, sf_dir):
    return _gold(spark, sf_dir, "bank_failure_analysis")


@query
def merchant_spend_analysis(spark, sf_dir):
    return _gold(spark, sf_dir, "merchant_spend_analysis")


@query
def anomaly_summary(spark, sf_dir):
    return _gold(spark, sf_dir, "anomaly_summary")


def _from_rollup(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rollup = summaries.txn_rollup(_silver(spark, sf_dir))
    return summaries.gold_tables(rollup, with_processed_at=False)[name]


@query
def rollup_hourly(spark, sf_dir):
    return _from_rollup(spark, sf_dir, "hourly_txn_summary")


@query
def rollup_banks(spark, sf_dir):
    return _from_rollup(spark, sf_dir, "bank_failure_analysis")


@query
def rollup_merchants(spark, sf_dir):
    return _from_rollup(spark, sf_dir, "merchant_spend_analysis")


@query
def rollup_anomalies(spark, sf_dir):
    return _from_rollup(spark, sf_dir, "anomaly_summary")


# --- Serving views --------------------------------------------------------------------


@query
def hourly_volume(spark, sf_dir):
    return hourly_txn_summary(spark, sf_dir).transform(views.hourly_volume)


@query
def bank_ranking(spark, sf_dir):
    return bank_failure_analysis(spark, sf_dir).transform(views.bank_ranking)


@query
def merchant_ranking(spark, sf_dir):
    return merchant_spend_analysis(spark, sf_dir).transform(views.merchant_ranking)


@query
def anomaly_table(spark, sf_dir):
    return anomaly_summary(spark, sf_dir).transform(views.anomaly_table)


def _kpi_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = staged(summaries.txn_rollup(_silver(spark, sf_dir)))
    gold = summaries.gold_tables(rollup)
    return views.kpis(gold["hourly_txn_summary"], gold["anomaly_summary"])


@query
def kpis(spark, sf_dir):
    return _kpi_row(spark, sf_dir).withColumns(
        {c: money(F.col(c)) for c in ("avg_transaction", "weighted_avg_amount")}
    )


@query
def kpi_cards(spark, sf_dir):
    return _kpi_row(spark, sf_dir).transform(views.kpi_cards)


# --- Profile of the raw table ---------------------------------------------------------


@query
def bronze_profile(spark, sf_dir):
    return bronze(spark, sf_dir).transform(audit.bronze_profile)


@query
def status_counts(spark, sf_dir):
    return bronze(spark, sf_dir).transform(audit.status_counts)


@query
def anomaly_total(spark, sf_dir):
    return bronze(spark, sf_dir).transform(audit.anomaly_total)


@query
def table_shape(spark, sf_dir):
    return bronze(spark, sf_dir).transform(audit.table_shape)


@query
def first_rows(spark, sf_dir):
    return audit.first_rows(
        bronze(spark, sf_dir), 3, order_by=("txn_id", "utr_number", "txn_timestamp")
    )


# --- Storage round trips --------------------------------------------------------------


def _silver_folder(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "silver")
    run_silver(spark, _bronze_folder(spark, sf_dir), path)
    return path


def _gold_folder(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "gold")
    run_gold(spark, _silver_folder(spark, sf_dir), root)
    return root


@query
def silver_roundtrip(spark, sf_dir):
    return _without_stamp(lake.read_silver(spark, _silver_folder(spark, sf_dir)))


@query
def silver_date_range(spark, sf_dir):
    """The whole table, read back as three adjoining ranges of days."""
    path = _silver_folder(spark, sf_dir)
    early = lake.read_silver(spark, path, until="2024-01-07")
    middle = lake.read_silver(spark, path, since="2024-01-08", until="2024-01-14")
    late = lake.read_silver(spark, path, since="2024-01-15")
    return _without_stamp(early.unionByName(middle).unionByName(late))


def _stored_gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _without_stamp(lake.read_gold_table(spark, _gold_folder(spark, sf_dir), name))


@query
def gold_roundtrip(spark, sf_dir):
    return _stored_gold(spark, sf_dir, "hourly_txn_summary")


@query
def gold_roundtrip_banks(spark, sf_dir):
    return _stored_gold(spark, sf_dir, "bank_failure_analysis")


@query
def gold_roundtrip_merchants(spark, sf_dir):
    return _stored_gold(spark, sf_dir, "merchant_spend_analysis")


@query
def gold_roundtrip_anomalies(spark, sf_dir):
    return _stored_gold(spark, sf_dir, "anomaly_summary")


@once
def _gold_in_ranges(spark: SparkSession, sf_dir: str) -> str:
    """Gold of all days, first from a Silver that lacks some; then three ranges are rerun."""
    bronze_path, silver_path, root = (scratch_path(spark, x) for x in ("bronze", "silver", "gold"))
    raw = bronze(spark, sf_dir)
    lake.append_bronze(raw.filter("amount > 5000 OR txn_date > '2024-01-20'"), bronze_path)
    run_silver(spark, bronze_path, silver_path)
    run_gold(spark, silver_path, root)
    run_silver(spark, _bronze_folder(spark, sf_dir), silver_path)
    run_gold(spark, silver_path, root, until="2024-01-09")
    run_gold(spark, silver_path, root, days=["2024-01-10", "2024-01-11"])
    run_gold(spark, silver_path, root, since="2024-01-12")
    return root


@query
def gold_range_rerun(spark, sf_dir):
    root = _gold_in_ranges(spark, sf_dir)
    return _without_stamp(lake.read_gold_table(spark, root, "hourly_txn_summary"))


@query
def gold_range_rerun_banks(spark, sf_dir):
    root = _gold_in_ranges(spark, sf_dir)
    return _without_stamp(lake.read_gold_table(spark, root, "bank_failure_analysis"))


@query
def gold_scan(spark, sf_dir):
    """Rows and transactions of each of the four tables read back by name."""
    tables = lake.read_gold_tables(spark, _gold_folder(spark, sf_dir))
    counted = [
        df.agg(
            F.sum("anomaly_count" if "anomaly_count" in df.columns else "total_txns").alias("txns"),
            F.count(F.lit(1)).alias("groups"),
        ).select(F.lit(name).alias("table_name"), "txns", "groups")
        for name, df in tables.items()
    ]
    first, *others = counted
    for other in others:
        first = first.unionByName(other)
    return first


@query
def incremental_overwrite(spark, sf_dir):
    """One day of Silver is corrected and rewritten; the other days stay."""
    path = _silver_folder(spark, sf_dir)
    day = lake.read_silver(spark, path, since="2024-01-10", until="2024-01-10")
    corrected = staged(day.withColumn("amount", F.col("amount") + 1))
    lake.write_silver(corrected, path, incremental=True)
    return _without_stamp(lake.read_silver(spark, path))


def _chain(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Gold table after Bronze append, Silver and Gold in one go."""
    paths = Paths(*[scratch_path(spark, layer) for layer in ("bronze", "silver", "gold")])
    run_pipeline(spark, paths, batch=bronze(spark, sf_dir))
    return _without_stamp(lake.read_gold_table(spark, paths.gold, name))


@query
def pipeline_chain(spark, sf_dir):
    return _chain(spark, sf_dir, "bank_failure_analysis")


@query
def pipeline_chain_hours(spark, sf_dir):
    return _chain(spark, sf_dir, "hourly_txn_summary")


@query
def pipeline_chain_merchants(spark, sf_dir):
    return _chain(spark, sf_dir, "merchant_spend_analysis")


@query
def pipeline_chain_anomalies(spark, sf_dir):
    return _chain(spark, sf_dir, "anomaly_summary")


@once
def _incremental_gold(spark: SparkSession, sf_dir: str) -> str:
    """Gold after three batches and three incremental runs; a fifth of a batch's rows, first
    and later copies alike, arrives with the next one."""
    layers = ("bronze", "silver", "gold", "index")
    paths = Paths(*[scratch_path(spark, layer) for layer in layers])
    late = F.expr("pmod(xxhash64(txn_id, txn_timestamp), 5) = 0 AND txn_date < '2024-01-21'")
    due = F.expr("CASE WHEN txn_date < '2024-01-11' THEN 0 WHEN txn_date < '2024-01-21' THEN 1 ELSE 2 END")
    rows = bronze(spark, sf_dir).withColumn("due", due + late.cast("int"))
    for batch in range(3):
        run_incremental(spark, paths, rows.filter(F.col("due") == batch).drop("due"))
    return paths.gold


def _incremental(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _without_stamp(lake.read_gold_table(spark, _incremental_gold(spark, sf_dir), name))


@query
def pipeline_incremental(spark, sf_dir):
    return _incremental(spark, sf_dir, "hourly_txn_summary")


@query
def pipeline_incremental_banks(spark, sf_dir):
    return _incremental(spark, sf_dir, "bank_failure_analysis")


@query
def pipeline_incremental_merchants(spark, sf_dir):
    return _incremental(spark, sf_dir, "merchant_spend_analysis")


@query
def pipeline_incremental_anomalies(spark, sf_dir):
    return _incremental(spark, sf_dir, "anomaly_summary")


# --- Export ---------------------------------------------------------------------------


@query
def export_hourly(spark, sf_dir):
    return hourly_txn_summary(spark, sf_dir).transform(warehouse.prepare_df)


@query
def export_banks(spark, sf_dir):
    return bank_failure_analysis(spark, sf_dir).transform(warehouse.prepare_df)


@query
def export_merchants(spark, sf_dir):
    return merchant_spend_analysis(spark, sf_dir).transform(warehouse.prepare_df)


@query
def export_anomalies(spark, sf_dir):
    return anomaly_summary(spark, sf_dir).transform(warehouse.prepare_df)


def _warehouse_folder(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "warehouse")
    run_export(spark, _gold_folder(spark, sf_dir), root=root)
    return root


def _exported(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _without_stamp(spark.read.parquet(f"{_warehouse_folder(spark, sf_dir)}/{name}"))


@query
def warehouse_export(spark, sf_dir):
    return _exported(spark, sf_dir, "ANOMALY_SUMMARY")


@query
def warehouse_export_hours(spark, sf_dir):
    return _exported(spark, sf_dir, "HOURLY_TXN_SUMMARY")


@query
def warehouse_export_banks(spark, sf_dir):
    return _exported(spark, sf_dir, "BANK_FAILURE_ANALYSIS")


@query
def warehouse_export_merchants(spark, sf_dir):
    return _exported(spark, sf_dir, "MERCHANT_SPEND_ANALYSIS")


def _loaded(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table through the session catalog, in presentation order."""
    tables = lake.read_gold_tables(spark, _gold_folder(spark, sf_dir))
    warehouse.export_to_catalog(tables, root=scratch_path(spark, "catalog"))
    return _without_stamp(warehouse.load_data(spark)[name])


@query
def warehouse_views(spark, sf_dir):
    return _loaded(spark, sf_dir, "MERCHANT_SPEND_ANALYSIS")


@query
def warehouse_tables(spark, sf_dir):
    return _loaded(spark, sf_dir, "BANK_FAILURE_ANALYSIS")


@query
def warehouse_hours(spark, sf_dir):
    return _loaded(spark, sf_dir, "HOURLY_TXN_SUMMARY")


@query
def warehouse_anomalies(spark, sf_dir):
    return _loaded(spark, sf_dir, "ANOMALY_SUMMARY")


# --- Detection ------------------------------------------------------------------------


@query
def rule_flags(spark, sf_dir):
    return (
        _silver(spark, sf_dir)
        .transform(detection.rule_flags)
        .select("txn_id", "is_spike", "is_night", "is_round_amount", "is_suspect")
    )


@query
def velocity_counts(spark, sf_dir):
    return _silver(spark, sf_dir).transform(detection.velocity_counts)


@query
def velocity(spark, sf_dir):
    return (
        _silver(spark, sf_dir)
        .transform(detection.velocity_flags)
        .select("txn_id", "sender_vpa", "txn_timestamp", "window_txns", "is_velocity")
    )


@query
def zscore(spark, sf_dir):
    return (
        _silver(spark, sf_dir)
        .transform(detection.zscore_flags)
        .select("txn_id", money(F.col("z_score")).alias("z_score"), "is_zscore_outlier")
    )


@query
def zscore_stored_profile(spark, sf_dir):
    """The profile is a stored table; all rows are scored against it."""
    rows = staged(_silver(spark, sf_dir))
    profile = staged(detection.group_profile(rows))
    flagged = detection.zscore_flags(rows, profile)
    return flagged.select("txn_id", money(F.col("z_score")).alias("z_score"), "is_zscore_outlier")


@query
def zscore_trailing(spark, sf_dir):
    """Against the seven days before, from a stored daily profile."""
    rows = staged(_silver(spark, sf_dir))
    daily = staged(detection.daily_profile(rows))
    flagged = detection.zscore_trailing(rows, 7, daily)
    return flagged.select("txn_id", money(F.col("z_score")).alias("z_score"), "is_zscore_outlier")


@query
def iqr_keeps_columns(spark, sf_dir):
    """The caller's own `n` and `q1` stay as they are."""
    rows = staged(_silver(spark, sf_dir).withColumns({"n": F.col("txn_hour"), "q1": F.col("amount")}))
    return detection.iqr_flags(rows).select("txn_id", "n", "q1", "is_iqr_outlier")


@query
def iqr_fences(spark, sf_dir):
    fences = _silver(spark, sf_dir).transform(detection.iqr_fences)
    return fences.withColumns(
        {c: money(F.col(c)) for c in ("q1", "q3", "lower_fence", "upper_fence")}
    )


@query
def iqr(spark, sf_dir):
    flagged = _silver(spark, sf_dir).transform(detection.iqr_flags)
    return flagged.select("txn_id", "is_iqr_outlier")


@query
def confusion(spark, sf_dir):
    suspects = _silver(spark, sf_dir).transform(detection.rule_flags)
    return suspects.transform(detection.confusion, "is_suspect")


@query
def detector_score(spark, sf_dir):
    suspects = _silver(spark, sf_dir).transform(detection.rule_flags)
    return detection.detector_score(
        suspects, ["is_spike", "is_night", "is_round_amount", "is_suspect"]
    )


@query
def failure_alert(spark, sf_dir):
    return bank_failure_analysis(spark, sf_dir).transform(detection.failure_alert)


# --- The same operators on other tables -----------------------------------------------


@query
def lineitem_dedup(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return cleansing.deduplicate(
        items, keys=("l_orderkey", "l_linenumber"), order_by=("l_shipdate",)
    )


@query
def lineitem_price_quartiles(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return detection.group_percentiles(
        items,
        {"q1": 0.25, "q2": 0.5, "q3": 0.75},
        key="l_returnflag",
        value="l_quantity",
        bucket_width=5.0,
    )


@query
def lineitem_discount_quartiles(spark, sf_dir):
    """Values between 0 and 1."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    found = detection.group_percentiles(
        items, {"q1": 0.25, "q2": 0.5, "q3": 0.75}, key="l_linestatus", value="l_discount"
    )
    return found.withColumns({c: F.round(c, 6) for c in ("q1", "q2", "q3")})


_ORDER_RATES = Summary(
    keys=("o_orderpriority",),
    columns={
        "total_orders": "n",
        "partial_orders": "n_pending",
        "total_amount": "amount_sum",
        "avg_amount": "amount_avg",
    },
    rates={"partial_rate_pct": ("n_pending", "n")},
)


@query
def orders_rate_summary(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return _ORDER_RATES.of_rows(
        orders,
        with_processed_at=False,
        id_col="o_orderkey",
        status_col="o_orderstatus",
        amount=F.col("o_totalprice").cast("decimal(18,2)"),
        success="F",
        failed="O",
        pending="P",
    )


@query
def orders_velocity(spark, sf_dir):
    """Orders per customer in the 30 days up to each order."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return detection.velocity_counts(
        orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp")),
        key="o_custkey",
        event_time="o_orderdate",
        window_seconds=30 * 24 * 3600,
    )


# --- Streaming ------------------------------------------------------------------------


@query
def stream_ingest(spark, sf_dir):
    """All of Bronze through the streaming Silver job."""
    log, checkpoint = (scratch_path(spark, label) for label in ("live", "ingest"))
    start_ingest(spark, _bronze_folder(spark, sf_dir), log, checkpoint).awaitTermination()
    return read_live(spark, log, with_processed_at=False)


@query
def stream_small_steps(spark, sf_dir):
    """All of Bronze in six files out of order, one per micro-batch; the last repeats every
    row a day later. Columns that follow from the batch's day are left out."""
    rows = bronze(spark, sf_dir)
    folder, log, checkpoint = (scratch_path(spark, label) for label in ("steps", "live", "ingest"))
    moment = F.try_to_timestamp("txn_timestamp")
    later = F.date_format(moment + F.expr("interval 1 day"), "yyyy-MM-dd HH:mm:ss")
    repeats = rows.withColumn("txn_timestamp", later).filter("txn_timestamp IS NOT NULL")
    part = F.pmod(F.xxhash64("txn_id", "txn_timestamp"), F.lit(5))
    for step in (3, 0, 4, 1, 2):
        lake.append_bronze(rows.filter(part == step), folder, "2026-03-21")
    lake.append_bronze(repeats, folder, "2026-03-22")
    start_ingest(spark, folder, log, checkpoint, max_files_per_trigger=1).awaitTermination()
    return read_live(spark, log, with_processed_at=False).drop(
        "txn_date", "day_of_week", "week_of_year"
    )


def _log_in_steps(spark: SparkSession, sf_dir: str, settle_after: tuple[int, ...]) -> tuple[str, str]:
    """Log and Silver after four batches through the ingest, settled after some of them."""
    labels = ("steps", "live", "ingest", "silver")
    folder, log, checkpoint, target = (scratch_path(spark, label) for label in labels)
    rows = bronze(spark, sf_dir)
    part = F.pmod(F.xxhash64("txn_id", "txn_timestamp"), F.lit(4))
    for step in range(4):
        lake.append_bronze(rows.filter(part == step), folder)
        start_ingest(spark, folder, log, checkpoint).awaitTermination()
        if step in settle_after:
            settle(spark, log, target)
    return log, target


@query
def stream_settle_twice(spark, sf_dir):
    """Silver settled twice from the log, with late copies before and after."""
    _, target = _log_in_steps(spark, sf_dir, settle_after=(1, 3))
    return _without_stamp(lake.read_silver(spark, target))


@query
def stream_settled_and_live(spark, sf_dir):
    """The settled part of a log and the batches that came after it."""
    log, _ = _log_in_steps(spark, sf_dir, settle_after=(0, 2))
    return read_live(spark, log, with_processed_at=False)


@query
def stream_hourly(spark, sf_dir):
    """All hours after all of Bronze went through the stream in three parts, out of order."""
    labels = ("steps", "hours", "index", "hourly")
    folder, hours, index, checkpoint = (scratch_path(spark, label) for label in labels)
    rows = bronze(spark, sf_dir)
    part = F.pmod(F.xxhash64("txn_id", "txn_timestamp"), F.lit(3))
    for step in (2, 0, 1):
        lake.append_bronze(rows.filter(part == step), folder)
        start_live_hours(spark, folder, hours, index, checkpoint).awaitTermination()
    return present_hours(read_hours(spark, hours), with_processed_at=False)


@query
def stream_hourly_closed(spark, sf_dir):
    """Hours closed by the watermark after all of Bronze went through the stream."""
    target, checkpoint = (scratch_path(spark, label) for label in ("hours", "hourly"))
    start_hourly(spark, _bronze_folder(spark, sf_dir), target, checkpoint).awaitTermination()
    return present_hours(spark.read.parquet(target), with_processed_at=False)
