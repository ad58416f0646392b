"""Continuous hourly summary over event time, in two forms.

`start_hourly` writes an hour once, when the watermark has passed it, and leaves out what
comes later. `start_live_hours` keeps a small table of all hours that corrects itself: a late
row enters its hour whenever it comes, and when an earlier copy of an id arrives, the copy
counted so far is taken out of its own hour. Its hours are those of the batch Silver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paytide import schema as s
from paytide.operators.cleansing import enforce_schema, handle_nulls, validate
from paytide.operators.summaries import SUMMARIES, measures, merged_measures
from paytide.sources.files import exists, remove, subfolders
from paytide.sources.id_index import BUCKETS, ID, TIME, Change, IdIndex
from paytide.sources.staging import staged
from paytide.streaming.ingest import LATENESS, SPREAD, bronze_stream, silver_stream


def hourly_windows(rows: DataFrame, window_offset: str = "0 minutes") -> DataFrame:
    """Measures per event-time hour; the hour's start stands for date and hour.

    Windows are cut at full hours UTC. In a session time zone that is off by part of an
    hour, `window_offset` moves the cut to its own full hours, e.g. "30 minutes".
    """
    hour = F.window("txn_timestamp", "1 hour", startTime=window_offset)
    return (
        rows.groupBy(hour.alias("_w"))
        .agg(*measures())
        .withColumn("window_start", F.col("_w.start"))
        .drop("_w")
    )


def present_hours(measured: DataFrame, *, with_processed_at: bool = True) -> DataFrame:
    """Closed windows in the layout of the hourly Gold table."""
    keyed = measured.withColumns(
        {
            "txn_date": F.to_date("window_start"),
            "txn_hour": F.hour("window_start"),
        }
    )
    return SUMMARIES["hourly_txn_summary"].present(keyed, with_processed_at)


def start_hourly(
    spark: SparkSession,
    bronze_path: str,
    output_path: str,
    checkpoint: str,
    *,
    lateness: str = LATENESS,
    spread: int = SPREAD,
    window_offset: str = "0 minutes",
    max_files_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append each hour's measures once the watermark has passed its end.

    Rows later than `lateness` are dropped, so a written hour is final. Read the output
    through `present_hours`.
    """
    bronze = bronze_stream(spark, bronze_path, max_files_per_trigger=max_files_per_trigger)
    rows = silver_stream(bronze, lateness=lateness, spread=spread)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        hourly_windows(rows, window_offset)
        .writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


# --- hours that correct themselves ----------------------------------------------------

#: Measures that a row leaving its hour is subtracted from.
_SUBTRACTED = ("n", "n_success", "n_failed", "n_pending", "amount_n", "amount_sum", "amount_misfit")


def _versions(spark: SparkSession, hours_path: str) -> dict[int, str]:
    found = subfolders(spark, hours_path.rstrip("/"), "version")
    return {int(v): folder for v, folder in found.items() if exists(spark, f"{folder}/_SUCCESS")}


def read_hours(
    spark: SparkSession, hours_path: str, before: int | None = None
) -> DataFrame:
    """The hours' measures as of the last micro-batch (of those `before` a number). Read them
    through `present_hours`."""
    versions = {v: f for v, f in _versions(spark, hours_path).items() if before is None or v < before}
    if not versions:
        return spark.createDataFrame([], s.HOURS)
    return spark.read.schema(s.HOURS).parquet(versions[max(versions)])


def changed_hours(
    hours: DataFrame, change: Change, index: IdIndex, window_offset: str = "0 minutes"
) -> DataFrame:
    """`hours` after a change that `index` has taken in already.

    Counts and exact sums are added and subtracted. A maximum cannot be subtracted: where the
    row that leaves held it, the hour's rows that still count are looked up.
    """
    entering = hourly_windows(change.added.transform(validate), window_offset)
    leaving = hourly_windows(change.removed.transform(validate), window_offset)
    lost = F.lit(None).cast("double").alias("_lost")
    names = s.HOURS.names
    signed = [
        hours.select(*names, lost),
        entering.select(*names, lost),
        leaving.select(
            *[
                (-F.col(c)).alias(c) if c in _SUBTRACTED else F.lit(None).cast("double").alias(c)
                for c in names[1:]
            ],
            "window_start",
            F.col("amount_max").alias("_lost"),
        ).select(*names, "_lost"),
    ]
    merged = staged(
        signed[0]
        .union(signed[1])
        .union(signed[2])
        .groupBy("window_start")
        .agg(*merged_measures(), F.max("_lost").alias("_lost"))
        .filter("n > 0")
    )
    open_hours = merged.filter("_lost >= amount_max").select("window_start")
    if open_hours.isEmpty():
        return merged.select(*names)
    exact = _maxima(index, open_hours, window_offset).withColumnRenamed("amount_max", "_exact")
    corrected = F.when(F.col("_lost") >= F.col("amount_max"), F.col("_exact")).otherwise(F.col("amount_max"))
    return (
        merged.join(exact, "window_start", "left").withColumn("amount_max", corrected).select(*names)
    )


def _maxima(index: IdIndex, hours: DataFrame, window_offset: str) -> DataFrame:
    """`(window_start, amount_max)` of the given hours, from the copies that count."""
    bounds = hours.agg(F.min("window_start").alias("low"), F.max("window_start").alias("high")).first()
    inside = (F.col(TIME) >= F.lit(bounds["low"])) & (F.col(TIME) < F.lit(bounds["high"]) + F.expr("interval 1 hour"))
    start = F.window(TIME, "1 hour", startTime=window_offset).getField("start")
    # All ids with a copy in these hours; which of its copies counts may be known elsewhere.
    ids = index.copies().filter(inside).select(ID, start.alias("window_start"))
    ids = ids.join(hours, "window_start", "left_semi").select(ID)
    counting = index.current(staged(ids)).transform(validate)
    found = hourly_windows(counting, window_offset).select("window_start", "amount_max")
    return found.join(hours, "window_start", "left_semi")


def update_hours(
    rows: DataFrame,
    hours_path: str,
    index: IdIndex,
    version: int,
    run: str,
    window_offset: str = "0 minutes",
) -> None:
    """Take complete, typed rows into the index as `run` and write the hours as `version`.

    The version before is the starting point and stays until the next one, so a micro-batch
    that failed anywhere is repeated with the same result.
    """
    spark = rows.sparkSession
    # The runs before are final by now; the present one can be repeated by its name.
    index.compact()
    change = index.absorb(rows, run)
    index.commit(run, change.added)
    hours = changed_hours(read_hours(spark, hours_path, before=version), change, index, window_offset)
    hours.coalesce(1).write.mode("overwrite").parquet(f"{hours_path.rstrip('/')}/version={version}")
    versions = _versions(spark, hours_path)
    last = max(v for v in versions if v <= version)
    before = max((v for v in versions if v < last), default=last)
    remove(spark, [folder for v, folder in versions.items() if v < before])


def start_live_hours(
    spark: SparkSession,
    bronze_path: str,
    hours_path: str,
    index_path: str,
    checkpoint: str,
    *,
    window_offset: str = "0 minutes",
    buckets: int = BUCKETS,
    max_files_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the table of hours at `hours_path` equal to the batch summary of all rows so far.

    A micro-batch costs its own rows, the index filters, the stored copies of its ids, and
    the table of hours, which has a row per hour. There is no watermark and no state beside
    these tables; one query writes to them.
    """
    bronze = bronze_stream(spark, bronze_path, max_files_per_trigger=max_files_per_trigger)
    rows = bronze.transform(enforce_schema).transform(handle_nulls)

    def update(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        source = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        index = IdIndex(session, index_path, buckets)
        update_hours(batch, hours_path, index, batch_id, f"{source}-{batch_id}", window_offset)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        rows.writeStream.foreachBatch(update)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
