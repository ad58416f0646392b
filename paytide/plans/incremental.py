"""Taking in new rows without rebuilding history.

New rows meet the stored copies of their ids through the id index. What changes is the days
of the copies that count from now on and of those that no longer do; only these days are
rewritten in Silver and in the rollup behind Gold. The index is brought up to date last: a
run that failed half-way finds the same changes when it is repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide import schema as s
from paytide.operators.cleansing import enforce_schema, handle_nulls, validate
from paytide.operators.enrichment import enrich
from paytide.plans.gold import run_gold
from paytide.plans.pipeline import Paths
from paytide.sources.id_index import BUCKETS, ID, Change, IdIndex
from paytide.sources.lake import (
    PARTITION,
    append_bronze,
    drop_days,
    on_days,
    read_bronze,
    read_silver,
    stored_days,
    write_silver,
)
from paytide.sources.staging import staged


def days_of(df: DataFrame) -> list[date | None]:
    """The days a frame has rows of; None stands for rows without one."""
    return [r[0] for r in df.select(PARTITION).distinct().collect()]


def apply_change(spark: SparkSession, silver_path: str, change: Change) -> list[date | None]:
    """Bring Silver in line with a change and return the days it touched.

    Rows of all ids in the change leave their days, copies that count now and meet all rules
    enter theirs. The other days are neither read nor written; a day left without rows is
    removed. Repeating a change changes nothing.
    """
    days = days_of(change.added.select(PARTITION).union(change.removed.select(PARTITION)))
    entering = change.added.transform(validate).transform(enrich).select(*s.SILVER.names)
    if not stored_days(spark, silver_path):
        write_silver(entering, silver_path, incremental=True)
        return days
    stored = on_days(read_silver(spark, silver_path), days)
    staying = stored.join(change.added.select(ID), ID, "left_anti").select(*stored.columns)
    after = staged(staying.unionByName(entering))
    write_silver(after, silver_path, incremental=True)
    drop_days(spark, silver_path, set(days) - set(days_of(after)))
    return days


def run_incremental(
    spark: SparkSession,
    paths: Paths,
    batch: DataFrame | None = None,
    batch_date: date | str | None = None,
    *,
    days: Collection[date | str | None] | None = None,
    buckets: int = BUCKETS,
) -> dict[str, int]:
    """Take in a batch (if any), then bring Silver and Gold up to date; the result is that
    of `run_pipeline`.

    Of Bronze the batch's days are read, or the `days` given; in the first run all of it.
    Of Silver and the rollup only days whose rows change are read and written, of the index
    only filters and the buckets that may hold an id of those days. `buckets` counts in the
    first run. Returns the number of ids whose copy changed, of days touched, and the rows
    per Gold table.
    """
    if paths.index is None:
        raise ValueError("an incremental run needs a path for the id index")
    index = IdIndex(spark, paths.index, buckets)
    first = not index.runs()
    if batch is not None:
        append_bronze(batch, paths.bronze, batch_date)
        if days is None and not first:
            # Folders bear the day as the batch spells it.
            days = [batch_date]
            if batch_date is None and PARTITION in batch.columns:
                days = days_of(batch.select(F.col(PARTITION).cast("string")))
    bronze = read_bronze(spark, paths.bronze)
    if not first:
        if days is None:
            raise ValueError("name the days to take in, or pass their batch")
        bronze = on_days(bronze, days)
    rows = bronze.transform(enforce_schema).transform(handle_nulls)
    run = uuid.uuid4().hex
    change = index.absorb(rows, run)
    if first:
        drop_days(spark, paths.silver, stored_days(spark, paths.silver))
    touched = apply_change(spark, paths.silver, change)
    gold = run_gold(spark, paths.silver, paths.gold, days=None if first else touched)
    index.commit(run, change.added)
    index.compact()
    return {"changed_ids": change.added.count(), "touched_days": len(touched), **gold}

