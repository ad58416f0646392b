"""Silver to the four Gold tables."""

from __future__ import annotations

from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import SparkSession

from paytide.operators.summaries import gold_tables, txn_rollup
from paytide.sources.files import exists
from paytide.sources.lake import (
    drop_days,
    on_days,
    read_rollup,
    read_silver,
    rollup_path,
    stored_days,
    write_gold_table,
    write_rollup,
)


def run_gold(
    spark: SparkSession,
    silver_path: str,
    gold_root: str,
    *,
    since: date | str | None = None,
    until: date | str | None = None,
    days: Collection[date | str | None] | None = None,
) -> dict[str, int]:
    """Rebuild the Gold tables; returns rows per table.

    One scan of Silver ends in a rollup of a few hundred thousand rows per month at most
    (days x hours x banks x categories), stored by day beside the tables. Each table is a
    re-aggregation of that rollup, so it always covers all days. These are small jobs and
    are submitted together.

    With `since` / `until`, or with `days` (None in it for rows without a day), only those
    days of Silver are read and only they are replaced in the rollup; days that Silver no
    longer has disappear from it. Without a stored rollup all days are read, whatever the
    range. A run that failed half-way is repeated as it was.
    """
    ranged = since is not None or until is not None or days is not None
    ranged = ranged and exists(spark, rollup_path(gold_root))
    rows = read_silver(spark, silver_path)
    if ranged:
        rows = read_silver(spark, silver_path, since=since, until=until)
        rows = rows if days is None else on_days(rows, days)
    write_rollup(txn_rollup(rows), gold_root, incremental=ranged)
    if ranged:
        gone = stored_days(spark, rollup_path(gold_root)).keys() - stored_days(spark, silver_path).keys()
        drop_days(spark, rollup_path(gold_root), [d for d in gone if _asked(d, since, until, days)])

    tables = gold_tables(read_rollup(spark, gold_root))
    with ThreadPoolExecutor(len(tables)) as pool:
        written = {
            name: pool.submit(write_gold_table, table, gold_root, name)
            for name, table in tables.items()
        }
    return {name: count.result() for name, count in written.items()}


def _asked(day: str | None, since, until, days) -> bool:
    """Whether a stored day is one of those a run was asked for."""
    if days is not None and day not in {None if d is None else str(d) for d in days}:
        return False
    if day is None:
        return since is None and until is None
    return (since is None or day >= str(since)) and (until is None or day <= str(until))
