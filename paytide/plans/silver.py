"""Bronze to Silver."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paytide.operators.audit import audit_counters
from paytide.operators.cleansing import deduplicate, enforce_schema, handle_nulls, validate
from paytide.operators.enrichment import enrich
from paytide.sources.lake import read_bronze, write_silver


def cleaned(
    bronze: DataFrame, *, date_from_event: bool = False, losses: Observation | None = None
) -> DataFrame:
    """Typed, complete, unique rows: what validation gets to see.

    The order is part of the result. Rows missing a critical value are gone before
    duplicates are resolved, and duplicates are resolved before rules are checked, so an
    id whose first copy breaks a rule does not come back through a later copy.
    """
    return (
        bronze.transform(enforce_schema, date_from_event=date_from_event, losses=losses)
        .transform(handle_nulls)
        .transform(deduplicate)
    )


def silver(
    bronze: DataFrame, *, date_from_event: bool = False, with_processed_at: bool = True
) -> DataFrame:
    return (
        cleaned(bronze, date_from_event=date_from_event)
        .transform(validate)
        .transform(enrich, with_processed_at=with_processed_at)
    )


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    *,
    since: date | str | None = None,
    until: date | str | None = None,
    incremental: bool = False,
    date_from_event: bool = False,
) -> dict[str, int]:
    """Rebuild Silver in one job and return its row counters.

    Bronze is read and shuffled once; the counters (rows, values lost in conversion by
    column, rows failing each rule) ride along with the write. They are
    log figures: a stage re-run after a lost executor may count its rows again. Use
    `validation_audit` where the numbers have to be exact.

    With `since` / `until` only those batch days are read, so a copy of an id filed under
    another day is not seen, and only the days that are read are replaced: a range implies
    `incremental`, so it never removes other days.
    """
    incremental = incremental or bool(since or until)
    if date_from_event and (since or until):
        # A late row would replace the whole of its event day with itself.
        raise ValueError("event days cannot be replaced from a range of batch days")
    loaded, lost, checked = (Observation(x) for x in ("bronze", "conversion", "validation"))
    bronze = read_bronze(spark, bronze_path, since=since, until=until)
    rows = (
        bronze.observe(loaded, F.count(F.lit(1)).alias("bronze_rows"))
        .transform(cleaned, date_from_event=date_from_event, losses=lost)
        .observe(checked, *audit_counters())
        .transform(validate)
        .transform(enrich)
    )
    write_silver(rows, silver_path, incremental=incremental)
    return {**loaded.get, **lost.get, **checked.get, "silver_columns": len(rows.columns)}
