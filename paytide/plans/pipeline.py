"""The daily chain: Bronze append, Silver, Gold. The export is a separate job.

`run_pipeline` rebuilds all of it; `plans.incremental.run_incremental` takes in new days.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from paytide.plans.gold import run_gold
from paytide.plans.silver import run_silver
from paytide.sources.lake import append_bronze


@dataclass(frozen=True)
class Paths:
    bronze: str
    silver: str
    gold: str
    #: Of incremental runs: which copy of an id counts.
    index: str | None = None


def run_pipeline(
    spark: SparkSession,
    paths: Paths,
    batch: DataFrame | None = None,
    batch_date: date | str | None = None,
) -> dict[str, dict[str, int]]:
    """Take in a batch (if any), then rebuild Silver and Gold from all of Bronze."""
    if batch is not None:
        append_bronze(batch, paths.bronze, batch_date)
    return {
        "silver": run_silver(spark, paths.bronze, paths.silver),
        "gold": run_gold(spark, paths.silver, paths.gold),
    }
