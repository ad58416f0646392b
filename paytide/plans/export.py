"""Gold to the warehouse."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from paytide.sources.lake import read_gold_tables
from paytide.sources.warehouse import export_tables


def run_export(
    spark: SparkSession,
    gold_root: str,
    *,
    fmt: str = "parquet",
    root: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace every warehouse table with its Gold table; no row passes the driver."""
    export_tables(read_gold_tables(spark, gold_root), fmt=fmt, root=root, options=options)
