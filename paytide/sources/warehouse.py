"""Hand-over of Gold to a warehouse, and reading it back for the serving views."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns the warehouse stores as text.
TEXT_COLUMNS = ("TXN_DATE", "PROCESSED_AT")

# The order each table is presented in.
PRESENTATION_ORDER = {
    "HOURLY_TXN_SUMMARY": ("TXN_HOUR", True),
    "BANK_FAILURE_ANALYSIS": ("FAILURE_RATE_PCT", False),
    "MERCHANT_SPEND_ANALYSIS": ("TOTAL_SPEND", False),
    "ANOMALY_SUMMARY": ("ANOMALY_COUNT", False),
}


def prepare_df(df: DataFrame) -> DataFrame:
    """Warehouse form of a Gold table: upper-case names, dates and stamps as text.

    A missing date stays NULL rather than becoming a word.
    """
    return df.select(
        *[
            (F.col(c).cast("string") if c.upper() in TEXT_COLUMNS else F.col(c)).alias(c.upper())
            for c in df.columns
        ]
    )


def export_tables(
    tables: Mapping[str, DataFrame],
    *,
    fmt: str = "parquet",
    root: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """Fully replace each warehouse table.

    With `root` a table goes to the folder `root/NAME`. Without it, `fmt="jdbc"` or a
    warehouse connector gets the name as its `dbtable` option next to `options`, and
    writes straight from the executors. The tables are written side by side.
    """

    def export(name: str, df: DataFrame) -> None:
        writer = prepare_df(df).write.mode("overwrite").format(fmt).options(**(options or {}))
        if root is not None:
            writer.save(f"{root.rstrip('/')}/{name}")
        else:
            writer.option("dbtable", name).save()

    with ThreadPoolExecutor(max(1, len(tables))) as pool:
        list(pool.map(export, tables.keys(), tables.values()))


def export_to_catalog(
    tables: Mapping[str, DataFrame], database: str | None = None, root: str | None = None
) -> None:
    """Fully replace each table in the session catalog; its files go below `root`, if
    given, and to the catalog's own warehouse folder otherwise."""
    prefix = f"{database}." if database else ""
    for name, df in tables.items():
        writer = prepare_df(df).write.mode("overwrite")
        if root is not None:
            writer = writer.option("path", f"{root.rstrip('/')}/{name}")
        writer.saveAsTable(f"{prefix}{name}")


def present(df: DataFrame, name: str) -> DataFrame:
    """A warehouse table in its presentation order; remaining columns settle ties."""
    column, ascending = PRESENTATION_ORDER[name]
    lead = F.asc(column) if ascending else F.desc(column)
    rest = [c for c in df.columns if c not in (column, "PROCESSED_AT")]
    return df.orderBy(lead, *rest)


def load_data(spark: SparkSession, database: str | None = None) -> dict[str, DataFrame]:
    """The four catalog tables, each in presentation order."""
    prefix = f"{database}." if database else ""
    return {name: present(spark.table(f"{prefix}{name}"), name) for name in PRESENTATION_ORDER}
