"""Silver steps that decide which rows survive and with which types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, MapType, StructType, VariantType

from paytide import schema as s
from paytide.functions.casting import conform
from paytide.functions.rules import all_of, validation_rules


def enforce_schema(
    df: DataFrame,
    schema: StructType = s.TYPED,
    *,
    date_from_event: bool = False,
    keep_raw: str | None = None,
    losses: Observation | None = None,
) -> DataFrame:
    """Give every column of `schema` its declared type, in place and in one projection.

    Values that do not convert become NULL. Columns outside the schema pass through.
    `txn_date` is the batch date as stored; `date_from_event` derives it from
    `txn_timestamp` instead.

    `keep_raw` names a column to add: the text of all values a row lost, by column, or NULL
    if it lost none. `losses` observes `lost_<column>`, the values each converted column
    lost, counted by the job that consumes the frame instead of a job of its own.
    """
    have = {f.name: f.dataType for f in df.schema}
    typed = {f.name: conform(F.col(f.name), have.get(f.name), f.dataType) for f in schema}
    if keep_raw is None and losses is None:
        if date_from_event:
            typed["txn_date"] = F.to_date(typed["txn_timestamp"])
        return df.withColumns(typed)
    # Raw values travel beside the typed ones, so that each is converted once.
    converted = [f.name for f in schema if have.get(f.name) != f.dataType]
    raw = {name: f"_raw_{name}" for name in converted}
    out = df.withColumns({raw[name]: F.col(name) for name in converted}).withColumns(typed)
    lost = {name: F.col(raw[name]).isNotNull() & F.col(name).isNull() for name in converted}
    if losses is not None:
        counters = [F.count_if(gone).alias(f"lost_{name}") for name, gone in lost.items()]
        out = out.observe(losses, *(counters or [F.lit(0).alias("lost")]))
    if keep_raw is not None:
        entries = [
            F.when(gone, F.struct(F.lit(name).alias("column"), F.col(raw[name]).cast("string").alias("text")))
            for name, gone in lost.items()
        ]
        held = F.filter(F.array(*entries), lambda e: e.isNotNull()) if entries else F.array()
        kept = F.when(F.size(held) > 0, F.map_from_entries(held)) if entries else F.lit(None)
        out = out.withColumn(keep_raw, kept.cast("map<string,string>"))
    out = out.drop(*raw.values())
    return out.withColumn("txn_date", F.to_date("txn_timestamp")) if date_from_event else out


def drop_critical_nulls(
    df: DataFrame, columns: Sequence[str] = s.CRITICAL_COLUMNS
) -> DataFrame:
    """Drop rows with a NULL (or NaN) in a column that has to be known.

    Written as plain `IS NOT NULL` terms rather than `na.drop`, which compiles to a
    form the Parquet reader cannot use as a pushed filter.
    """
    fractional = {
        f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))
    }
    present: dict[str, Column] = {}
    for name in columns:
        present[name] = F.col(name).isNotNull()
        if name in fractional:
            present[f"{name} is a number"] = ~F.isnan(name)
    return df.filter(all_of(present))


def fill_optional(df: DataFrame, values: Mapping[str, str] = s.FILL_VALUES) -> DataFrame:
    return df.na.fill(dict(values))


def handle_nulls(df: DataFrame) -> DataFrame:
    return df.transform(drop_critical_nulls).transform(fill_optional)


def deduplicate(
    df: DataFrame,
    keys: Sequence[str] = ("txn_id",),
    order_by: Sequence[str] = ("txn_timestamp",),
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first row per key.

    Ties on `order_by` are settled by `tiebreak`, by default every remaining column, so
    that a task re-run after a lost executor picks the same row again. The
    `row_number() = 1` shape lets Spark keep one row per key on the map side before the
    shuffle, so a key holding a large share of the table sends one row per map task.
    """
    if tiebreak is None:
        unordered = (MapType, VariantType)
        tiebreak = [
            f.name
            for f in df.schema
            if f.name not in {*keys, *order_by} and not isinstance(f.dataType, unordered)
        ]
    first = Window.partitionBy(*keys).orderBy(*order_by, *tiebreak)
    return df.withColumn("_seq", F.row_number().over(first)).filter("_seq = 1").drop("_seq")


def validate(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Keep rows that meet every rule; an unknown answer drops the row."""
    return df.filter(all_of(rules or validation_rules()))
