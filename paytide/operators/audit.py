"""Counts that explain what a layer did to its input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paytide import schema as s
from paytide.functions.casting import conform
from paytide.functions.rules import all_of, validation_rules
from paytide.functions.scalars import flag


def audit_counters(rules: dict[str, Column] | None = None) -> list[Column]:
    """Row counters of the validation step, usable in `agg` and in `observe`."""
    rules = rules or validation_rules()
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(all_of(rules)).alias("output_rows"),
        *[F.count_if(~flag(rule)).alias(f"failed_{name}") for name, rule in rules.items()],
    ]


def validation_audit(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """One row: rows in, rows out and failures per rule, from a single pass."""
    return df.agg(*audit_counters(rules))


def conversion_audit(df: DataFrame, schema: StructType = s.TYPED) -> DataFrame:
    """`(column_name, n_values, n_lost)` for every column of `schema`: values that are
    there, and those of them that do not convert to the declared type. One pass over raw rows."""
    have = {f.name: f.dataType for f in df.schema}
    counters, lines = [], []
    for f in schema:
        value = F.col(f.name)
        gone = value.isNotNull() & conform(value, have.get(f.name), f.dataType).isNull()
        counters += [F.count(value).alias(f"{f.name}_n"), F.count_if(gone).alias(f"{f.name}_lost")]
        lines.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"{f.name}_n").alias("n_values"),
                F.col(f"{f.name}_lost").alias("n_lost"),
            )
        )
    return df.agg(*counters).select(F.inline(F.array(*lines)))


def status_counts(df: DataFrame) -> DataFrame:
    """Rows per known status, most frequent first."""
    return (
        df.filter(F.col("status").isNotNull())
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("txns"))
        .orderBy(F.desc("txns"), "status")
    )


def anomaly_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if("is_anomaly").alias("anomalies"))


def table_shape(df: DataFrame) -> DataFrame:
    """Row count, column count and column names."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.lit(",".join(df.columns)).alias("column_names"),
    )


def first_rows(df: DataFrame, n: int = 3, order_by: tuple[str, ...] = ()) -> DataFrame:
    """A peek at `n` rows; give `order_by` for a repeatable one (planned as a top-n)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def bronze_profile(df: DataFrame) -> DataFrame:
    """Shape, status mix and anomaly count of a whole table as (metric, item, value).

    One scan: the grand total comes from the same rollup as the status groups. An empty
    table has no facts.
    """
    counted = df.rollup("status").agg(
        F.grouping("status").alias("is_total"),
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_anomaly").alias("anomalies"),
    )

    def fact(metric: str, item: Column, value: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"), item.alias("item"), value.cast("long").alias("value")
        )

    totals = F.array(
        fact("rows", F.lit("all"), F.col("n")),
        fact("columns", F.lit("all"), F.lit(len(df.columns))),
        fact("anomalies", F.lit("all"), F.col("anomalies")),
    )
    by_status = F.array(fact("status", F.col("status"), F.col("n")))
    return counted.filter("is_total = 1 OR status IS NOT NULL").select(
        F.inline(F.when(F.col("is_total") == 1, totals).otherwise(by_status))
    )
