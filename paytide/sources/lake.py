"""Bronze, Silver and Gold tables as Parquet directories."""

from __future__ import annotations

import json
from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StringType, StructField, StructType

from paytide import schema as s
from paytide.functions.casting import conform
from paytide.sources.files import data_files, exists, remove, subfolders

PARTITION = "txn_date"
# What a folder is called that holds the rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    # A declared schema skips footer inference over every file, and the projection puts
    # the partition column back where the schema has it.
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _between(df: DataFrame, since: date | str | None, until: date | str | None) -> DataFrame:
    """Inclusive day range on the partition column, so only those folders are listed."""
    kind = df.schema[PARTITION].dataType
    if since is not None:
        df = df.filter(F.col(PARTITION) >= F.lit(str(since)).cast(kind))
    if until is not None:
        df = df.filter(F.col(PARTITION) <= F.lit(str(until)).cast(kind))
    return df


def on_days(df: DataFrame, days: Collection[date | str | None]) -> DataFrame:
    """Rows of the given days, None standing for rows without one; only those folders are
    listed."""
    kind = df.schema[PARTITION].dataType
    named = [F.lit(str(d)).cast(kind) for d in days if d is not None]
    wanted: Column = F.col(PARTITION).isin(*named) if named else F.lit(False)
    return df.filter(wanted | F.col(PARTITION).isNull() if None in days else wanted)


def stored_days(spark: SparkSession, path: str) -> dict[str | None, str]:
    """Folders of a table's days, by day; None for rows without one."""
    found = subfolders(spark, path, PARTITION)
    return {None if day == NO_DAY else day: folder for day, folder in found.items()}


def drop_days(spark: SparkSession, path: str, days: Collection[date | str | None]) -> None:
    """Remove the folders of whole days; days without one do no harm."""
    folders = stored_days(spark, path)
    wanted = {None if d is None else str(d) for d in days}
    remove(spark, [folder for day, folder in folders.items() if day in wanted])


def _extras_path(path: str) -> str:
    # Not seen by readers of the table itself.
    return f"{path.rstrip('/')}/_columns"


def bronze_extras(spark: SparkSession, path: str) -> StructType:
    """The undeclared columns a Bronze table has been given, with the type of each."""
    if not exists(spark, _extras_path(path)):
        return StructType()
    listed = spark.read.schema("name string, type string").parquet(_extras_path(path))
    # A column registered twice, by batches at the same time, has one type for all readers.
    rows = listed.groupBy("name").agg(F.min("type").alias("type")).orderBy("name").collect()
    return StructType([StructField.fromJson(json.loads(r["type"])) for r in rows])


def read_bronze(
    spark: SparkSession,
    path: str,
    *,
    since: date | str | None = None,
    until: date | str | None = None,
    extras: bool = False,
) -> DataFrame:
    """Raw transactions. `txn_date` is the batch date of the folder a file sits in.

    `extras` adds the undeclared columns of all batches, NULL in batches without them.
    """
    schema = s.BRONZE
    if extras:
        schema = StructType(schema.fields + bronze_extras(spark, path).fields)
    return _between(_read(spark, path, schema), since, until)


def read_mixed(spark: SparkSession, path: str) -> DataFrame:
    """Raw transactions of files that do not agree on their types, as the Bronze table has
    them: e.g. from a writer that stores a column without any value as a number.

    Each file's schema is read from its footer, files of equal schemas are scanned together,
    and the scans are brought to the declared types; a declared column that a file lacks is
    NULL. An undeclared column keeps its type, or becomes text where files differ. For
    folders of arriving files, whose list and footers the driver can hold; `append_bronze`
    the result to have a table of one schema.
    """

    def schema_of(file: str) -> str:
        return spark.read.option("basePath", path).parquet(file).schema.json()

    files = data_files(spark, path)
    by_schema: dict[str, list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, schema in zip(files, pool.map(schema_of, files), strict=True):
            by_schema.setdefault(schema, []).append(file)
    if not by_schema:
        return spark.createDataFrame([], s.BRONZE)
    scans = [
        spark.read.schema(StructType.fromJson(json.loads(schema))).option("basePath", path).parquet(*own)
        for schema, own in by_schema.items()
    ]
    declared = {name.lower() for name in s.BRONZE.names}
    types: dict[str, set] = {}
    for scan in scans:
        for f in scan.schema:
            if f.name.lower() not in declared:
                types.setdefault(f.name, set()).add(f.dataType)
    parts = []
    for scan in scans:
        own = _conformed(scan)
        for name, found in types.items():
            kind = next(iter(found)) if len(found) == 1 else StringType()
            value = F.col(f"`{name}`") if name in scan.columns else F.lit(None)
            own[name] = value.cast(kind)
        parts.append(scan.select([column.alias(name) for name, column in own.items()]))
    return reduce(DataFrame.unionByName, parts)


def _conformed(df: DataFrame) -> dict[str, Column]:
    """The declared Bronze columns of `df`, each in its declared type."""
    have = {f.name.lower(): f for f in df.schema}
    out = {}
    for f in s.BRONZE:
        found = have.get(f.name.lower())
        value = F.lit(None) if found is None else F.col(f"`{found.name}`")
        out[f.name] = conform(value, found.dataType, f.dataType) if found else value.cast(f.dataType)
    return out


def _by_day(df: DataFrame, compact: bool) -> DataFrame:
    """Bring the rows of a day together before a partitioned write.

    Without it every task opens a file for every day it sees. The rebalance is adaptive,
    so a day holding a large share of the rows is still split over many tasks and small
    days share one.
    """
    return df.hint("rebalance", F.col(PARTITION)) if compact else df


def append_bronze(
    df: DataFrame,
    path: str,
    batch_date: date | str | None = None,
    *,
    compact: bool = True,
) -> None:
    """Add one batch to the Bronze table; earlier batches stay.

    Every declared column is written with its declared type, also when it holds no value at
    all or is missing, so that all files of the table agree; a value that does not fit
    becomes NULL and does not fail the batch. Undeclared columns are stored too, in the type
    the table first saw them with (see `bronze_extras`). `batch_date` files the whole batch
    under one day; without it each row goes to the day in its own `txn_date`.
    """
    spark = df.sparkSession
    columns = _conformed(df)
    declared = {name.lower() for name in s.BRONZE.names}
    undeclared = [f for f in df.schema if f.name.lower() not in declared]
    if undeclared:
        known = {f.name.lower(): f for f in bronze_extras(spark, path)}
        new = []
        for f in undeclared:
            # A column without a type yet is stored as text.
            kind = StringType() if isinstance(f.dataType, NullType) else f.dataType
            target = known.get(f.name.lower()) or StructField(f.name, kind)
            if f.name.lower() not in known:
                new.append((target.name, json.dumps(target.jsonValue())))
            columns[target.name] = conform(F.col(f"`{f.name}`"), f.dataType, target.dataType)
        if new:
            names = spark.createDataFrame(new, "name string, type string")
            names.coalesce(1).write.mode("append").parquet(_extras_path(path))
    out = df.select(*[column.alias(name) for name, column in columns.items()])
    if batch_date is not None:
        out = out.withColumn(PARTITION, F.lit(str(batch_date)))
    _by_day(out, compact).write.mode("append").partitionBy(PARTITION).parquet(path)


def read_silver(
    spark: SparkSession,
    path: str,
    *,
    since: date | str | None = None,
    until: date | str | None = None,
) -> DataFrame:
    return _between(_read(spark, path, s.SILVER), since, until)


def write_silver(
    df: DataFrame, path: str, *, incremental: bool = False, compact: bool = True
) -> None:
    """Write Silver partitioned by day, replacing what is there.

    By default the whole table is replaced; `incremental` replaces only the days present
    in `df`. `compact` trades one shuffle for few files per day.
    """
    (
        _by_day(df, compact)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if incremental else "static")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def rollup_path(root: str) -> str:
    return f"{root.rstrip('/')}/txn_rollup"


def write_rollup(df: DataFrame, root: str, *, incremental: bool = False) -> None:
    """Store the rollup the Gold tables derive from, by day. `incremental` replaces only the
    days present in `df`."""
    write_silver(df.select(*s.ROLLUP.names), rollup_path(root), incremental=incremental)


def read_rollup(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, rollup_path(root), s.ROLLUP)


def gold_path(root: str, table_name: str) -> str:
    return f"{root.rstrip('/')}/{table_name}"


def write_gold_table(df: DataFrame, root: str, table_name: str) -> int:
    """Replace one Gold table and return its row count, counted by the write itself."""
    written = Observation(table_name)
    observed = df.observe(written, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("overwrite").parquet(gold_path(root, table_name))
    return written.get["rows"]


def read_gold_table(spark: SparkSession, root: str, table_name: str) -> DataFrame:
    return _read(spark, gold_path(root, table_name), s.GOLD[table_name])


def read_gold_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four Gold tables under their warehouse names, left distributed."""
    return {name.upper(): read_gold_table(spark, root, name) for name in s.GOLD}
