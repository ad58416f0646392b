"""Small helpers for frames: names, order-free sums and staging."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.sources.staging import scratch_path, staged

__all__ = ["arrow_groups", "fresh", "importable", "narrowed", "scratch_path", "staged", "without"]


#: Workers give memory back to the system when a batch is done, instead of keeping it for
#: the next one: an executor has several of them, which rarely need it at once.
_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "1",
    "MALLOC_MMAP_THRESHOLD_": "262144",
    "MALLOC_TRIM_THRESHOLD_": "262144",
}


def importable(spark: SparkSession) -> None:
    """Let Python workers that see this checkout import it, wherever the driver was started.
    On a cluster without it the package is shipped as usual, with `--py-files`. Settings of
    memory that the workers' environment has already are left alone."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    for name, value in _MEMORY.items():
        environment.setdefault(name, value)
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that `df` does not have yet, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """`df` less the columns an operator is about to add (its own values replace them)."""
    added = {n.lower() for n in names}
    return df.select([quoted(c) for c in df.columns if c.lower() not in added])


def quoted(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def narrowed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator reads, under the operator's own names."""
    return df.select(*[quoted(source).alias(name) for name, source in columns.items()])


def arrow_groups(batches, keys: list[str]):
    """Consecutive rows of equal integer keys, from batches sorted by them.

    Yields Arrow tables; only one group and the current batch are held. Much cheaper than
    a grouped function call where groups are small and many.
    """
    import numpy as np
    import pyarrow as pa

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        n = len(table)
        if not n:
            continue
        change = np.zeros(n, bool)
        change[0] = True
        for key in keys:
            values = table[key].to_numpy()
            change[1:] |= values[1:] != values[:-1]
        cuts = np.flatnonzero(change)
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield table.slice(lo, hi - lo)
        held = table.slice(cuts[-1])
    if held is not None and len(held):
        yield held
