"""Attaching a per-key table to rows without trusting the keys to be even."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

from paytide.sources.staging import staged

BROADCAST_BYTES = 32 * 1024 * 1024
MAX_HOT_KEYS = 50_000


def _bytes(lookup: DataFrame) -> int:
    """Bytes held by a (staged) lookup."""

    def width(field) -> Column:
        if isinstance(field.dataType, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0))
        if isinstance(field.dataType, ArrayType):  # of numbers
            return F.coalesce(F.size(field.name) * 8, F.lit(0))
        return F.lit(8)

    size = reduce(Column.__add__, [width(f) for f in lookup.schema])
    return lookup.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0


def _heaviest(weights: DataFrame, weight: str, at_most: int) -> DataFrame:
    """Keys standing for at least one in `at_most` of all rows, so no more than that many."""
    total = weights.agg(F.sum(weight).alias("rows")).first()["rows"] or 0
    return weights.filter(F.col(weight) >= max(1, total // at_most + 1))


def _left(rows: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on `keys` in which NULL keys match each other."""
    renamed = lookup.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = reduce(Column.__and__, [rows[k].eqNullSafe(renamed[f"_key_{k}"]) for k in keys])
    return rows.join(renamed, same, "left").drop(*[f"_key_{k}" for k in keys])


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    *,
    weight: str | None,
    spread_by: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """Left-join `lookup` (one row per key) to `rows`, keeping every row.

    `weight` is the lookup column holding how many of `rows` share the key. A lookup made
    from other rows does not know that: with None the keys of `rows` are counted, so that
    a key which is newly busy, or absent from the lookup, is spread as well. The lookup is
    staged and measured first; then

    * a lookup of at most `broadcast_bytes` is broadcast and `rows` are not shuffled;
    * a larger one is shuffled, except for its heaviest keys. A key counts as heavy from
      `rows / max_hot_keys` rows on, so there are at most `max_hot_keys` of them whatever
      the size of the table, and those are broadcast. Their rows take the answer from
      the broadcast and travel under a hash of `spread_by`, evenly over all tasks.

    A lookup column that `rows` have too, other than the keys, is an error. Staging and
    measuring run jobs while the frame is being built.
    """
    clash = sorted({c for c in lookup.columns if c not in keys} & set(rows.columns))
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(clash)}")
    lookup = staged(lookup)
    payload = [c for c in lookup.columns if c not in keys]
    if _bytes(lookup) <= broadcast_bytes:
        return _left(rows, F.broadcast(lookup), keys)

    if weight is None:
        counted = staged(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
        heavy = _left(_heaviest(counted, "_rows", max_hot_keys), lookup, keys)
    else:
        heavy = _heaviest(lookup, weight, max_hot_keys)
    hot = heavy.select(
        *keys, *[F.col(c).alias(f"_hot_{c}") for c in payload], F.lit(True).alias("_is_hot")
    )
    cold = lookup.withColumn("_salt", F.lit(0).cast("long"))
    salted = _left(rows, F.broadcast(hot), keys).withColumn(
        "_salt",
        F.when(F.col("_is_hot"), F.xxhash64(*spread_by)).otherwise(F.lit(0).cast("long")),
    )
    joined = _left(salted, cold, [*keys, "_salt"])
    return joined.select(
        *rows.columns,
        *[F.when(F.col("_is_hot"), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in payload],
    )
