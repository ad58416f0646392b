"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

1. The rows of every input partition are counted. The number of rows each partition sends
   to each shard is drawn, partition by partition, from the multivariate hypergeometric
   law over what the shards still lack: shard sizes come out exact.
2. Each task permutes its rows locally: a random arrangement of its labels decides which
   row goes where. Within its shard a row also gets a random block and a random key.
3. Rows are exchanged by block, and permuted again by their keys. A shard is its blocks one
   after another, so no task ever holds more than a block and all orders are equally likely.
All draws depend on the seed and the partition only, so a task that runs again repeats them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytide.llm.frames import fresh, without

#: Tasks of the second permutation: one for a few blocks, up to as many as Spark lists well.
_BLOCKS_PER_TASK, _TASKS = 4, 100_000
#: Above this population numpy's sampler does not apply.
_LARGE = 900_000_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of `draws` rows out of `good + bad` are good."""
    if good + bad < _LARGE:
        return int(rng.hypergeometric(good, bad, draws)) if draws else 0
    low, high = max(0, draws - bad), min(draws, good)
    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    p = math.exp(
        log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws)
    )
    # Inversion outwards from the mode: about a standard deviation of steps.
    u = rng.random() - p
    up, down, p_up, p_down = mode, mode, p, p
    while u > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return mode


def communication_matrix(rows: list[int], sizes: list[int], seed: int) -> np.ndarray:
    """Rows sent from each partition to each shard; row sums `rows`, column sums `sizes`."""
    rng = np.random.default_rng(seed)
    lacking = list(sizes)
    out = np.zeros((len(rows), len(sizes)), np.int64)
    for p, n in enumerate(rows):
        rest = sum(lacking)
        for j, want in enumerate(lacking):
            rest -= want
            k = hypergeometric(rng, want, rest, n)
            out[p, j] = k
            n -= k
        lacking = [a - int(b) for a, b in zip(lacking, out[p], strict=True)]
    return out


def _labels(counts: np.ndarray, blocks: int, seed: int, partition: int):
    """Shard, block and key of every row of a partition, in the order of its rows."""
    rng = np.random.default_rng([seed, partition])
    shard = rng.permutation(np.repeat(np.arange(len(counts), dtype=np.int32), counts))
    block = rng.integers(0, blocks, len(shard), dtype=np.int32)
    return shard, block, rng.integers(0, 2**63 - 1, len(shard), dtype=np.int64)


def uniform_shards(
    df: DataFrame, shards: int = 24, seed: int = 3, block_rows: int = 4096
) -> DataFrame:
    """`df` with `shard` (0 to `shards` - 1) and `slot` (gapless from 0 in each shard).

    Shard sizes differ by one row at most and every arrangement is equally likely, for
    nulls, repeated rows and equal texts alike: rows are told apart by place, not by value.
    Existing columns of the names `shard` and `slot` are replaced. An empty input gives no
    rows. The input must keep its partitions between two passes, as a scan of files or a
    staged table does; a task that finds another number of rows than was counted fails.
    The driver holds one small row of `shards` numbers per input partition.
    """
    spark = df.sparkSession
    df = without(df, ["shard", "slot"])
    block, key, offset = fresh(df, "block", "key", "offset")
    counted = {
        r["p"]: r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    }
    rows = [counted.get(p, 0) for p in range(max(counted, default=-1) + 1)]
    total = sum(rows)
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    blocks = max(1, math.ceil(sizes[0] / block_rows))
    matrix = communication_matrix(rows, sizes, seed)
    shared = spark.sparkContext.broadcast(matrix)

    def label(batches):
        partition = TaskContext.get().partitionId()
        counts = shared.value[partition] if partition < len(shared.value) else np.zeros(shards, int)
        labels = _labels(counts, blocks, seed, partition)
        at = 0
        for batch in batches:
            upto = at + len(batch)
            if upto > len(labels[0]):
                raise RuntimeError("the input changed its partitions between two passes")
            added = [pa.array(x[at:upto]) for x in labels]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)
            at = upto
        if at != len(labels[0]):
            raise RuntimeError("the input changed its partitions between two passes")

    def count_blocks(batches):
        for batch in batches:
            for p in batch["id"].to_pylist():
                shard, number, _ = _labels(shared.value[p], blocks, seed, p)
                n = np.bincount(shard.astype(np.int64) * blocks + number, minlength=shards * blocks)
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at // blocks).astype(np.int32)), pa.array((at % blocks).astype(np.int32)), pa.array(n[at])],
                    names=["shard", block, "n"],
                )

    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("shard", T.IntegerType()),
            T.StructField(block, T.IntegerType()),
            T.StructField(key, T.LongType()),
        ]
    )
    names = schema.names
    # A shard's first slots belong to its first block, and so on.
    before = Window.partitionBy("shard").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spark.range(len(rows))
        .mapInArrow(count_blocks, f"shard int, `{block}` int, n long")
        .groupBy("shard", block)
        .agg(F.sum("n").alias("n"))
        .select("shard", block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(offset))
    )
    place = F.row_number().over(Window.partitionBy("shard", block).orderBy(key))
    # The number of tasks follows the rows, not the session's setting: a few blocks each.
    tasks = min(_TASKS, math.ceil(shards * blocks / _BLOCKS_PER_TASK))
    placed = (
        df.mapInArrow(label, schema)
        .repartition(tasks, "shard", block)
        .withColumn("slot", place.cast("long") - 1)
    )
    return (
        placed.join(offsets, ["shard", block])
        .withColumn("slot", F.col("slot") + F.col(offset))
        .select(*df.columns, "shard", "slot")
    )
