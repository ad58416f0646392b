"""Whitening of embeddings with distributed block matrices.

1. Vectors are put on a grid of whole numbers; the distinct ones, their number `n` and their
   sums `S` per dimension are the fit. Sums of whole numbers are exact in any order.
2. The distinct vectors, centred as (n * x - S) / n, are indexed into block matrices; the
   transpose of each times itself gives its part of the scatter.
3. The scatter, of the size of a vector squared, is decomposed on the driver. The whitening
   matrix is a block matrix too and projects the rows of all vectors.
The whitened fit is multiplied by its own transpose once more, which gives the error.

A product of block matrices deals its blocks to about the square root of the partitions
asked for, and a task holds what it is dealt. So rows are indexed in bands of `BAND` blocks
of about `BLOCK_VALUES` numbers, one block matrix each: a task holds at most an eighth of a
band (64 MB) however many rows there are.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytide.llm.frames import narrowed, scratch_path, staged

#: Numbers of a block, row blocks of a band, row blocks of a scatter's task.
BLOCK_VALUES, BAND, GROUP = 1 << 16, 1024, 16
#: Partitions asked for by a projection, whose blocks go to the root of that many tasks.
SPREAD = 64
#: Grid values of this size or more are off the grid: sums of a batch stay within a long.
GRID = 1 << 40


class Bands:
    """Rows with a gapless `index` from 0, stored by bands of `size` rows."""

    def __init__(self, df: DataFrame, block_rows: int, blocks: int = BAND):
        self.block_rows, self.size = block_rows, block_rows * blocks
        rows = staged(
            df.withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id())
        )
        # A row for each partition that wrote; the lower bits of its ids count from 0.
        parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("low")).collect()
        begins, at = [], 0
        for r in sorted(parts, key=lambda r: r["_part"]):
            begins.append((r["_part"], at - r["low"]))
            at += r["n"]
        self.n = at
        shift = df.sparkSession.createDataFrame(begins, "_part int, _shift long")
        index = F.col("_id") + F.col("_shift")
        path = scratch_path(df.sparkSession, "bands")
        (
            rows.join(F.broadcast(shift), "_part")
            .select(*df.columns, index.alias("index"), F.floor(index / self.size).cast("long").alias("band"))
            .write.partitionBy("band")
            .parquet(path)
        )
        self.rows = df.sparkSession.read.parquet(path) if at else None

    def __iter__(self):
        """(rows of the band, their number), band by band; only the band's files are read."""
        for band in range(-(-self.n // self.size)):
            own = self.rows.filter(F.col("band") == band)
            yield own, min(self.size, self.n - band * self.size)


def _sums(fit: DataFrame, dim: int) -> list[int]:
    """Exact sum of the vectors in each dimension."""

    def run(batches):
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(len(batch), dim)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dim), pa.int32()), pa.array(x.sum(axis=0))], names=["d", "s"]
            )

    parts = fit.select("x").mapInArrow(run, "d int, s long")
    rows = parts.groupBy("d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    return [int(r["s"]) for r in sorted(rows, key=lambda r: r["d"])]


class Centre:
    """The fit's mean as whole numbers: S = n * base + rest."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """(n * x - S) / n."""
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums over dimensions of (n * x - S) squared, as whole numbers of any size."""
        off = x - self.base
        most = self.n * (int(np.abs(off).max(initial=0)) + 1)
        kind = np.int64 if most * most * x.shape[1] < 2**62 else object
        d = off.astype(kind) * self.n - self.rest.astype(kind)
        return (d * d).sum(axis=1).tolist()


def _block_matrix(rows: DataFrame, n_rows: int, first: int, centre: Centre, block_rows: int) -> BlockMatrix:
    """The centred rows of a band as a block matrix of one block's width."""
    dim = len(centre.base)

    def run(batches):
        for batch in batches:
            values = centre.centred(batch["x"].flatten().to_numpy().reshape(len(batch), dim))
            offsets = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * dim)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch["index"].to_numpy() - first),
                    pa.ListArray.from_arrays(offsets, pa.array(values.ravel())),
                ],
                names=["index", "v"],
            )

    arrays = rows.select("index", "x").mapInArrow(run, "index long, v array<double>")
    vectors = MLUtils.convertVectorColumnsFromML(
        arrays.select("index", array_to_vector("v").alias("vector")), "vector"
    )
    return IndexedRowMatrix(vectors, n_rows, dim).toBlockMatrix(block_rows, dim)


def _scatter(m: BlockMatrix) -> np.ndarray:
    """m' m. The plain call would bring all blocks into the one task of the one-block
    product, so the overload that splits the common dimension is called."""
    groups = max(1, -(-m.numRowBlocks // GROUP))
    product = m.transpose()._java_matrix_wrapper.call("multiply", m._java_matrix_wrapper._java_model, groups)
    return BlockMatrix(product, m.colsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


def _projected(spark: SparkSession, m: BlockMatrix, weights: np.ndarray) -> BlockMatrix:
    dim, k = weights.shape
    block = ((0, 0), DenseMatrix(dim, k, weights.ravel(order="F")))
    return m.multiply(BlockMatrix(spark.sparkContext.parallelize([block], SPREAD), dim, k, dim, k))


def whitened(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = 16,
    scale: int = 64,
    shift: int = 1_000_000,
    band: int = BAND,
) -> DataFrame:
    """One row per usable row and component: `(vec_id, component, n, deviation, whitened,
    explained, identity_error)`.

    Entries become x = floor(scale * entry) + shift. The fit holds each distinct x vector
    once: `n` of them with sums S. Components are unit eigenvectors of the fit's covariance
    (divisor n) by falling eigenvalue, of which there are as many as the covariance has
    rank, at most `components`; `whitened` is x - S/n projected on the component over the
    root of its eigenvalue; `explained` the eigenvalue's share of the trace;
    `deviation` the sum over dimensions of (n * x - S) squared (an error where it exceeds a
    long); `identity_error` the largest absolute entry of the whitened fit's covariance
    minus the identity.

    Vectors that are null or hold null or non-finite entries are left out, and so are empty
    ones, those of another length than most vectors have (of equally frequent lengths the
    greater counts) and those with an entry of 2**40 / scale or more. A table without usable
    vectors, or with only equal ones, gives no rows. Equal eigenvalues (ties) leave the
    choice of their components open, the same for all rows. Rows that repeat an id or a
    vector come back as often as they are given; a null id stays null. Other columns are
    not read.
    """
    spark = df.sparkSession
    rows = narrowed(df, vec_id=id_col, vector=vector_col)
    rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    usable = f"NOT exists(vector, c -> c IS NULL OR isnan(c) OR NOT abs(c) < {GRID / scale!r}D)"
    whole = F.transform("vector", lambda c: F.floor(c * scale) + shift).cast("array<long>")
    rows = staged(rows.filter("size(vector) > 0").filter(usable).select("vec_id", whole.alias("x")))
    lengths = rows.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    out = (
        "vec_id " + rows.schema["vec_id"].dataType.simpleString() + ", component int, n long,"
        " deviation long, whitened double, explained double, identity_error double"
    )
    if most is None:
        return spark.createDataFrame([], out)
    dim = most["dim"]
    block_rows = max(1, BLOCK_VALUES // dim)
    rows = rows.filter(F.size("x") == dim)
    fit = Bands(rows.select("x").distinct(), block_rows, band)
    n = fit.n
    centre = Centre(n, _sums(fit.rows, dim))

    def matrices(bands: Bands):
        for i, (own, size) in enumerate(bands):
            yield _block_matrix(own, size, i * bands.size, centre, block_rows)

    def kept(bands: Bands):
        # A product asks for the blocks twice, first for their places only.
        for m in matrices(bands):
            m.persist(StorageLevel.MEMORY_AND_DISK)
            yield m
            m._java_matrix_wrapper._java_model.blocks().unpersist(True)

    scatter = reduce(np.add, [_scatter(m) for m in kept(fit)])
    values, vectors = np.linalg.eigh(scatter / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    # Rounding leaves eigenvalues of this size where there is no rank.
    k = min(components, int((values > max(values[0], 0.0) * dim * 1e-14).sum()))
    if not k:
        return spark.createDataFrame([], out)
    weights = vectors[:, :k] / np.sqrt(values[:k])
    explained = (values[:k] / values.sum()).tolist()
    covariance = reduce(np.add, [_scatter(_projected(spark, m, weights)) for m in kept(fit)]) / n
    error = float(np.abs(covariance - np.eye(k)).max())

    every = Bands(rows, block_rows, band)

    def project(i: int, m: BlockMatrix) -> DataFrame:
        first = i * every.size
        found = _projected(spark, m, weights).toIndexedRowMatrix().rows
        return found.map(lambda r: (r.index + first, r.vector.toArray().tolist())).toDF(
            "index long, w array<double>"
        )

    parts = [project(i, m) for i, m in enumerate(matrices(every))]
    projected = staged(reduce(DataFrame.union, parts))

    def deviate(batches):
        for batch in batches:
            x = batch["x"].flatten().to_numpy().reshape(len(batch), dim)
            yield pa.RecordBatch.from_arrays(
                [batch["index"], batch["vec_id"], pa.array(centre.deviations(x), pa.int64())],
                names=["index", "vec_id", "deviation"],
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    measured = every.rows.select("index", "vec_id", "x").mapInArrow(
        deviate, f"index long, vec_id {kind}, deviation long"
    )
    return (
        measured.join(projected, "index")
        .select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.element_at(F.lit(explained), F.col("at") + 1).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
