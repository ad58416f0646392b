"""Near-duplicate embeddings: cross-polytope hashing after fast Hadamard rotations.

Equal vectors form one class. A class is entered, in each of several tables, into its
home bucket (the closest signed axis after each of `parts` pseudo-random rotations) and
into the buckets with one part swapped for the second closest axis. Classes that share a
bucket are compared by their exact cosine in blocks of bounded size; a pair that meets in
several buckets counts in the first of them only, so counts add up without a table of all
pairs, and a block passes on a spanning forest of its links instead of the links.

The number of parts, and of axes told apart by the last one, follow the number of vectors,
so that there is about one home bucket per vector at any size. The number of tables follows
from the chance, measured on random pairs at the threshold, that such a pair shares a
bucket: a pair at the threshold is missed with a chance of at most `miss`, over the draw of
the rotations. Pairs within a cluster lie alike, so they are missed together or not at all:
the chance holds for each pair, not independently for all of them.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytide.llm.components import connected_components
from paytide.llm.frames import narrowed, staged
from paytide.operators.lookup import attach

#: Members of a bucket that one block holds on each side.
BLOCK = 1024
#: Rows that a task compares at a time, all small buckets among them together.
CHUNK = 4096
#: Buckets of up to this many rows are compared together, larger ones by a matrix product.
SMALL = 32
#: A class of equal vectors: its smallest id and a hash of the vector.
_NODE = "struct<id: bigint, tag: bigint>"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (their length is a power of two)."""
    n, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(n, -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, width)


def _width(dim: int) -> int:
    return 1 << max(1, math.ceil(math.log2(max(dim, 2))))


class Buckets:
    """Entries of vectors of one dimension; the last part looks at `last` axes only."""

    def __init__(self, dim: int, parts: int, last: int, tables: int, seed: int):
        self.width = _width(dim)
        self.parts, self.tables, self.dim = parts, tables, dim
        self.axes = [self.width] * (parts - 1) + [min(last, self.width)]
        draw = np.random.default_rng([seed, dim])
        self.signs = draw.choice([-1.0, 1.0], (tables, parts, 3, self.width))

    def of_table(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Bucket keys in one table, `(n, parts + 1)`: the home bucket first."""
        n = len(unit)
        x = np.zeros((n, self.width))
        x[:, : self.dim] = unit
        row = np.arange(n)
        scale = (2 * self.width) ** np.arange(self.parts)
        best = np.empty((n, self.parts), np.int64)
        second = np.empty((n, self.parts), np.int64)
        for p, axes in enumerate(self.axes):
            y = x
            for signs in self.signs[table, p]:
                y = hadamard(y * signs)
            size = np.abs(y[:, :axes])
            at = size.argmax(axis=1)
            best[:, p] = 2 * at + (y[row, at] < 0)
            size[row, at] = -1
            at = size.argmax(axis=1)
            second[:, p] = 2 * at + (y[row, at] < 0)
        home = (best * scale).sum(axis=1)
        return np.column_stack([home, home[:, None] + (second - best) * scale])

    def entries(self, unit: np.ndarray) -> np.ndarray:
        """Bucket keys in all tables, `(n, tables, parts + 1)`."""
        return np.stack([self.of_table(unit, t) for t in range(self.tables)], axis=1)


@lru_cache(maxsize=8)
def buckets(dim: int, parts: int, last: int, tables: int, seed: int) -> Buckets:
    return Buckets(dim, parts, last, tables, seed)


def plan(n: int, dim: int, threshold: float, miss: float, seed: int) -> tuple[int, int, int]:
    """(parts, axes of the last part, tables) for `n` vectors: see the module's text."""
    width = _width(dim)
    parts = 1
    while (2 * width) ** parts < n:
        parts += 1
    last = min(width, max(2, round(n / (2 * width) ** (parts - 1) / 2)))
    draw = np.random.default_rng(seed)
    hits = tried = 0
    # Rare hits take more pairs to be measured, each batch under rotations of its own.
    while hits < 400 and tried < 400_000:
        a, b = draw.normal(size=(2, 4000, dim))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
        b = threshold * a + math.sqrt(max(0.0, 1 - threshold**2)) * b
        one = Buckets(dim, parts, last, 1, seed + tried)
        ea, eb = one.entries(a)[:, 0], one.entries(b)[:, 0]
        hits += int((ea[:, :, None] == eb[:, None, :]).any(axis=(1, 2)).sum())
        tried += len(a)
    hit = min(max(hits, 1) / tried, 0.999)
    return parts, last, max(1, math.ceil(math.log(miss) / math.log1p(-hit)))


def _matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links `(a, b)` between 0..n-1 as a star for each connected part."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    nodes = np.flatnonzero(label != np.arange(n))
    return nodes, label[nodes]


def whole_groups(batches, keys: list[str], rows: int):
    """Arrow tables of whole groups from batches sorted by integer keys, with the places
    where their groups start. A table has `rows` rows at most, or a single group."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table]).combine_chunks()
        if not len(table):
            continue
        change = np.zeros(len(table), bool)
        change[0] = True
        for key in keys:
            values = table[key].to_numpy()
            change[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(change)
        at, end = 0, len(starts) - 1  # the last group may go on in the next batch
        while at < end:
            upto = int(np.searchsorted(starts, starts[at] + rows, side="right")) - 1
            upto = max(upto, at + 1)
            yield table.slice(starts[at], starts[upto] - starts[at]), starts[at:upto] - starts[at]
            at = upto
        held = table.slice(starts[end])
    if held is not None:
        yield held, np.zeros(1, np.int64)


def _alike(unit, starts, part, same, threshold):
    """Pairs of rows of one group, and of unequal `part` unless the group is `same`, with a
    cosine of `threshold` or more."""
    sizes = np.diff(np.append(starts, len(unit)))
    group = np.repeat(np.arange(len(starts)), np.where(sizes <= SMALL, sizes, 0))
    row = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    left, right = [], []
    for step in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
        at = np.flatnonzero(group[:-step] == group[step:])
        x, y = row[at], row[at + step]
        meant = same[x] | (part[x] != part[y])
        x, y = x[meant], y[meant]
        close = np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold
        left.append(x[close])
        right.append(y[close])
    for g in np.flatnonzero(sizes > SMALL):
        rows = np.arange(starts[g], starts[g] + sizes[g])
        if same[rows[0]]:
            x, y = np.nonzero(np.triu(unit[rows] @ unit[rows].T >= threshold, 1))
            left.append(rows[x])
            right.append(rows[y])
        else:
            one, two = rows[part[rows] == part[rows[0]]], rows[part[rows] != part[rows[0]]]
            x, y = np.nonzero(unit[one] @ unit[two].T >= threshold)
            left.append(one[x])
            right.append(two[y])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _first_meeting(x, y, unit, own: Buckets, table, bucket) -> np.ndarray:
    """Whether the bucket a pair was found in is the first that its vectors share.

    Tables are taken in turn and only for the vectors of pairs that are still open: most
    pairs that met before did so in one of the first.
    """
    first = np.ones(len(x), bool)
    for before in range(int(table[x].max()) + 1):
        still = np.flatnonzero(first & (table[x] >= before))
        used = np.unique(np.concatenate([x[still], y[still]]))
        place = np.zeros(len(unit), np.int64)
        place[used] = np.arange(len(used))
        keys = own.of_table(unit[used], before) if len(used) else None
        for lo in range(0, len(still), 1 << 16):
            at = still[lo : lo + (1 << 16)]
            p, q = keys[place[x[at]]], keys[place[y[at]]]
            # In the table the pair was found in, only smaller buckets come first.
            earlier = (table[x[at]] > before)[:, None] | (p < bucket[x[at]][:, None])
            met = (p[:, :, None] == q[:, None, :]) & earlier[:, :, None]
            first[at[met.any(axis=(1, 2))]] = False
    return first


def near_duplicate_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.9,
    miss: float = 1e-6,
    seed: int = 7,
) -> DataFrame:
    """`(vec_id, n_links, component_id, kept)`, one row per input row.

    `n_links` counts the other ids whose vector has a cosine of `threshold` or more, in
    double precision; `component_id` is the smallest id reachable by links and `kept`
    tells whether it is the row's own. Vectors that are null, empty, zero or hold null or
    non-finite numbers, and rows without an id, link with nothing: `n_links` 0, their own
    id as component, kept. Vectors of different lengths never link. Rows that repeat an
    id with an equal vector count once as a neighbour; an id with several vectors stands for
    each of them, every row with the links and the component of its own vector. Other columns
    are not read.
    """
    rows = narrowed(df, id=id_col, vector=vector_col).withColumn("id", F.col("id").cast("long"))
    element = rows.schema["vector"].dataType.elementType
    if isinstance(element, T.FloatType):
        kind = "<f4"
    else:
        kind = "<f8"
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    usable = F.coalesce(
        F.expr(
            "id IS NOT NULL AND vector IS NOT NULL"
            " AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))"
            " AND exists(vector, x -> x <> 0)"
        ),
        F.lit(False),
    )
    usable_rows = rows.filter(usable)
    classes = staged(
        usable_rows.groupBy("id", "vector")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("vector")
        .agg(F.min("id").alias("id"), F.count("id").alias("weight"), F.sum("copies").alias("copies"))
        .withColumn("tag", F.xxhash64("vector"))  # tells the vectors of one id apart
    )
    shape = classes.agg(
        F.count("id").alias("n"), F.max(F.size("vector")).alias("dim")
    ).first()
    parts, last, tables = plan(shape["n"], shape["dim"] or 2, threshold, miss, seed)

    def enter(batches):
        for whole in batches:
            for lo in range(0, len(whole), CHUNK):
                batch = whole.slice(lo, CHUNK)
                vectors = batch["vector"]
                offsets = np.asarray(vectors.offsets)
                sizes, ends = np.diff(offsets), offsets[1:] - offsets[0]
                flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind)
                for dim in np.unique(sizes):
                    at = np.flatnonzero(sizes == dim)
                    x = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                    yield _entered(x, *(batch[c].to_numpy()[at] for c in ("id", "tag", "weight")))

    def _entered(x, ids, tags, weights) -> pa.RecordBatch:
        n, dim = x.shape
        own = buckets(dim, parts, last, tables, seed)
        keys = own.entries(_unit(x.astype(np.float64))).reshape(n, -1)
        who = np.repeat(np.arange(n), keys.shape[1])
        raw, step = x.tobytes(), dim * x.itemsize
        blobs = [raw[i * step : (i + 1) * step] for i in range(n)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(who), dim, np.int64)),
                pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int64), parts + 1), n)),
                pa.array(keys.ravel()),
                pa.array(ids[who]),
                pa.array(tags[who]),
                pa.array(weights[who]),
                pa.array(blobs, pa.binary()).take(pa.array(who)),
            ],
            names=["dim", "t", "bucket", "id", "tag", "weight", "blob"],
        )

    entries = classes.mapInArrow(
        enter, "dim long, t long, bucket long, id long, tag long, weight long, blob binary"
    )
    bucket_key = ["dim", "t", "bucket"]
    counts = entries.groupBy(*bucket_key).agg(F.count("id").alias("n")).filter("n > 1")
    dealt = (
        attach(entries, counts, bucket_key, weight="n", spread_by=["id", "tag"])
        .filter("n > 1")
        .withColumn("cuts", F.ceil(F.col("n") / BLOCK))
        .withColumn("part", F.pmod(F.xxhash64("id", "tag"), F.col("cuts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
        .withColumn("i", F.least("part", "other").cast("long"))
        .withColumn("j", F.greatest("part", "other").cast("long"))
        .select(*bucket_key, "i", "j", F.col("part").cast("long").alias("part"), "id", "tag", "weight", "blob")
    )
    keys = [*bucket_key, "i", "j"]

    def compare(batches):
        for table, starts in whole_groups(batches, keys, CHUNK):
            dims = table["dim"].to_numpy()[starts]
            for dim in np.unique(dims):  # sorted by it, so these groups are one stretch
                own = starts[dims == dim]
                after = starts[dims > dim]
                end = int(after[0]) if len(after) else len(table)
                found = _met(table.slice(int(own[0]), end - int(own[0])), own - own[0], int(dim))
                if found is not None:
                    yield found

    def _met(table: pa.Table, starts: np.ndarray, dim: int):
        t, bucket, i, j, part, ids, tags, weights = (
            table[c].to_numpy() for c in ("t", "bucket", "i", "j", "part", "id", "tag", "weight")
        )
        unit = _unit(_matrix(table["blob"], kind))
        x, y = _alike(unit, starts, part, i == j, threshold)
        if not len(x):
            return None
        own = buckets(dim, parts, last, tables, seed)
        first = _first_meeting(x, y, unit, own, t, bucket)
        x, y = x[first], y[first]
        if not len(x):
            return None
        linked = np.zeros(len(ids), np.int64)
        np.add.at(linked, x, weights[y])
        np.add.at(linked, y, weights[x])
        some = np.flatnonzero(linked)
        nodes, roots = _forest(x, y, len(ids))
        at = np.concatenate([some, nodes]), np.concatenate([some, roots])
        n = np.concatenate([linked[some], np.zeros(len(nodes), np.int64)])
        columns = (ids[at[0]], tags[at[0]], ids[at[1]], tags[at[1]], n)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["a", "a_tag", "b", "b_tag", "n"]
        )

    met = staged(
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(compare, "a long, a_tag long, b long, b_tag long, n long")
    )
    sums = (
        met.filter("n > 0")
        .groupBy(F.col("a").alias("id"), F.col("a_tag").alias("tag"))
        .agg(F.sum("n").alias("others"))
    )
    # The smallest node of a component has its smallest id.
    stars = met.filter("n = 0").select(F.struct("a", "a_tag").alias("u"), F.struct("b", "b_tag").alias("v"))
    comps = connected_components(
        stars.select(F.col("u").cast(_NODE).alias("u"), F.col("v").cast(_NODE).alias("v")), "u", "v"
    ).select("node.id", "node.tag", F.col("component.id").alias("component"))
    labels = (
        classes.join(sums, ["id", "tag"], "left")
        .join(comps, ["id", "tag"], "left")
        .select(
            "vector",
            "copies",
            (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    # A vector that many rows share is spread; rows that link with nothing join nothing.
    linked = attach(usable_rows, labels, ["vector"], weight="copies", spread_by=["id"], max_hot_keys=1000)
    return linked.select(
        F.col("id").alias("vec_id"),
        F.col("n_links").cast("long").alias("n_links"),
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    ).union(
        rows.filter(~usable).select(
            F.col("id"), F.lit(0).cast("long"), F.col("id"), F.lit(True)
        )
    )
