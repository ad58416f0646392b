"""Near-duplicate documents by MinHash: banding, verification, connected components.

1. One pass over the texts makes a fingerprint of the word sequence, the number of
   distinct shingles and `hashes` universal hash minima. Texts of equal word sequences
   form one class and only the classes go on, under keys of their own; ids come back last.
2. Classes that agree on all minima of a band share a bucket. The shingle sets of all that
   share one are drawn from the texts once.
3. Every member of a bucket is compared with the bucket's smallest member; found links are
   joined to components.
4. Members of a bucket that are still in different components are compared in blocks, so
   no pair that shares a bucket is left out unless it is connected already. A block passes
   on a spanning forest of its links: its output grows with its members, not their pairs.
Comparing is two-fold: the signatures must agree well enough, then the full shingle sets
decide. A pair at the threshold shares no bucket with probability
(1 - 0.75**rows)**bands, 5e-6 at the defaults.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytide.llm.components import connected_components
from paytide.llm.frames import arrow_groups, narrowed, staged
from paytide.llm.text import row_slices, shingles, utf8, words

SLICE_BYTES = 2 << 20
#: Members of a bucket that one part holds; partners of a document that one group holds.
PART = 512
PARTNERS = 64


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes and sorted distinct shingle hashes of every text."""
    data, offsets = utf8(column)
    for lo, hi in row_slices(offsets, SLICE_BYTES):
        at = offsets[lo : hi + 1]
        hashes, _, _, rows = words(data[at[0] : at[-1]], at - at[0])
        for a, b in zip(rows[:-1], rows[1:], strict=True):
            found = shingles(hashes[a:b], size)
            found.sort()
            if len(found):
                found = found[np.concatenate([[True], found[1:] != found[:-1]])]
            yield hashes[a:b], found


class Minima:
    """Minima of `n` universal hashes a*x + b over 32 bits of each shingle."""

    STEP = 1024

    def __init__(self, n: int, seed: int):
        draw = np.random.default_rng(seed)
        self.a = draw.integers(0, 2**32, (n, 1), dtype=np.uint32) | np.uint32(1)
        self.b = draw.integers(0, 2**32, (n, 1), dtype=np.uint32)
        self.work = np.empty((n, self.STEP), np.uint32)

    def of(self, found: np.ndarray) -> np.ndarray:
        x = (found >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), self.STEP):
            part = x[i : i + self.STEP]
            values = self.work[:, : len(part)]
            np.multiply(self.a, part, out=values)
            values += self.b
            np.minimum(low, values.min(axis=1), out=low)
        return low


def sketches(docs: DataFrame, size: int, hashes: int, seed: int) -> DataFrame:
    """`(id, print, n_shingles, signature)` per row; no print where there are no words."""

    def run(batches):
        minima = Minima(hashes, seed)
        draw = _fingerprint_keys(seed)
        for batch in batches:
            prints, counts, signatures = [], [], []
            for sequence, found in shingle_sets(batch["text"], size):
                counts.append(len(found))
                if not len(found):
                    prints.append(None)
                    signatures.append(None)
                    continue
                prints.append(_fingerprint(sequence, draw))
                signatures.append(minima.of(found).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(prints, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["id", "print", "n_shingles", "signature"],
            )

    return docs.mapInArrow(run, "id long, print binary, n_shingles long, signature binary")


def _fingerprint_keys(seed: int) -> np.ndarray:
    return np.random.default_rng(seed + 1).integers(0, 2**64, 2, dtype=np.uint64) | np.uint64(1)


def _fingerprint(sequence: np.ndarray, keys: np.ndarray) -> bytes:
    """128 bits of a word sequence."""
    place = np.arange(1, len(sequence) + 1, dtype=np.uint64)
    out = [len(sequence).to_bytes(4, "little")]
    for key in keys:
        mixed = (sequence ^ (place * key)) * np.uint64(0x9FB21C651E98DF25)
        mixed ^= mixed >> np.uint64(32)
        out.append(int((mixed * key).sum(dtype=np.uint64)).to_bytes(8, "little"))
    return b"".join(out)


def _stars(classes: DataFrame, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """Members of the buckets of two and more, and the pairs with the smallest member."""
    width = 4 * rows
    keys = F.expr(
        f"transform(sequence(0, {bands - 1}),"
        f" i -> xxhash64(i, substring(signature, i * {width} + 1, {width})))"
    )
    entries = classes.select("id", F.explode(keys).alias("bucket"))
    heads = staged(
        entries.groupBy("bucket")
        .agg(F.min("id").alias("head"), F.max("id").alias("top"), F.count("id").alias("n"))
        .filter("head < top")
        .select("bucket", "head", "n")
    )
    members = staged(entries.join(heads, "bucket").select("bucket", "id", "head", "n"))
    pairs = (
        members.filter("id != head")
        .groupBy(F.col("head").alias("a"), F.col("id").alias("b"))
        .agg(F.lit(1).alias("one"))
        .select("a", "b")
    )
    return members, pairs


def _alike(pairs: DataFrame, classes: DataFrame, hashes: int, floor: float) -> DataFrame:
    """Pairs whose signatures agree on `floor` of the minima and whose sizes allow it."""
    side = classes.select("id", "signature", "n_shingles")
    both = pairs.join(
        side.select(F.col("id").alias("a"), F.col("signature").alias("sa"), F.col("n_shingles").alias("na")), "a"
    ).join(
        side.select(F.col("id").alias("b"), F.col("signature").alias("sb"), F.col("n_shingles").alias("nb")), "b"
    )

    def run(batches):
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            sa, sb = (
                np.frombuffer(b"".join(batch[c].to_pylist()), np.uint32).reshape(n, hashes)
                for c in ("sa", "sb")
            )
            agree = (sa == sb).sum(axis=1) >= floor * hashes
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(
                pa.array(agree)
            )

    return both.mapInArrow(run, "a long, b long")


def class_sets(classes: DataFrame, wanted: DataFrame, docs: DataFrame, size: int, seed: int) -> DataFrame:
    """`(id, found)`: the sorted shingle hashes of the wanted classes, 8 bytes each.

    A class is read from the row of its document whose word sequence has its fingerprint:
    rows that repeat a document id may hold other texts.
    """
    asked = classes.join(wanted, "id", "left_semi").select("id", "doc", "print")
    rows = docs.withColumnRenamed("id", "doc").join(asked, "doc").select("id", "print", "text")

    def run(batches):
        keys = _fingerprint_keys(seed)
        for batch in batches:
            kept, found = [], []
            for i, (sequence, own) in enumerate(shingle_sets(batch["text"], size)):
                if len(own) and _fingerprint(sequence, keys) == batch["print"][i].as_py():
                    kept.append(i)
                    found.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["id"].take(pa.array(kept, pa.int64())), pa.array(found, pa.binary())], names=["id", "found"]
            )

    # Rows of one class are equal, so any of them will do.
    return rows.mapInArrow(run, "id long, found binary").dropDuplicates(["id"])


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * common >= percent * union; both sorted and distinct."""
    least, most = min(len(a), len(b)), max(len(a), len(b))
    if 100 * least < percent * most:
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _cross_links(
    members: DataFrame, found: DataFrame, classes: DataFrame, sets: DataFrame, hashes: int, floor: float, percent: int
) -> DataFrame:
    """Links of a bucket between different components, other than those with its head, as
    far as a spanning forest of them goes.

    Buckets are cut into parts of about `PART` members and every two parts meet in one
    group, so a huge bucket is spread over many groups of bounded size.
    """
    placed = (
        members.join(found.select(F.col("node").alias("id"), "component"), "id", "left")
        .filter("n > 2")
        .withColumn("component", F.coalesce("component", "id"))
    )
    placed = staged(placed)
    mixed = staged(
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("bucket")
    )
    parts = F.ceil(F.col("n") / PART).cast("long")
    open_members = (
        placed.filter("id != head")
        .join(mixed, "bucket")
        .join(classes.select("id", "signature"), "id")
        .join(sets, "id")
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
        .select(
            "bucket",
            "id",
            "component",
            "signature",
            "found",
            "part",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"),
        )
        .select(
            "bucket",
            F.least("part", "other").alias("i"),
            F.greatest("part", "other").alias("j"),
            "part",
            "id",
            "component",
            "signature",
            "found",
        )
    )
    keys = ["bucket", "i", "j"]

    def block(table: pa.Table) -> tuple[list[int], list[int]]:
        ids = table["id"].to_numpy()
        comps = pd.factorize(table["component"].to_numpy())[0]
        part = table["part"].to_numpy()
        sig = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(-1, hashes)
        own = [np.frombuffer(x, np.uint64) for x in table["found"].to_pylist()]
        first = part == part.min()
        left = np.flatnonzero(first)
        right = np.flatnonzero(~first) if not first.all() else left
        if table["i"][0].as_py() != table["j"][0].as_py() and first.all():
            left = left[:0]  # the other part is empty; this part meets itself elsewhere
        a, b = [], []
        for x in left.tolist():
            ys = right[comps[right] != comps[x]]
            ys = ys[(sig[ys] == sig[x]).sum(axis=1) >= floor * hashes]
            for y in ys.tolist():
                # A link joins two components for the rest of the block.
                if comps[y] != comps[x] and linked(own[x], own[y], percent):
                    a.append(int(ids[x]))
                    b.append(int(ids[y]))
                    comps[comps == comps[y]] = comps[x]
        return a, b

    def run(batches):
        for group in arrow_groups(batches, keys):
            if len(group) < 2:
                continue
            a, b = block(group)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return open_members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs `(a, b)` whose full shingle sets have 100 * common >= percent * union.

    A class with many partners is dealt out in groups of about `PARTNERS`. Within a task the
    rows come sorted by group, the group's own set first, and pass one by one: one set and
    the current batch are all that is held.
    """
    group = F.pmod(F.xxhash64("b"), F.col("spread"))
    degrees = staged(pairs.groupBy("a").agg(F.count("b").alias("n")))
    dealt = staged(
        pairs.join(degrees, "a")
        .withColumn("spread", F.ceil(F.col("n") / PARTNERS))
        .select("a", "b", group.cast("long").alias("g"))
    )
    needed = dealt.select(F.col("b").alias("id"), "a", "g", F.lit(1).alias("role")).union(
        dealt.select(F.col("a").alias("id"), "a", "g", F.lit(0).alias("role")).distinct()
    )
    rows = needed.join(sets, "id").select("a", "g", "role", F.col("id").alias("b"), "found")

    def run(batches):
        key, own = None, None
        for batch in batches:
            a, g, role, b = (batch[c].to_pylist() for c in ("a", "g", "role", "b"))
            keep: list[bool] = []
            for i, raw in enumerate(batch["found"]):
                found = np.frombuffer(raw.as_py(), np.uint64)
                if role[i] == 0:
                    key, own = (a[i], g[i]), found
                    keep.append(False)
                    continue
                assert key == (a[i], g[i]), "a group's own set comes first"
                keep.append(linked(own, found, percent))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_())
            )

    return (
        rows.repartition("a", "g")
        .sortWithinPartitions("a", "g", "role")
        .mapInArrow(run, "a long, b long")
    )


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 75,
    bands: int = 32,
    rows: int = 4,
    seed: int = 11,
) -> DataFrame:
    """`(doc_id, n_shingles, component_id, kept)`, one row per input row.

    A-Z is lower-cased, words are runs of bytes other than white space, a document's set
    is its distinct runs of `size` words (all words as one run where there are fewer).
    Documents without words (null, empty, blank) have an empty set, no link and are kept.
    Ids are integers; rows with a null id take no part in linking and come back with a
    null component and kept true. Rows that repeat an id are told by their texts: equal
    texts share a result, and each of different texts is linked by itself. Components are
    numbered by their smallest id, whose rows are kept. Long texts are read whole; an empty
    table gives an empty table; further columns of `df` are not read. The intermediate
    tables are written to the shared folder.
    """
    hashes = bands * rows
    # Five standard deviations of the share of minima on which a pair at the threshold agrees.
    share = percent / 100
    floor = max(0.0, share - 5 * (share * (1 - share) / hashes) ** 0.5)
    docs = narrowed(df, id=id_col, text=text_col)
    docs = docs.withColumn("id", F.col("id").cast("long"))
    drawn = staged(sketches(docs, size, hashes, seed))

    # A class has a key of its own: an id may name several texts.
    classes = staged(
        drawn.filter("id IS NOT NULL AND n_shingles > 0")
        .groupBy("print")
        .agg(
            F.min("id").alias("doc"),
            F.min_by("signature", "id").alias("signature"),
            F.max("n_shingles").alias("n_shingles"),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )
    members, stars = _stars(classes, bands, rows)
    sets = staged(class_sets(classes, members.select("id").distinct(), docs, size, seed))
    stars = staged(_alike(stars, classes, hashes, floor))
    links = staged(confirmed(stars, sets, percent))
    found = staged(connected_components(links, "a", "b"))
    more = staged(_cross_links(members, found, classes, sets, hashes, floor, percent))
    found = staged(connected_components(links.union(more), "a", "b"))

    # From keys to ids: the smallest of a component.
    keyed = classes.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "print", "doc", F.coalesce("component", "id").alias("component")
    )
    least = keyed.groupBy("component").agg(F.min("doc").alias("least"))
    labels = staged(keyed.join(least, "component").select("print", F.col("least").alias("component")))
    return (
        drawn.select("id", "print", "n_shingles")
        .join(labels, "print", "left")
        .select(
            F.col("id").alias("doc_id"),
            "n_shingles",
            F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
