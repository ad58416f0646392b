"""Benchmark leaks by latent semantic retrieval, confirmed by common subsequences.

1. Document frequencies of hashed words are counted over all documents.
2. A distributed randomised SVD of the items' TF-IDF matrix (a word's presence counts)
   gives the latent space that the items are indexed in.
3. A stretch of `2 * size + 32` words is where an item of `size` words is looked for, so a
   copy may have as many words put between its own. Windows overlap so far that each such
   stretch of a document lies in one of them. A window is folded into the latent space and
   multiplied with all items of its class of lengths. The product, and the lengths of what
   the space leaves out of both, bound the weight that they share. Where at least `cover`
   of an item's words are in a window, that weight is at least what the item keeps when it
   loses its heaviest words: a pair below is surely no leak, any other is a candidate.
4. A candidate is a leak if the longest common subsequence of the item and the words of the
   window covers enough of the item, and of its answer where a column gives one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytide.llm.frames import narrowed, staged
from paytide.llm.text import row_slices, utf8, words

SLICE_BYTES = 2 << 20
_BITS = 18
_SHIFT = np.uint64(64 - _BITS)

#: An item of `size` words is looked for in stretches of SPREAD * size + SLACK words.
SPREAD, SLACK = 2, 32

#: Items of at most this many words share windows; longer ones by doubling.
SHORT = 32

#: Words gathered in one go when windows are folded.
_GATHER = 1 << 14


def _texts(column: pa.Array):
    """Word hashes of every text."""
    data, offsets = utf8(column)
    for lo, hi in row_slices(offsets, SLICE_BYTES):
        at = offsets[lo : hi + 1]
        hashes, _, _, rows = words(data[at[0] : at[-1]], at - at[0])
        for a, b in zip(rows[:-1], rows[1:], strict=True):
            yield hashes[a:b]


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Documents, and documents per hash bucket. Both are counted over all rows; what the
    driver gets is one number per bucket, 2**18 of them whatever the corpus."""

    def run(batches):
        counts, docs = np.zeros(1 << _BITS, np.int64), 0
        for batch in batches:
            for found in _texts(batch["text"]):
                counts[np.unique((found >> _SHIFT).astype(np.int64))] += 1
                docs += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(counts[at], docs))], names=["bucket", "n"]
        )

    rows = (
        docs.select("text")
        .mapInArrow(run, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    found = dict(zip(rows["bucket"], rows["n"], strict=True))
    out = np.zeros(1 << _BITS, np.int64)
    total = int(found.pop(-1, 0))
    out[list(found)] = list(found.values())
    return total, out


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over `a`."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        both = row & places.get(x, 0)
        row = ((row + both) | (row - both)) & full
    return len(a) - row.bit_count()


class Group:
    """Items of about one length: their windows, and what a window must share with them."""

    def __init__(self, chosen: list[int], longest: int):
        self.chosen = np.array(chosen, np.int64)
        self.step = longest
        self.window = SPREAD * longest + SLACK + self.step


class Index:
    """A block of benchmark items in the latent space."""

    def __init__(self, items: list[tuple], idf: np.ndarray, cover: float):
        self.ids = [i for i, _, _ in items]
        self.words = [w for _, w, _ in items]
        # An answer without words asks for nothing.
        self.answers = [a for _, _, a in items]
        # Presence, not counts: a repeated word weighs once.
        self.present = [np.unique((w >> _SHIFT).astype(np.int64)) for w in self.words]
        every = np.concatenate(self.present) if items else np.zeros(0, np.int64)
        self.vocabulary = np.unique(every)
        self.places = np.full(1 << _BITS, -1, np.int32)
        self.places[self.vocabulary] = np.arange(len(self.vocabulary))
        self.idf = idf[self.vocabulary]
        self.least_words = np.array([math.ceil(cover * len(w) - 1e-9) for w in self.words], np.int64)
        # What an item weighs less its heaviest words, as many as a leak may lack.
        self.least = np.zeros(len(items))
        for k, p in enumerate(self.present):
            weight = np.sort(idf[p] ** 2)
            lacking = len(self.words[k]) - self.least_words[k]
            self.least[k] = weight[: max(0, len(weight) - lacking)].sum()
        lengths: dict[int, list[int]] = {}
        for k, w in enumerate(self.words):
            lengths.setdefault(max(SHORT, 1 << (len(w) - 1).bit_length()), []).append(k)
        self.groups = [Group(k, max(len(self.words[i]) for i in k)) for _, k in sorted(lengths.items())]
        for group in self.groups:
            # The share of what an item needs that a word can give, of any item.
            group.most = np.zeros(max(1, len(self.vocabulary)))
            for k in group.chosen:
                need = max(self.least[k], 1e-12)
                at = self.places[self.present[k]]
                np.maximum.at(group.most, at, self.idf[at] ** 2 / need)

    def matrix_rows(self) -> list[tuple[bytes, bytes]]:
        """TF-IDF rows over the vocabulary: columns and values."""
        out = []
        for p in self.present:
            column = self.places[p]
            values = self.idf[column]
            out.append((column.astype(np.int32).tobytes(), values.astype(np.float64).tobytes()))
        return out

    def fold(self, basis: np.ndarray) -> None:
        """Project words and items on an orthonormal basis of the vocabulary."""
        rows = basis * self.idf[:, None]
        latent = np.stack([rows[self.places[p]].sum(axis=0) for p in self.present])
        whole = np.array([(self.idf[self.places[p]] ** 2).sum() for p in self.present])
        # Lengths of what the space leaves out of the items.
        self.outside = np.sqrt(np.maximum(0, whole - (latent * latent).sum(axis=1)))
        self.rows, self.latent = rows.astype(np.float32), latent.astype(np.float32)
        self.counts = []
        for w in self.words:  # how many of an item's words a word of the vocabulary stands for
            at, n = np.unique(self.places[(w >> _SHIFT).astype(np.int64)], return_counts=True)
            self.counts.append((at, n))


def randomised_svd(rows: DataFrame, width: int, rank: int, seed: int, rounds: int = 2) -> np.ndarray:
    """An orthonormal basis of the leading right singular vectors, `width` x `rank`.

    `rows` holds sparse rows (`columns`, `values` as bytes). Each round multiplies by the
    matrix and its transpose in the tasks; a task passes on one `width` x `rank` sum.
    """
    context = rows.sparkSession.sparkContext
    draw = np.random.default_rng(seed)
    basis = np.linalg.qr(draw.normal(size=(width, min(width, rank))))[0]
    for _ in range(rounds):
        shared = context.broadcast(basis)

        def multiply(batches, shared=shared):
            q = shared.value
            total = np.zeros_like(q)
            for batch in batches:
                for c, v in zip(batch["columns"].to_pylist(), batch["values"].to_pylist(), strict=True):
                    at, x = np.frombuffer(c, np.int32), np.frombuffer(v, np.float64)
                    total[at] += np.outer(x, x @ q[at])
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sum"])

        parts = rows.mapInArrow(multiply, "sum binary").toLocalIterator()
        total = np.zeros_like(basis)
        for part in parts:
            total += np.frombuffer(part["sum"], np.float64).reshape(basis.shape)
        basis = np.linalg.qr(total)[0]
        shared.unpersist()
    return basis


def _indexes(items: DataFrame, idf: np.ndarray, cover: float, block_bytes: int, rank: int, seed: int):
    """One index per block of benchmark text of about `block_bytes`."""
    spark = items.sparkSession
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    for b in range(blocks):
        chosen = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        table = chosen.orderBy("id", "text").toArrow()
        answers = list(_texts(table["answer"]))
        found = [
            (i, w, a)
            for i, w, a in zip(table["id"].to_pylist(), _texts(table["text"]), answers, strict=True)
            if len(w)
        ]
        index = Index(found, idf, cover)
        if not found:
            continue
        rows = staged(
            spark.createDataFrame(index.matrix_rows(), "columns binary, values binary").repartition(2)
        )
        index.fold(randomised_svd(rows, len(index.vocabulary), rank, seed))
        yield index


def _candidates(place: np.ndarray, index: Index, group: Group):
    """(start, end, items) of the windows of a text that may hold leaks, in order."""
    n = len(place)
    at = np.flatnonzero(place >= 0)  # words of no item share nothing
    if not len(at):
        return
    known = place[at]
    order = np.argsort(known, kind="stable")
    before = np.full(len(at), -1, np.int64)  # where the same word was last
    same = known[order[1:]] == known[order[:-1]]
    before[order[1:][same]] = at[order[:-1][same]]
    starts = np.arange(0, max(1, n - group.window + group.step), group.step)
    ends = np.minimum(starts + group.window, n)
    lo, hi = np.searchsorted(at, starts), np.searchsorted(at, ends)
    bound = np.concatenate([[0.0], np.cumsum(group.most[known])])
    some = np.flatnonzero((bound[hi] - bound[lo] >= 1 - 1e-6) & (hi > lo))
    many = max(1, _GATHER // group.window)
    for k in range(0, len(some), many):
        part = some[k : k + many]
        sizes = hi[part] - lo[part]
        first = np.cumsum(sizes) - sizes
        inner = np.arange(sizes.sum()) + np.repeat(lo[part] - first, sizes)
        fresh = before[inner] < np.repeat(starts[part], sizes)  # a repeat adds nothing
        # The first known word of a window is fresh, so no window is without one.
        inner, begins = inner[fresh], np.cumsum(fresh)[first] - 1
        words = known[inner]
        weight = np.add.reduceat(group.most[words], begins)
        good = np.flatnonzero(weight >= 1 - 1e-6)
        if not len(good):
            continue
        stops = np.append(begins[1:], len(words))
        texts = [words[begins[g] : stops[g]] for g in good]
        latent = np.stack([index.rows[w].sum(axis=0) for w in texts])
        whole = np.array([(index.idf[w] ** 2).sum() for w in texts])
        outside = np.sqrt(np.maximum(0, whole - (latent * latent).sum(axis=1)))
        chosen = group.chosen
        product = latent @ index.latent[chosen].T + outside[:, None] * index.outside[chosen][None]
        slack = 1e-3 * (1 + index.least[chosen])  # single precision
        for g, found in zip(good, product >= (index.least[chosen] - slack)[None], strict=True):
            if found.any():
                w = part[g]
                yield int(starts[w]), int(ends[w]), chosen[found]


def _leaks(found: np.ndarray, index: Index, answer_cover: float):
    """Leaks of one text: (item, common words, cover)."""
    if not len(found):
        return
    place = index.places[(found >> _SHIFT).astype(np.int64)]
    held = np.zeros(len(index.vocabulary), bool)
    for group in index.groups:
        best: dict[int, int] = {}
        for s, e, items in _candidates(place, index, group):
            inside = place[s:e]
            inside = inside[inside >= 0]
            held[inside] = True
            for item in items.tolist():
                at, n = index.counts[item]
                if best.get(item) == len(index.words[item]) or n[held[at]].sum() < index.least_words[item]:
                    continue  # too few of its words are there, in whatever order
                common = common_subsequence(index.words[item], found[s:e])
                if common < index.least_words[item] or common <= best.get(item, 0):
                    continue
                answer = index.answers[item]
                if common_subsequence(answer, found[s:e]) >= answer_cover * len(answer):
                    best[item] = common
            held[inside] = False
        for item, common in sorted(best.items()):
            yield item, common, common / len(index.words[item])


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    cover: float = 0.7,
    answer_cover: float = 0.5,
    rank: int = 256,
    block_bytes: int = 1 << 20,
    seed: int = 13,
) -> DataFrame:
    """`(doc_id, item_id, common_words, overlap)`: one row per document and leaked item.

    Words are runs of other bytes than white space with A-Z lower-cased. Null, empty and
    blank texts hold no leak and items without words leak nowhere; an empty table gives no
    rows; repeated rows are reported each. A document leaks an item of `size` words if the
    longest common subsequence of the item and a stretch of `2 * size + 32` words holds
    `cover` of the item's words; windows are longer than that, by up to three times the size
    of the longest item of its class, and wider copies in them are reported too. `overlap` is
    the share of the item's words in the longest common subsequence of any window. With
    `answer_col` the text must also cover `answer_cover` of that answer's words; without it
    `cover` decides alone, so a copy that lost its end is a leak like any other. Documents are only read, never shuffled; a benchmark of more than
    `block_bytes` is taken in blocks, one pass each, so what is sent to the tasks is
    bounded. Other columns are not read.
    """
    docs = narrowed(df, doc_id=id_col, text=text_col)
    columns = {"id": item_col, "text": item_text_col}
    if answer_col is not None:
        columns["answer"] = answer_col
    items = narrowed(benchmark, **columns)
    if answer_col is None:
        items = items.withColumn("answer", F.lit(""))
    total, frequency = document_frequencies(docs)
    idf = np.log((1 + total) / (1 + frequency)) + 0.1

    kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema["id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, common_words int, overlap double"
    context = df.sparkSession.sparkContext
    out = None
    for index in _indexes(items, idf, cover, block_bytes, rank, seed):
        shared = context.broadcast(index)

        def search(batches, shared=shared):
            index = shared.value
            for batch in batches:
                rows: list[tuple] = []
                where: list[int] = []
                for i, found in enumerate(_texts(batch["text"])):
                    for item, common, covered in _leaks(found, index, answer_cover):
                        where.append(i)
                        rows.append((index.ids[item], common, covered))
                columns = list(zip(*rows, strict=True)) if rows else [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].take(pa.array(where, pa.int64())),
                        pa.array(columns[0], pa.int64() if item_kind == "bigint" else None),
                        pa.array(columns[1], pa.int32()),
                        pa.array(columns[2], pa.float64()),
                    ],
                    names=["doc_id", "item_id", "common_words", "overlap"],
                )

        part = docs.mapInArrow(search, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else df.sparkSession.createDataFrame([], schema)
