"""Document quality by ordinal cumulative-link regression on graded ratings.

One weight per hashed token is shared by all grades, and ordered thresholds part them:
P(grade > j) = sigmoid(weights . tokens - threshold_j). The score of a text gives its
expected grade and the probability of reaching a grade, by which texts are selected.
Tokens are runs of letters, of digits and of other signs, A-Z lower-cased, each counted
once a text; the first bytes of runs of letters, as stems; and the bands of a few
whole-text ratios.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytide.llm.frames import narrowed, staged, without
from paytide.llm.text import LOWER, SPACE, chunk_hashes, mix, row_slices, utf8

SLICE_BYTES = 2 << 20
#: Bits of a token's hash. So many that two tokens of a corpus hardly share a weight.
HASH_BITS = 40

_KIND = np.full(256, 3, np.uint8)
_KIND[SPACE] = 0
_KIND[65:91] = _KIND[97:123] = 1
_KIND[128:] = 1
_KIND[48:58] = 2
_BANDS = 10
#: Stems: so many first bytes of a longer run of letters.
STEMS = (4, 5)


def tokens(column: pa.Array) -> Iterator[np.ndarray]:
    """Distinct token hashes of every text, band features included; empty where no token."""
    data, offsets = utf8(column)
    shift = np.uint64(64 - HASH_BITS)
    for lo, hi in row_slices(offsets, SLICE_BYTES):
        at = offsets[lo : hi + 1]
        part, at = LOWER[data[at[0] : at[-1]]], at - at[0]
        kind = _KIND[part]
        change = np.ones(len(part) + 1, bool)
        change[1:-1] = kind[1:] != kind[:-1]
        change[at] = True
        cuts = np.flatnonzero(change)
        full = kind[cuts[:-1]] > 0
        starts, ends = cuts[:-1][full], cuts[1:][full]
        kinds = kind[starts]
        hashes = chunk_hashes(part, starts, ends)
        stems = []
        for size in STEMS:
            stem = chunk_hashes(part, starts, np.minimum(ends, starts + size))
            long = (kinds == 1) & (ends - starts > size)
            # A short run repeats its own hash and adds nothing.
            stems.append(np.where(long, mix(stem + np.uint64(size)), hashes))
        rows = np.searchsorted(starts, at)
        for a, b in zip(rows[:-1], rows[1:], strict=True):
            own, own_kinds = hashes[a:b], kinds[a:b]
            if not len(own):
                yield np.zeros(0, np.int64)
                continue
            distinct = np.unique(np.concatenate([own, *[stem[a:b] for stem in stems]]))
            letters = own[own_kinds == 1]
            again = (letters[1:] == letters[:-1]).mean() if len(letters) > 1 else 0.0
            ratios = ((own_kinds == 3).mean(), (own_kinds == 2).mean(), again)
            bands = [min(_BANDS - 1, int(r * _BANDS)) + _BANDS * i for i, r in enumerate(ratios)]
            every = np.concatenate([distinct, mix(np.array(bands, np.uint64) + np.uint64(1))])
            yield (every >> shift).astype(np.int64)


class Model:
    """Weights by token hash (sorted) and ordered thresholds."""

    def __init__(self, grades: int):
        self.grades = grades
        self.keys = np.zeros(0, np.int64)
        self.weights = np.zeros(0)
        self.thresholds = np.full(grades - 1, -np.inf)  # untrained: the best grade for all

    def score(self, found: np.ndarray) -> float:
        if not len(self.keys):
            return 0.0
        at = np.searchsorted(self.keys, found)
        at[at == len(self.keys)] = 0
        return float(self.weights[at[self.keys[at] == found]].sum())

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > j) for j = 0 to grades - 2, one row per score."""
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(np.clip(self.thresholds[None] - scores[:, None], -40, 40)))


def train(
    texts: list[np.ndarray],
    grades: np.ndarray,
    levels: int,
    min_docs: int = 4,
    ridge: float = 3e-4,
    steps: int = 250,
) -> Model:
    """Full-batch Adam on the penalised negative log-likelihood; deterministic."""
    model = Model(levels)
    if len(np.unique(grades)) < 2:
        return model
    flat = np.concatenate(texts)
    keys, which, counts = np.unique(flat, return_inverse=True, return_counts=True)
    kept = counts >= min_docs
    place = np.cumsum(kept) - 1
    sizes = np.array([len(t) for t in texts])
    row = np.repeat(np.arange(len(texts)), sizes)[kept[which]]
    col = place[which[kept[which]]]
    n, width = len(texts), int(kept.sum())
    # Grades that were never given keep their place between their neighbours.
    share = np.array([(grades > j).mean() for j in range(levels - 1)]).clip(1 / n, 1 - 1 / n)
    first = -np.log(share / (1 - share))
    first = np.maximum.accumulate(first + 1e-3 * np.arange(levels - 1))
    theta = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    p = np.concatenate([np.zeros(width), theta])
    mean, square = np.zeros_like(p), np.zeros_like(p)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for step in range(1, steps + 1):
        w, raw = p[:width], p[width:]
        cuts = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
        eta = np.bincount(row, w[col], n)
        # P(y = g) = above[g - 1] - above[g], with 1 before the first and 0 after the last.
        above = np.column_stack([np.ones(n), sigmoid(eta[:, None] - cuts[None]), np.zeros(n)])
        at = np.arange(n)
        low, high = above[at, grades], above[at, grades + 1]
        prob = np.maximum(low - high, 1e-12)
        d_low, d_high = low * (1 - low) / prob, high * (1 - high) / prob
        d_eta = -(d_low - d_high) / n
        d_cuts = np.zeros(levels + 1)
        np.add.at(d_cuts, grades, d_low / n)
        np.add.at(d_cuts, grades + 1, -d_high / n)
        d_cuts = d_cuts[1:-1]
        tail = np.cumsum(d_cuts[::-1])[::-1]
        d_raw = np.concatenate([tail[:1], tail[1:] * np.exp(raw[1:])])
        grad = np.concatenate([np.bincount(col, d_eta[row], width) + ridge * w, d_raw])
        mean += 0.1 * (grad - mean)
        square += 0.01 * (grad * grad - square)
        rate = 0.1 * (1 - 0.9 * step / steps)
        p = p - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    model.keys, model.weights = keys[kept], p[:width]
    model.thresholds = np.cumsum(np.concatenate([p[width : width + 1], np.exp(p[width + 1 :])]))
    return model


def fit(
    rated: DataFrame,
    text_col: str = "text",
    grade_col: str = "grade",
    levels: int = 3,
    sample: int = 8192,
    **options,
) -> Model:
    """Fit on rated texts, at most `sample` of them: those with the smallest hash.

    Grades are whole numbers from 0 to `levels` - 1; rows with a null or other grade or a
    null text are left out; equal texts of equal grades count once. With fewer than two
    grades the model gives all texts the best. The driver holds the tokens of the sample only.
    """
    rows = narrowed(rated, text=text_col, grade=grade_col).filter(
        f"text IS NOT NULL AND grade BETWEEN 0 AND {levels - 1}"
    )
    order = F.xxhash64("text")
    # The border of the sample first, so that texts themselves are never sorted or gathered.
    border = rows.select(order.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if border is None:
        return Model(levels)
    chosen = rows.filter(order <= border).select("text", F.col("grade").cast("int").alias("grade"))
    # No more texts than the sample, each with as many grades as there are.
    chosen = chosen.distinct()

    def run(batches):
        for batch in batches:
            found = [t.tobytes() for t in tokens(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), batch["grade"]], names=["tokens", "grade"]
            )

    got = chosen.mapInArrow(run, "tokens binary, grade int").toPandas()
    # An order of its own, whatever the order of the partitions.
    got = got.sort_values(["tokens", "grade"], ignore_index=True)
    texts = [np.frombuffer(t, np.int64) for t in got["tokens"]]
    return train(texts, got["grade"].to_numpy(np.int64), levels, **options)


def scored(
    df: DataFrame,
    model: Model,
    text_col: str = "text",
    at_least: int | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """`df` with `expected_grade` and `tail_probability`, the probability of grade
    `at_least` (the best by default) or more.

    A text without tokens (null, empty, blank) has score 0: the base rates decide. Columns
    of these names are replaced; `columns` are those of `df` to return (all by default), so
    that texts need not come back. Long texts are read whole, in blocks; rows are scored one
    by one, so ties, repeats and other columns do not matter.
    """
    level = model.grades - 1 if at_least is None else at_least
    df = without(df, ["expected_grade", "tail_probability"])
    place = df.columns.index(text_col)
    kept = [df.columns.index(c) for c in columns] if columns is not None else range(len(df.columns))

    def run(batches):
        for batch in batches:
            scores = np.array([model.score(t) for t in tokens(batch.column(place))])
            tails = model.tails(scores) if len(scores) else np.zeros((0, model.grades - 1))
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in kept],
                    pa.array(tails.sum(axis=1)),
                    pa.array(tails[:, level - 1] if level > 0 else np.ones(len(scores))),
                ],
                names=[*[batch.schema.names[i] for i in kept], "expected_grade", "tail_probability"],
            )

    schema = T.StructType(
        [
            *[df.schema.fields[i] for i in kept],
            T.StructField("expected_grade", T.DoubleType()),
            T.StructField("tail_probability", T.DoubleType()),
        ]
    )
    return df.mapInArrow(run, schema)


def graded(documents: DataFrame, labels: DataFrame, sample: int = 8192) -> DataFrame:
    """`(text, grade)` of at most `sample` labelled documents: 0 toxic, 1 poor, 2 good.

    The sample is drawn from the labels alone, those of the smallest hash of the id, and is
    sent to the documents, whose texts are read once and never shuffled. Labels with a null
    are left out; of conflicting labels of an id the lowest grade counts; rows that repeat
    an id come back as often.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), 2
    )
    rated = labels.select("doc_id", grade.alias("grade")).dropna()
    rated = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = staged(rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return staged(texts.select("text", "grade"))
