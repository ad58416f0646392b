"""Whitening against numpy on whole tables, and on awkward rows."""

import math

import numpy as np
import pytest

from paytide.llm.frames import importable, staged
from paytide.llm.whitening import whitened

KINDS = "vec_id long, embedding array<double>, component string, n long"


def table(spark, vectors, ids=None):
    importable(spark)
    ids = range(len(vectors)) if ids is None else ids
    return staged(spark.createDataFrame([(i, v, "x", 3) for i, v in zip(ids, vectors, strict=True)], KINDS))


def expected(vectors):
    """Grid vectors, their fit's n, sums, eigenvalues and trace, with whole numbers."""
    grid = [tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(grid))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in fit])
    return grid, n, sums, centred


@pytest.mark.parametrize("band", [6, 1024])
def test_equals_numpy(spark, band, monkeypatch):
    monkeypatch.setattr("paytide.llm.whitening.BLOCK_VALUES", 24 * 7)  # several blocks and bands
    draw = np.random.default_rng(3)
    vectors = (draw.normal(size=(90, 24)) @ np.diag(np.linspace(3, 0.3, 24))).tolist()
    vectors += vectors[:9] + [vectors[0]] * 30  # copies count once in the fit
    got = whitened(table(spark, vectors), band=band).toPandas()
    grid, n, sums, centred = expected(vectors)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(got) == len(vectors) * 16 and set(got.n) == {n}
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for i, x in enumerate(grid)}
    assert all(deviation[i] == d for i, d in zip(got.vec_id, got.deviation, strict=True))
    at = np.array([[(n * c - s) / n for c, s in zip(x, sums, strict=True)] for x in grid])
    for k, own in got.groupby("component"):
        want = at @ axes[:, k - 1] / math.sqrt(values[k - 1])
        have = own.sort_values("vec_id").whitened.to_numpy()
        sign = np.sign(want[0] * have[0])
        assert np.abs(have - sign * want).max() < 1e-9
        assert np.abs(own.explained - values[k - 1] / values.sum()).max() < 1e-12
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


def test_awkward_vectors(spark):
    good = [[float(i % 3), float(i % 4), 1.0] for i in range(12)]
    odd = [None, [], [None, 1.0, 2.0], [float("nan")] * 3, [float("inf"), 0.0, 0.0], [1.0, 2.0], [1e300, 0.0, 0.0]]
    ids = [*range(11), None, *range(50, 50 + len(odd))]
    got = whitened(table(spark, good + odd, ids)).toPandas()
    assert set(got.component) == {1, 2}  # the third dimension is constant
    assert sorted(got.vec_id.dropna().unique()) == list(range(11)) and got.vec_id.isna().sum() == 2
    assert list(got.columns) == "vec_id component n deviation whitened explained identity_error".split()


def test_nothing_to_whiten(spark):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3):
        assert whitened(table(spark, vectors)).count() == 0


def test_wide_numbers_stay_exact(spark):
    vectors = [[i * 3e6, 0.5 * i] for i in range(5)]  # squares close to the end of a long
    got = whitened(table(spark, vectors)).toPandas()
    grid, n, sums, _ = expected(vectors)
    for i, x in enumerate(grid):
        assert set(got[got.vec_id == i].deviation) == {sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))}
