from collections import Counter, defaultdict
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from barlake.llm import whitening

VECS = "vec_id long, embedding array<float>, label int, id string, x string, `index` int, `a.b` int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "x", 2, 3) for i, v in rows], VECS).repartition(3)


def usable(rows):
    rows = [(i, v) for i, v in rows if v and all(c is not None and isfinite(c) for c in v)]
    if not rows:
        return []
    d = max(Counter(len(v) for _, v in rows).items(), key=lambda x: (x[1], x[0]))[0]
    return [(i, tuple(floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows if len(v) == d]


def check(got, rows, top):
    """Every value against whole numbers and numpy; signs are free, but one a component."""
    rows = usable(rows)
    fit = sorted({x for _, x in rows})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    centred = {x: np.array([float(Fraction(n * x[j] - s[j], n)) for j in range(d)]) for x in fit}
    c = np.array([centred[x] for x in fit])
    cov = c.T @ c / n
    value = np.linalg.eigvalsh(cov)[::-1]
    assert len(got) == len(rows) * min(top, d)
    by_row = defaultdict(dict)
    for r in got:
        by_row[r.vec_id, r.deviation].setdefault(r.component, []).append(r)
        assert r.n == n
    for key, count in Counter((i, sum((n * x[j] - s[j]) ** 2 for j in range(d))) for i, x in rows).items():
        assert {k: len(v) for k, v in by_row[key].items()} == dict.fromkeys(range(1, min(top, d) + 1), count)
    for k in range(1, min(top, d) + 1):
        mine = [r for r in got if r.component == k]
        assert len({r.explained for r in mine}) == 1 and len({r.identity_error for r in got}) == 1
        assert mine[0].explained == pytest.approx(max(value[k - 1], 0) / value.sum(), rel=1e-4, abs=1e-12)
        if value[k - 1] < 1e-10 * value[0]:
            assert all(r.whitened is None for r in mine)
            continue
        # distances along an eigenvector: the projection is known up to its sign if eigenvalues differ
        axis = np.linalg.eigh(cov)[1][:, ::-1][:, k - 1]
        want = {(i, sum((n * x[j] - s[j]) ** 2 for j in range(d))): float(centred[x] @ axis) / value[k - 1] ** 0.5 for i, x in rows}
        sign = 1 if sum(r.whitened * want[r.vec_id, r.deviation] for r in mine) > 0 else -1
        for r in mine:
            assert r.whitened * sign == pytest.approx(want[r.vec_id, r.deviation], abs=1e-7)
    assert got[0].identity_error is not None and got[0].identity_error < 1e-8


def sample(n, d, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, d)) @ np.diag(np.linspace(3, 0.3, d)) + rng.normal(size=d)
    return [(i, [float(c) for c in row]) for i, row in enumerate(v.astype(np.float32))]


def test_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ENTRIES", 640)  # many blocks
    monkeypatch.setattr(whitening, "TOGETHER", 2)
    rows = sample(700, 20)
    check(whitening.whitened(vectors(spark, rows), top=16).collect(), rows, 16)


def test_awkward_rows(spark):
    rows = sample(60, 5)
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(7, rows[7][1]), (None, rows[8][1]), (None, sample(1, 5, 9)[0][1])]
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [float("nan")] * 5), (204, [1.0, float("inf"), 0.0, 0.0, 0.0]),
             (205, [1.0, 2.0]), (206, [0.0] * 5)]
    check(whitening.whitened(vectors(spark, rows)).collect(), rows, 16)


def test_flat_dimensions_single_vectors_and_empty_tables(spark):
    flat = [(i, [*v, 0.25, v[0]]) for i, v in sample(50, 3)]
    check(whitening.whitened(vectors(spark, flat), top=4).collect(), flat, 4)
    one = whitening.whitened(vectors(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])).collect()
    assert sorted(map(tuple, one)) == [(i, k, 1, 0, None, None, None) for i in (1, 2) for k in (1, 2)]
    for rows in ([], [(1, None), (2, [])]):
        none = whitening.whitened(vectors(spark, rows))
        assert none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and none.count() == 0


def test_huge_entries_do_not_stop_the_job(spark):
    rows = [*sample(20, 3), (99, [3e38, -3e38, 0.0]), (98, [1e15, 0.0, 0.0])]
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert len(got) == 66 and any(r.deviation is None for r in got if r.vec_id == 99)
