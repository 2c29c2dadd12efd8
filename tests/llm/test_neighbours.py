import numpy as np
import pyarrow.parquet as pq

from barlake.llm import neighbours
from barlake.llm.queries import op2_neighbours

SCHEMA = "vec_id long, embedding array<float>, id string, vec int, cell int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, query, top):
    """Exact answer over the rows that take part."""
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8}
    out = {}
    for q, x in ok:
        if q % query == 0:
            ds = sorted({(float(np.sqrt(((np.float32(x).astype(float) - np.float32(y).astype(float)) ** 2).sum())), i) for i, y in ok if i != q})
            out[q] = ds[:top]
    return out


def awkward():
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype("f4").tolist()) for i in range(300)]
    same = rows[0][1]
    rows += [(i, same) for i in range(300, 420)]  # copies, some of them queries
    rows += [(1000, None), (1001, []), (1002, [0.0] * 8), (1010, [None] + [1.0] * 7), (1020, [float("nan")] * 8),
             (1030, [float("inf")] * 8), (1040, [1.0] * 3), (None, same), rows[5], rows[5], (1050, [-0.0, *same[1:]])]
    return rows


def test_recall_and_scores(spark):
    rows = awkward()
    got = {}
    for r in neighbours.nearest(frame(spark, rows), lambda i: i % 10 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = brute(rows, 10, 10)
    assert set(got) == set(want)
    hits = 0
    for q, ds in want.items():
        assert len(got[q]) == 10 and got[q] == sorted(got[q])
        hits += len(set(got[q]) & set(ds))
    assert hits / (10 * len(want)) >= 0.9
    copies = got[310]  # ties by id, without itself
    assert copies == [(0.0, i) for i in [0, *range(300, 310)][:10]]


def test_few_rows_give_all_candidates(spark):
    rows = awkward()[:6]
    got = neighbours.nearest(frame(spark, rows), lambda i: i % 5 == 0).orderBy("query_id", "rank").collect()
    assert [[(r.score, r.vec_id) for r in got if r.query_id == q] for q in (0, 5)] == [brute(rows, 5, 10)[q] for q in (0, 5)]
    assert neighbours.nearest(frame(spark, rows[:1]), lambda i: i % 5 == 0).count() == 0
    assert neighbours.nearest(frame(spark, []), lambda i: i % 5 == 0).count() == 0
    assert neighbours.nearest(frame(spark, [(0, None)]), lambda i: i % 5 == 0).count() == 0


def test_queries_that_find_too_few_scan_all(spark):
    far = [(i, [1000.0 * (i + 1) ** 3] + [float(i)] * 7) for i in range(40)]
    got = neighbours.nearest(frame(spark, far), lambda i: i % 10 == 0)
    want = brute(far, 10, 10)
    for q, ds in want.items():
        assert [(r.score, r.vec_id) for r in got.filter(f"query_id = {q}").orderBy("rank").collect()] == ds


def test_recall_on_the_table(spark):
    folder = "/root/testdata/sf0.1"
    t = pq.read_table(f"{folder}/embeddings.parquet").to_pandas()
    ids, x = t.vec_id.to_numpy(), np.array(t.embedding.tolist(), dtype=float)
    got = op2_neighbours(spark, folder).toPandas()
    hits = 0
    for q in ids[ids % 100 == 0]:
        d = ((x - x[ids == q][0]) ** 2).sum(1)
        d[ids == q] = np.inf
        hits += len(set(ids[np.lexsort((ids, d))[:10]]) & set(got[got.query_id == q].vec_id))
    assert hits / len(got) >= 0.9


def test_visits_fall_in_probability_and_reach_the_mass():
    index = neighbours.Index(8, 4, 2.0, 1.0, 0.9)
    shifts, before = zip(*index.visits(np.array([0.1, 1.0, 1.9, 0.5])), strict=True)
    steps = np.diff(before)
    assert (steps[1:] <= steps[:-1] + 1e-12).all() and before[-1] < 0.9
    assert len({tuple(s) for s in shifts}) == len(shifts) and shifts[0] == [0, 0, 0, 0]
