"""Operator 2: approximate nearest neighbours by multiprobe p-stable hashing.

``TABLES`` tables hash a vector by ``k`` Gaussian projections cut into slots of
width w. For a neighbour at distance d each projection moves by a normal of
deviation d, which gives every slot of every coordinate a probability; a query
visits cells in falling order of their product until the mass visited reaches
p. The candidates of all tables are merged and ranked by exact distance.

Fitting: k, w, d and p come from at most ``SAMPLE`` vectors (least hash of the
id): p is the least mass that finds ``GOAL`` of the sample's own nearest
neighbours. Neighbours in the whole table are nearer than in the sample, so
recall is higher there. Every vector is indexed.

Scale: equal vectors are one class (its least ids stand for it), so copies
neither fill a cell nor multiply pairs. Cells are laid out by a range sort on
(table, cell, id) and cut into blocks of vectors, so a crowded cell spreads over
tasks; query blocks meet vector blocks of the same cell in a join that Spark can
split, and a pair of blocks gives each query's best few only. A query that
finds too few rows is compared with all vectors, block by block.

Defined cases: vectors that are null, empty, all zero, hold a null or a
component that is not finite, or differ in length from most take no part;
repeated rows count once; ties go to the smaller id; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm import words, workers

TABLES = 6
SAMPLE = 4096
TRIED = 48  # sample vectors used as queries when fitting
GOAL = 0.98
MOST_CELLS = 150  # cells a table may cost a query on average; else fewer projections are used
BLOCK, QUERIES = 256, 64  # vectors and queries of a block
EDGE = 1e-9
MERGED = 500_000  # rows of a task's buffer of results


class Index:
    """Projections and probing parameters; a few kB whatever the number of vectors."""

    def __init__(self, dims: int, k: int, width: float, near: float, mass: float, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.a = rng.normal(size=(TABLES, dims, k))
        self.b = rng.uniform(0, width, (TABLES, 1, k))
        self.dims, self.k, self.width, self.near, self.mass = dims, k, width, max(near, 1e-12), mass
        self.mixer = rng.integers(1, 1 << 63, k, dtype=np.uint64) | np.uint64(1)

    def slots(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Slot numbers, and places within the slot, of each vector."""
        z = x @ self.a[t] + self.b[t]
        slot = np.floor(z / self.width)
        return slot.astype(np.int64), z - slot * self.width

    def cells(self, slots: np.ndarray) -> np.ndarray:
        """A 64-bit key of each row of slot numbers."""
        return words.mix((slots.view(np.uint64) * self.mixer).sum(axis=-1, dtype=np.uint64)).view(np.int64)

    def visits(self, place: np.ndarray, most: int | None = None):
        """(shift of slots, mass visited before) in falling order of probability, up to the mass."""
        w, d, per = self.width, self.near * math.sqrt(2), []
        reach = range(-int(4 * self.near / w) - 1, int(4 * self.near / w) + 2)
        for x in place.tolist():
            odds = [(math.erf((w * (s + 1) - x) / d) - math.erf((w * s - x) / d), s) for s in reach]
            per.append(sorted((-math.log(o / 2), abs(s), s) for o, s in odds if o > 1e-7))
        heap, done, n = [(sum(p[0][0] for p in per), (0,) * self.k, 0)], 0.0, 0
        while heap and done < self.mass and (most is None or n < most):
            cost, at, last = heapq.heappop(heap)
            yield [per[i][j][2] for i, j in enumerate(at)], done
            done += math.exp(-cost)
            n += 1
            # each combination has one parent: only coordinates from the last raised one on are raised
            for i in range(last, self.k):
                if at[i] + 1 < len(per[i]):
                    heapq.heappush(heap, (cost + per[i][at[i] + 1][0] - per[i][at[i]][0], (*at[:i], at[i] + 1, *at[i + 1:]), i))


def fit(sample: np.ndarray, total: int, top: int = 10) -> Index:
    """Parameters for ``total`` vectors from a sample of them."""
    n, dims = sample.shape
    asked = sample[:TRIED]
    d2 = (asked ** 2).sum(1)[:, None] + (sample ** 2).sum(1) - 2 * asked @ sample.T
    d2[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    top = min(top, n - 1)
    if top < 1:
        return Index(dims, 1, 1.0, 1.0, 1.0)
    nearest = np.argsort(d2, axis=1)[:, :top]
    near = math.sqrt(max(0.0, float(np.median(np.take_along_axis(d2, nearest, 1)[:, -1]))))
    width = 2.5 * max(float(np.sqrt(((sample - sample.mean(0)) ** 2).sum(1).mean())), near, 1e-12)
    k = max(2, round(0.8 * math.log2(max(total, 200) / 50)))
    while True:
        index = Index(dims, k, width, near, 0.995)
        when = np.full(nearest.shape, np.inf)
        cells_at = []
        for t in range(TABLES):
            slots, place = index.slots(sample, t)
            cells = index.cells(slots)
            for q in range(len(asked)):
                shifts, mass = zip(*index.visits(place[q], 8 * MOST_CELLS), strict=True)
                keys = index.cells(slots[q] + np.array(shifts))
                first = dict(zip(keys[::-1].tolist(), mass[::-1], strict=True))
                when[q] = np.minimum(when[q], [first.get(int(cells[v]), np.inf) for v in nearest[q]])
                cells_at.append(mass)
        need = np.sort(when.ravel())[min(when.size - 1, math.ceil(GOAL * when.size) - 1)]
        mass = min(0.995, float(need) + 1e-6)
        cost = np.mean([np.searchsorted(m, mass) for m in cells_at]) if np.isfinite(need) else np.inf
        if cost <= MOST_CELLS or k == 1:
            return Index(dims, k, width, near, mass)
        k = max(1, k - max(1, k // 5))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, dims)


def bytes_batches(batches, dims: int):
    """The first columns as they are, and the vector in the last as bytes."""
    for batch in batches:
        flat = batch.columns[-1].flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(-1, dims)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([r.tobytes() for r in flat], pa.binary())],
                                         [*batch.schema.names[:-1], "vec"])


def cell_batches(batches, index, probe: bool):
    """(id, vec) rows as (tab, cell, id, vec): the own cell in each table or, to probe, every visited cell."""
    m = index.value
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch.column(1), m.dims)
        for t in range(TABLES):
            slots, place = m.slots(x, t)
            if probe:
                shifts = [np.array([s for s, _ in m.visits(p)]) for p in place]
                row = np.repeat(np.arange(len(x)), [len(s) for s in shifts])
                cells = m.cells(slots[row] + np.concatenate(shifts))
            else:
                row, cells = np.arange(len(x)), m.cells(slots)
            for a in range(0, len(row), 5000):
                r = pa.array(row[a:a + 5000])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), t, np.int32)), pa.array(cells[a:a + 5000]),
                                                  batch.column(0).take(r), batch.column(1).take(r)], ["tab", "cell", "id", "vec"])


def block_batches(batches, size: int):
    """Rows sorted by (tab, cell) as blocks of at most ``size`` ids and vectors of one cell."""
    names, rest = ["tab", "cell", "ids", "vecs"], None
    for batch in batches:
        rest = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        out, rest = _blocks(rest.combine_chunks(), size, False)
        if out:
            yield pa.RecordBatch.from_arrays(out, names)
    if rest is not None and rest.num_rows:
        out, _ = _blocks(rest, size, True)
        yield pa.RecordBatch.from_arrays(out, names)


def _blocks(rows: pa.Table, size: int, last: bool):
    if not rows.num_rows:
        return None, rows
    tab, cell = rows["tab"].to_numpy(), rows["cell"].to_numpy()
    new = np.flatnonzero(np.concatenate([[True], (tab[1:] != tab[:-1]) | (cell[1:] != cell[:-1])]))
    cuts = np.concatenate([np.arange(a, b, size) for a, b in zip(new, np.append(new[1:], len(tab)), strict=True)])
    cuts = np.append(cuts, len(tab)) if last else cuts  # the last block may go on in the next batch
    if len(cuts) < 2:
        return None, rows
    ids, vecs = rows["id"].to_numpy(), rows["vec"].to_pylist()
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    out = [pa.array(tab[cuts[:-1]]), pa.array(cell[cuts[:-1]]),
           pa.array([ids[a:b].astype("<i8").tobytes() for a, b in spans], pa.binary()),
           pa.array([b"".join(vecs[a:b]) for a, b in spans], pa.binary())]
    return out, rows.slice(int(cuts[-1]))


def _best(q: np.ndarray, v: np.ndarray, score: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest ``top`` rows of each query, a row found twice counted once."""
    order = np.lexsort((v, score, q))
    q, v, score = q[order], v[order], score[order]
    if len(q):
        new = np.concatenate([[True], (q[1:] != q[:-1]) | (v[1:] != v[:-1]) | (score[1:] != score[:-1])])
        q, v, score = q[new], v[new], score[new]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < top
    return q[keep], v[keep], score[keep]


def rank_batches(batches, dims: int, top: int):
    """Pairs of blocks (qids, qvecs, ids, vecs) as each query's nearest classes: (query, id, score).

    What a task finds for a query is merged before it leaves the task, in a
    buffer of ``MERGED`` rows.
    """
    names = ["query", "id", "score"]
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    for batch in batches:
        found = []
        for qids, qvecs, ids, vecs in zip(*batch.columns, strict=True):
            qi, vi = np.frombuffer(qids.as_py(), "<i8"), np.frombuffer(ids.as_py(), "<i8")
            q, v = np.frombuffer(qvecs.as_py(), "<f8").reshape(-1, dims), np.frombuffer(vecs.as_py(), "<f8").reshape(-1, dims)
            norm = (q ** 2).sum(1)[:, None] + (v ** 2).sum(1)
            rough = norm - 2 * q @ v.T
            if len(vi) > top:  # rounding may move a distance by EDGE of the norms at most
                limit = np.partition(rough, top - 1, axis=1)[:, top - 1:top]
                rows, cols = np.nonzero(rough <= limit + EDGE * norm)
            else:
                rows, cols = np.nonzero(rough == rough)
            found.append((qi[rows], vi[cols], np.sqrt(((q[rows] - v[cols]) ** 2).sum(1))))
        if found:
            held = _best(*(np.concatenate(x) for x in zip(held, *found, strict=True)), top)
        if len(held[0]) > MERGED:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names)
            held = tuple(x[:0] for x in held)
    if len(held[0]):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names)


def _first(df: DataFrame, by: list, order: list, n: int) -> DataFrame:
    return df.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("nth") <= n)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, e array<double>, h1, h2): the rows that take part; h1 and h2 tell different vectors apart."""
    e = F.col(f"`{embedding}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), e.alias("e")).filter(
        "vec_id is not null and size(e) > 0 and forall(e, x -> coalesce(abs(x) < double('infinity'), false)) and exists(e, x -> x <> 0)")
    rows = rows.withColumn("e", F.transform("e", lambda x: x + F.lit(0.0)))  # one zero
    sizes = rows.groupBy(F.size("e").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("e") == (sizes["n"] if sizes else 0)) \
        .select("vec_id", "e", F.xxhash64("e").alias("h1"), F.xxhash64(F.lit(7), "e").alias("h2"))


def nearest(vectors: DataFrame, is_query, top: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows found for each row for which ``is_query(vec_id)`` holds."""
    spark = vectors.sparkSession
    parts, sc = workers.tasks_for(spark), spark.sparkContext
    rows = usable(vectors, vec_id, embedding)
    marks = workers.keep(rows.select("vec_id", "h1", "h2").distinct(), "marks")
    # a class's least ids: one more than asked for, as the query itself may be among them
    members = workers.keep(_first(marks, ["h1", "h2"], ["vec_id"], top + 1)
                           .withColumn("id", F.min("vec_id").over(Window.partitionBy("h1", "h2"))), "members")
    heads = members.filter("nth = 1").select("vec_id", "h1", "h2")
    classes = rows.join(heads, ["vec_id", "h1", "h2"]).dropDuplicates(["vec_id", "h1", "h2"])
    first = classes.select("e").limit(1).collect()
    if not first:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = len(first[0][0])
    classes = workers.keep(classes.select("h1", "h2", F.col("vec_id").alias("id"), "e").mapInArrow(
        workers.task(__name__, "bytes_batches", dims=dims), "h1 long, h2 long, id long, vec binary"), "vectors")
    picked = classes.orderBy(F.xxhash64("id", "h1"), "id").limit(SAMPLE).select("vec").collect()
    total = classes.count()
    index = sc.broadcast(fit(np.stack([np.frombuffer(r[0], "<f8") for r in picked]), total, top))

    asked = workers.keep(marks.filter(is_query(F.col("vec_id"))), "queries")
    q = classes.join(asked.select("h1", "h2").distinct(), ["h1", "h2"]).select("id", "vec")

    def blocks(df, size, probe):
        cells = df.mapInArrow(workers.task(__name__, "cell_batches", index=index, probe=probe), "tab int, cell long, id long, vec binary")
        laid = cells.repartitionByRange(parts, "tab", "cell", "id").sortWithinPartitions("tab", "cell", "id")
        return laid.mapInArrow(workers.task(__name__, "block_batches", size=size), "tab int, cell long, ids binary, vecs binary")

    def ranked(pairs):
        best = pairs.mapInArrow(workers.task(__name__, "rank_batches", dims=dims, top=top + 1), "query long, id long, score double")
        return _first(best.groupBy("query", "id").agg(F.min("score").alias("score")), ["query"], ["score", "id"], top + 1).drop("nth")

    mine = blocks(q, QUERIES, True).select("tab", "cell", F.col("ids").alias("qids"), F.col("vecs").alias("qvecs"))
    index_blocks = workers.keep(blocks(classes.select("id", "vec"), BLOCK, False), "blocks")
    found = workers.keep(ranked(mine.join(index_blocks, ["tab", "cell"]).select("qids", "qvecs", "ids", "vecs")), "found")

    # rows behind the classes found, and the queries that found too few of them
    sizes = members.groupBy("id").agg(F.count("*").alias("n"))
    heard = found.join(sizes, "id").groupBy("query").agg(F.sum("n").alias("rows"))
    enough = min(top + 1, marks.select("vec_id").distinct().count()) if total <= top + 1 else top + 1
    few = q.join(heard, q.id == heard["query"], "left").filter(F.coalesce("rows", F.lit(0)) < enough).select("id", "vec")
    if not few.isEmpty():
        # one-row query blocks, each sent to every part of the vectors
        alone = few.select(F.lit(0).alias("tab"), F.col("id").alias("cell"), "id", "vec").mapInArrow(
            workers.task(__name__, "block_batches", size=1), "tab int, cell long, ids binary, vecs binary")
        each = alone.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                            F.col("ids").alias("qids"), F.col("vecs").alias("qvecs"))
        scan = index_blocks.filter("tab = 0").withColumn("part", F.pmod(F.xxhash64("cell", "ids"), F.lit(parts)).cast("int"))
        again = each.join(scan, "part").select("qids", "qvecs", "ids", "vecs")
        whole = workers.keep(ranked(again), "whole")
        found = found.join(whole.select("query").distinct(), "query", "left_anti").unionByName(whole)
    workers.drop(index_blocks)

    names = classes.select("id", "h1", "h2")
    askers = asked.join(names, ["h1", "h2"]).select(F.col("vec_id").alias("query_id"), F.col("id").alias("query"))
    all_rows = askers.join(found, "query").join(members.select("id", "vec_id"), "id").filter("vec_id <> query_id")
    once = all_rows.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return _first(once, ["query_id"], ["score", "vec_id"], top).select("query_id", F.col("nth").alias("rank"), "vec_id", "score")
