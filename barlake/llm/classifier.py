"""Operator 9: a factorisation machine as quality classifier.

Inputs of a score come from the text alone: its words, hashed into ``DIMS``
columns and scaled to unit length, and statistics of its structure and of the
text's own metadata (length, shares of character kinds, repeated words and
lines). The machine adds to a linear model one low-rank vector per column, and
scores all pairs of columns in linear time by
sum over f of ((sum v x)^2 - sum v^2 x^2) / 2.

Training: at most ``MAX_ROWS`` labelled rows (those with the least hash of
doc_id, so the same rows every time) are turned into columns by the executors
and fitted on the driver: AdaGrad on the logistic loss. The model's size is
fixed by ``DIMS`` and ``RANK``; it is broadcast for scoring, which goes over
whole texts in one pass without a shuffle.

Defined cases: null and empty texts are scored as a text without words;
without any labelled row, or with one class only, the score is that class's
smoothed share; labels that are null are left out; a doc_id labelled twice
counts twice; other columns are carried along whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import words, workers

BITS = 16
DIMS = 1 << BITS
RANK = 6
MAX_ROWS = 8_000  # labelled rows that training takes at most
EPOCHS = 12
SLICE = words.SLICE  # bytes of text worked on at once: a worker's memory is some 25 times this, whatever the batch

KINDS = 9
_KIND = np.full(256, 8, dtype=np.uint8)  # other ASCII
_KIND[ord("a"):ord("z") + 1] = 0
_KIND[ord("A"):ord("Z") + 1] = 1
_KIND[ord("0"):ord("9") + 1] = 2
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[list(b"#*$%&|<>")] = 4
_KIND[list(b"!?")] = 5
_KIND[list(b".,;:'\"-")] = 6
_KIND[128:] = 7
DENSE = KINDS + 7


def _repeats(groups: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """For each group, how many entries equal an earlier one of the group."""
    if not len(keys):
        return np.zeros(n)
    order = np.lexsort((keys, groups))
    g, k = groups[order], keys[order]
    same = np.concatenate([[False], (g[1:] == g[:-1]) & (k[1:] == k[:-1])])
    return np.bincount(g[same], minlength=n).astype(float)


def _kinds(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many bytes of each kind a text has; counted ``SLICE`` bytes at a time, so that a long text costs no more."""
    n = len(offs) - 1
    out = np.zeros(n * KINDS, dtype=np.int64)
    for at in range(0, len(buf), SLICE):
        part = buf[at:at + SLICE]
        a, b = np.searchsorted(offs, [at, at + len(part) - 1], "right") - 1  # the texts of the first and last byte
        row = np.repeat(np.arange(b - a + 1) * KINDS, np.diff(np.clip(offs[a:b + 2], at, at + len(part))))
        out[a * KINDS:(b + 1) * KINDS] += np.bincount(row + _KIND[part], minlength=(b - a + 1) * KINDS)
    return out.reshape(n, KINDS)


def features(column: pa.Array):
    """For pieces of a text column: (hashed column, value, first entry of each row, dense columns)."""
    for a, b in words.pieces(column, SLICE):
        buf, offs = words.text_bytes(column.slice(a, b - a))
        n = b - a
        starts, ends = words.spans(buf, offs)
        ids = words.hashes(buf, starts, ends)
        row = np.searchsorted(offs, starts, "right") - 1
        keys, counts = np.unique((row << BITS) | (ids & np.uint64(DIMS - 1)).astype(np.int64), return_counts=True)
        of, cols = keys >> BITS, keys & (DIMS - 1)
        value = np.log1p(counts)
        norm = np.sqrt(np.bincount(of, value * value, n))
        value = value / norm[of]
        size = np.maximum(np.diff(offs), 1)
        kinds = _kinds(buf, offs)
        n_words = np.bincount(row, minlength=n)
        some = np.maximum(n_words, 1)
        length = ends - starts
        # lines: runs between \n; empty ones do not count
        brk = buf == 10
        line_buf = np.flatnonzero(~brk & np.concatenate([[True], brk[:-1]])) if len(buf) else np.zeros(0, np.int64)
        line_buf = np.union1d(line_buf, offs[:-1][offs[:-1] < len(buf)][~brk[offs[:-1][offs[:-1] < len(buf)]]]) \
            if len(buf) else line_buf
        stops = np.append(np.flatnonzero(brk), len(buf))
        line_row = np.searchsorted(offs, line_buf, "right") - 1
        line_end = np.minimum(stops[np.searchsorted(stops, line_buf)], offs[line_row + 1]) if len(line_buf) else line_buf
        lines = words.hashes(buf, line_buf, line_end, 1)
        n_lines = np.maximum(np.bincount(line_row, minlength=n), 1)
        caps = (buf[starts] >= 65) & (buf[starts] <= 90) & (buf[ends - 1] != 46) & (length > 1) \
            & (buf[np.minimum(starts + 1, ends - 1)] >= 65) & (buf[np.minimum(starts + 1, ends - 1)] <= 90)
        alone = (length == 1) & (_KIND[buf[starts]] >= 4)
        dense = np.concatenate([np.sqrt(kinds / size[:, None]), np.stack([
            np.log1p(n_words), np.bincount(row, length, n) / some, np.bincount(row, caps, n) / some,
            np.sqrt(np.bincount(row, alone, n) / some), _repeats(row, ids, n) / some,
            np.sqrt(_repeats(line_row, lines, n) / n_lines), np.log1p(n_words / n_lines)], axis=1)], axis=1)
        yield cols, value, np.searchsorted(of, np.arange(n + 1)), dense


def _pack(a: np.ndarray, kind: str) -> bytes:
    return a.astype(kind).tobytes()


def feature_batches(batches):
    """(label, text) rows as packed columns."""
    for batch in batches:
        done = 0
        for cols, value, first, dense in features(batch.column(1)):
            n = len(first) - 1
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(done, n),
                pa.array([_pack(cols[first[i]:first[i + 1]], "<u4") for i in range(n)], pa.binary()),
                pa.array([_pack(value[first[i]:first[i + 1]], "<f4") for i in range(n)], pa.binary()),
                pa.array([_pack(dense[i], "<f8") for i in range(n)], pa.binary())], ["label", "cols", "vals", "dense"])
            done += n


class Machine:
    """w0, the linear weights and the low-rank vectors of hashed and dense columns."""

    def __init__(self, dims: int = DIMS, dense: int = DENSE, rank: int = RANK, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.w0 = 0.0
        self.w = np.zeros(dims + dense)
        self.v = rng.normal(0, 0.02, (dims + dense, rank))
        self.mean, self.scale = np.zeros(dense), np.ones(dense)
        self.dims = dims

    def dense(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -4, 4)

    def raw(self, cols, value, first, dense):
        """Scores before the logistic, and what a gradient needs; ``dense`` is scaled already."""
        n = len(first) - 1
        of = np.repeat(np.arange(n), np.diff(first))
        vx = self.v[cols] * value[:, None]
        s = np.stack([np.bincount(of, vx[:, f], n) for f in range(vx.shape[1])], axis=1)
        q = np.bincount(of, (vx * vx).sum(1), n)
        vd = self.v[self.dims:]
        s += dense @ vd
        q += (dense ** 2) @ (vd ** 2).sum(1)
        z = self.w0 + np.bincount(of, self.w[cols] * value, n) + dense @ self.w[self.dims:]
        return z + 0.5 * ((s ** 2).sum(1) - q), s, of

    def score(self, cols, value, first, dense) -> np.ndarray:
        z, _, _ = self.raw(cols, value, first, self.dense(dense))
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(rows, epochs: int = EPOCHS, step: float = 0.1, l2: float = 1e-4, batch: int = 128) -> Machine:
    """Fit on (label, cols, vals, dense) rows; the same rows in the same order give the same machine."""
    m = Machine()
    y = np.array([r[0] for r in rows], dtype=float)
    share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    m.w0 = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        m.v[:] = 0
        return m
    cols = [np.frombuffer(r[1], "<u4").astype(np.int64) for r in rows]
    vals = [np.frombuffer(r[2], "<f4").astype(float) for r in rows]
    dense = np.stack([np.frombuffer(r[3], "<f8") for r in rows])
    m.mean, m.scale = dense.mean(0), dense.std(0) + 1e-3
    dense = m.dense(dense)
    rng = np.random.default_rng(11)
    gw, gv, g0 = np.full(len(m.w), 1e-6), np.full(m.v.shape, 1e-6), 1e-6
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            c = np.concatenate([cols[i] for i in at])
            x = np.concatenate([vals[i] for i in at])
            first = np.concatenate([[0], np.cumsum([len(cols[i]) for i in at])])
            d = dense[at]
            z, s, of = m.raw(c, x, first, d)
            e = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[at]) / len(at)
            g = e.sum()
            g0 += g * g
            m.w0 -= step * g / np.sqrt(g0)
            used, back = np.unique(c, return_inverse=True)
            dw = np.bincount(back, e[of] * x) + l2 * m.w[used]
            v = m.v[c]
            part = (e[of] * x)[:, None] * (s[of] - v * x[:, None])
            dv = np.stack([np.bincount(back, part[:, f]) for f in range(v.shape[1])], axis=1) + l2 * m.v[used]
            vd = m.v[m.dims:]
            dwd = d.T @ e + l2 * m.w[m.dims:]
            dvd = d.T @ (e[:, None] * s) - vd * ((d ** 2).T @ e)[:, None] + l2 * vd
            for at_, a, b in ((used, dw, dv), (slice(m.dims, None), dwd, dvd)):
                gw[at_] += a * a
                m.w[at_] -= step * a / np.sqrt(gw[at_])
                gv[at_] += b * b
                m.v[at_] -= 0.3 * step * b / np.sqrt(gv[at_])
    return m


def held_out(doc_id):
    """Rows that no training sees: CRC-32 of doc_id as text, divisible by 5. A null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Machine:
    """A machine from at most ``max_rows`` labelled rows outside the held-out fold."""
    marked = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("double").alias("label")) \
        .filter("id is not null and label is not null")
    marked = marked.filter(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id", "label").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(marked), "id").select("label", "text", "id")  # at most max_rows short rows
    got = rows.select("label", "text").mapInArrow(workers.task(__name__, "feature_batches"),
                                                  "label double, cols binary, vals binary, dense binary").collect()
    return fit(sorted((tuple(r) for r in got), key=lambda r: (r[3], r[1], r[0])))


def score_batches(batches, model, keep_from=None, text=None):
    """Rows (row, text) as (row, score); with ``keep_from``, only rows whose score reaches it.

    With ``text``, the text is that field of ``row`` and does not come a second time.
    """
    m = model.value
    for batch in batches:
        done = 0
        for cols, value, first, dense in features(batch.column(1) if text is None else batch.column(0).field(text)):
            score = pa.array(m.score(cols, value, first, dense))
            out = pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(score)), score], ["row", "score"])
            done += len(score)
            yield out if keep_from is None else out.filter(pa.compute.greater_equal(score, keep_from))


def scored(docs: DataFrame, machine: Machine, keep_from: float | None = None, columns: list[str] | None = None) -> DataFrame:
    """(row, score) for every row: ``row`` holds the given columns (all, if not given)."""
    import pyspark.sql.types as T
    sc, held = docs.sparkSession.sparkContext, columns or docs.columns
    at = held.index("text") if "text" in held and docs.schema["text"].dataType == T.StringType() else None
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in held]).alias("row"),
                       *([F.col("text").cast("string").alias("text")] if at is None else []))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(workers.task(__name__, "score_batches", model=sc.broadcast(machine), keep_from=keep_from,
                                        text=at), schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""
    good = scored(docs, train(docs, labels), keep_from=threshold)
    return good.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
