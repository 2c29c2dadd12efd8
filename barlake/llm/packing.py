"""Operator 13: sequences of tokens filled with lexical neighbours.

Every document's ids and the end id are cut freely: whole windows of a long
document are sequences of their own, what is left of it (or a short document)
is an item. Items are dealt into shards of ``SHARD`` items that share their
most telling tokens, and each shard holds an inverted index over the items'
tokens with BM25 weights; document frequencies and lengths are those of the
whole corpus. A seed takes its unused neighbours in falling order of score
until its window is full; the last one is cut at the window's end and its
rest is the next seed. What a task has left at its end is cut into sequences
whose lengths are powers of two, which need no padding: no token is padded.

Terms are token ids, so the table of document frequencies is as long as the
vocabulary and no longer: the only thing that every task is given.

Shards are ranges of (most telling token, second, hash): a token that a third
of all items share is spread over as many shards as it fills. Each item is in
exactly one shard, and only its shard's items are its possible neighbours.

Defined cases: a null or empty text is the end id alone; rows that repeat are
packed each; null doc_ids are kept; other columns are not read; an empty table
gives no rows. Ties in the score go to the item that is first in its shard.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import words, workers
from barlake.llm.idfiles import library

SHARD = 1024  # items of a shard
K1, B = 1.2, 0.75  # BM25
ROWS = 1 << 11  # items worked on at once

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
_ITEM = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, ids binary"


def _kind(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def item_batches(batches, path: str, end_id: int, window: int, kind: str):
    """(doc_id, text) as whole windows (with sequence_id, without ids) and items (with ids, without sequence_id)."""
    from pyspark import TaskContext
    lib = library(path)
    end = np.array([end_id], dtype="<u4")
    sequence = (1 << 62) + (TaskContext.get().partitionId() << 36)
    for batch in batches:
        ids, at = lib.pieces.encode_column(batch.column(1))
        out: list[list] = [[] for _ in range(7)]
        for doc_id, a, b in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
            doc = np.concatenate([ids[a:b], end])
            for start in range(0, len(doc), window):
                part = doc[start:start + window]
                full = len(part) == window
                row = (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(doc),
                       sequence if full else None, None if full else part.astype(kind).tobytes())
                sequence += full
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        for i in range(0, len(out[0]), ROWS):
            types = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c[i:i + ROWS], t) for c, t in zip(out, types, strict=True)],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "ids"])


def _terms(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (item, token) pairs of binary id columns in order, how often each occurs, and the items' lengths."""
    each = [np.frombuffer(x, dtype=kind) for x in column.to_pylist()]
    size = np.fromiter(map(len, each), np.int64, len(each))
    ids = np.concatenate(each).astype(np.int64) if each else np.zeros(0, np.int64)
    code = np.sort(np.repeat(np.arange(len(each)) << 32, size) | ids)
    at = np.flatnonzero(np.concatenate([code[:1] == code[:1], code[1:] != code[:-1]]))
    return code[at] >> 32, code[at] & 0xFFFFFFFF, np.diff(np.append(at, len(code))), size


def slices(batches):
    """Batches in slices of ``ROWS`` items."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def frequency_batches(batches, kind: str, size: int):
    """Items' ids as (token, items that hold it); token -1 stands for (items, their tokens)."""
    held, items, tokens = np.zeros(size, dtype=np.int64), 0, 0
    for batch in slices(batches):
        _, token, _, n = _terms(batch.column(0), kind)
        held += np.bincount(token, minlength=size)
        items, tokens = items + len(n), tokens + int(n.sum())
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(held[at], [items, tokens]))], ["token", "n"])


def telling_batches(batches, kind: str, idf: np.ndarray):
    """Items with their two tokens of greatest tf * idf and a hash, by which they are dealt into shards."""
    for batch in slices(batches):
        item, token, tf, size = _terms(batch.column(batch.schema.names.index("ids")), kind)
        weight = tf * idf[token]
        order = np.lexsort((token, -weight, item))
        first = np.searchsorted(item, np.arange(len(size)))  # every item has its end id
        best = token[order[first]]
        two = np.searchsorted(item, np.arange(len(size)), "right") - first > 1
        second = np.where(two, token[order[np.minimum(first + 1, len(order) - 1)]], -1)
        crc = batch.column(batch.schema.names.index("ids_crc32")).to_numpy().astype(np.uint64)
        doc = batch.column(batch.schema.names.index("doc_id")).fill_null(-1).to_numpy().astype(np.int64).view(np.uint64)
        mixed = words.mix(crc + words.mix(doc)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(best, pa.int32()), pa.array(second, pa.int32()), pa.array(mixed), *batch.columns],
                                         ["best", "second", "mixed", *batch.schema.names])


class Shard:
    """An inverted index over the items of a shard: for each token its items and their BM25 weights.

    Tokens that more than an eighth of the items hold are kept as dense rows.
    """

    def __init__(self, ids: pa.Array, kind: str, idf: np.ndarray, mean: float):
        item, token, tf, size = _terms(ids, kind)
        weight = (idf[token] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[item] / mean))).astype(np.float32)
        order = np.argsort(token, kind="stable")
        self.items, self.weights = item[order], weight[order]
        self.tokens, self.begin = np.unique(token[order], return_index=True)
        self.count = np.diff(np.append(self.begin, len(order)))
        row = np.searchsorted(self.tokens, token)
        self.first = np.append(np.searchsorted(item, np.arange(len(size))), len(item))
        self.rows, self.n = row, len(size)
        common = np.flatnonzero(self.count * 8 > self.n)
        self.dense_row = np.full(len(self.tokens), -1)
        self.dense_row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), self.n), dtype=np.float32)
        held = self.dense_row[row[order]]
        self.dense[held[held >= 0], self.items[held >= 0]] = self.weights[held >= 0]

    def scores(self, item: int) -> np.ndarray:
        """BM25 of every item of the shard for the tokens of one of them."""
        rows = self.rows[self.first[item]:self.first[item + 1]]
        dense = self.dense_row[rows]
        common = self.dense[dense[dense >= 0]].sum(axis=0)
        rows = rows[dense < 0]
        n = self.count[rows]
        at = np.repeat(self.begin[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return common + np.bincount(self.items[at], weights=self.weights[at], minlength=self.n)


class Packer:
    """Fills windows one after the other and gives their pieces."""

    def __init__(self, window: int, first: int):
        self.window, self.sequence, self.filled = window, first, 0
        self.pieces: list[tuple] = []  # (doc_id, start, ids, doc_tokens) of the open window
        self.out: list[tuple] = []

    def put(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int):
        """Take a piece; what of it passes the window's end is returned as the next seed's beginning."""
        room = self.window - self.filled
        self.pieces.append((doc_id, start, ids[:room], doc_tokens))
        self.filled += min(room, len(ids))
        if self.filled == self.window:
            self.close(self.window)
        return (doc_id, start + room, ids[room:], doc_tokens) if len(ids) > room else None

    def close(self, size: int) -> None:
        """Give the first ``size`` ids of the open window as one sequence."""
        at, rest = 0, []
        for doc_id, start, ids, doc_tokens in self.pieces:
            part = ids[:max(size - at, 0)]
            if len(part):
                self.out.append((doc_id, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), doc_tokens, self.sequence, at))
                at += len(part)
            if len(part) < len(ids):
                rest.append((doc_id, start + len(part), ids[len(part):], doc_tokens))
        self.pieces, self.filled, self.sequence = rest, self.filled - size, self.sequence + 1

    def finish(self) -> None:
        """Cut what is left into sequences of powers of two, the longest first."""
        while self.filled:
            self.close(1 << (self.filled.bit_length() - 1))

    def batch(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def fill(packer: Packer, shard: pa.RecordBatch, kind: str, idf: np.ndarray, mean: float) -> None:
    """Pack all items of a shard: seeds in order, each followed by its unused neighbours, best first."""
    names = shard.schema.names
    index = Shard(shard.column(names.index("ids")), kind, idf, mean)
    ids = [np.frombuffer(x, dtype=kind) for x in shard.column(names.index("ids")).to_pylist()]
    docs, starts, sizes = (shard.column(names.index(c)).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
    used = np.zeros(index.n, dtype=bool)
    seed = 0
    for _ in range(index.n):
        while seed < index.n and used[seed]:
            seed += 1
        if seed == index.n:
            break
        item, used[seed] = seed, True
        rest = packer.put(docs[item], starts[item], ids[item], sizes[item])
        while rest is not None or packer.filled:  # a window that the last item's rest begins keeps that item as its seed
            if rest is not None:
                packer.put(*rest)
                rest = None
                if not packer.filled:
                    break
            free = np.flatnonzero(~used)
            if not len(free):
                return
            score = index.scores(item)[free]
            few = min(len(free), 32)
            near = np.argpartition(-score, few - 1)[:few] if few < len(free) else np.arange(few)
            near = near[np.lexsort((near, -score[near]))]
            for other in free[near].tolist():
                used[other] = True
                rest = packer.put(docs[other], starts[other], ids[other], sizes[other])
                if rest is not None or not packer.filled:  # the window is full
                    item = other
                    break


def pack_batches(batches, kind: str, idf: np.ndarray, mean: float, window: int, shard: int):
    """Items in the order of their shards as pieces of sequences."""
    from pyspark import TaskContext
    packer = Packer(window, TaskContext.get().partitionId() << 36)
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += len(batch)
        while n >= shard:
            table = pa.Table.from_batches(waiting).combine_chunks()
            fill(packer, table.slice(0, shard).combine_chunks().to_batches()[0], kind, idf, mean)
            yield packer.batch()
            waiting, n = table.slice(shard).to_batches(), n - shard
    if n:
        fill(packer, pa.Table.from_batches(waiting).combine_chunks().to_batches()[0], kind, idf, mean)
    packer.finish()
    yield packer.batch()


def packed(df: DataFrame, path: str, end_id: int = 1, window: int = 2048, shard: int | None = None,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids from ``start`` on, ``length`` of them, stand in sequence
    ``sequence_id`` from ``offset`` on.
    """
    spark = df.sparkSession
    tok = library(path).tok
    size = max([*tok.get_vocab(with_added_tokens=True).values(), end_id]) + 1
    kind = _kind(size)
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    cut = workers.keep(rows.mapInArrow(workers.task(__name__, "item_batches", path=path, end_id=end_id, window=window,
                                                     kind=kind), _ITEM), "items")
    items = cut.where(F.col("ids").isNotNull())
    counts = items.select("ids").mapInArrow(workers.task(__name__, "frequency_batches", kind=kind, size=size), "token long, n long") \
        .groupBy("token").agg(F.sum("n").alias("n")).collect()  # one row for each token of the vocabulary at most
    held = {r.token: r.n for r in counts}
    n = held.pop(-1, 0)
    mean = max(held.pop(-2, 0) / n, 1.0) if n else 1.0
    df_of = np.zeros(size)
    df_of[list(held)] = list(held.values())
    idf = np.log1p((n - df_of + 0.5) / (df_of + 0.5))
    telling = items.drop("sequence_id").mapInArrow(
        workers.task(__name__, "telling_batches", kind=kind, idf=idf),
        "best int, second int, mixed long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")
    order = ["best", "second", "mixed", "doc_id"]
    dealt = telling.repartitionByRange(workers.tasks_for(spark), *order).sortWithinPartitions(*order)
    pieces = dealt.mapInArrow(workers.task(__name__, "pack_batches", kind=kind, idf=idf, mean=mean, window=window,
                                           shard=shard or SHARD), _PIECE)
    whole = cut.where(F.col("ids").isNull()).drop("ids").withColumn("offset", F.lit(0).cast("long"))
    return pieces.unionByName(whole)
