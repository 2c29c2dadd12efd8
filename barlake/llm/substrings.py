"""Operator 3: substring dedup with a compressed FM-index per shard.

A window is ``width`` consecutive words. A word is removed if a window over it
also starts in a document with a smaller doc_id.

Sharding. Texts are not streamed past every shard, which would be quadratic:
shards are formed by content, so that equal windows meet in one. Of the
5-word groups of a window the one with the least hash is its anchor; equal
windows have equal anchors. Neighbouring windows with one anchor form a segment.

1. Anchors that occur in one document only are dropped. Within each piece of a
   task anchors seen in several documents are known at once and only two marks
   of them travel, so a frequent anchor sends a few rows for each piece and its
   group stays small.
2. The segments of the other anchors are cut out; an anchor with more than
   ``FREQUENT`` of them has its segments cut into single windows, routed by the
   window's own hash. Equal segments become one, with the least doc_id.
3. Each shard, a bounded number of segments, builds an FM-index and streams its
   segments through it by backward search. Every match of ``width`` words is an
   interval of suffixes; the least doc_id in it is the window's first document.
4. Segments pass this back to the places where they occur, and documents drop
   the covered words.

Defined cases: null text has no words; rows with a null doc_id are neither
compared nor changed; rows that share a doc_id do not remove each other's
words, whether or not their texts agree; an empty table gives an empty result.
A text of which nothing is removed stays as it is, otherwise it is its kept
words joined by one space, which may be empty; other columns are carried along.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm import words, workers
from barlake.llm.fmindex import FMIndex, window_intervals

WIDTH = 13
ANCHOR = 5
FREQUENT = 1000
LONGEST = 64  # windows of a segment
SHARD = 12_000  # segments of a shard, about


def anchor_batches(batches, width: int):
    """(doc_id, mark, text) rows as segments (route, doc_id, mark, place, known, anchor); place = start * 128 + windows.

    Within a piece, segments whose anchor two documents share are known to be
    shared: they are spread by a hash of their own and two marks (windows = 0)
    tell the anchor's other occurrences.
    """
    names = ["route", "doc_id", "mark", "place", "anchor"]
    grams = min(ANCHOR, width)
    for batch in batches:
        doc_ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for a, b in words.pieces(batch.column(2), words.PIECE):
            buf, offs = words.text_bytes(batch.column(2).slice(a, b - a))
            starts, ends = words.spans(buf, offs)
            n = len(starts) - width + 1
            if n <= 0:
                continue
            row = np.searchsorted(offs, starts, "right") - 1
            first = np.searchsorted(row, np.arange(b - a))  # first word of each text
            gram = words.windows(words.hashes(buf, starts, ends), grams)
            key = gram[:n].copy()
            for i in range(1, width - grams + 1):
                np.minimum(key, gram[i:i + n], out=key)
            at = np.flatnonzero(row[:n] == row[width - 1:])
            if not len(at):
                continue
            key, r = key[at].view(np.int64), row[at]
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (r[1:] != r[:-1])])
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(key)))
            if size.max() > LONGEST:  # a run of one anchor is cut; its windows stay the same
                cut = np.concatenate([np.arange(s, s + m, LONGEST) for s, m in zip(begin, size, strict=True)])
                begin, size = cut, np.diff(np.append(cut, len(key)))
            key, r = key[begin], r[begin]
            doc, mark, place = doc_ids[a + r], marks[a + r], (at[begin] - first[r]) * 128 + size
            order = np.lexsort((doc, key))
            edges = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
            lo, hi = doc[order][edges], doc[order][np.append(edges[1:], len(key)) - 1]
            inverse = np.empty(len(key), dtype=np.int64)
            inverse[order] = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(key))))
            shared = lo < hi
            known = shared[inverse]
            spread = words.mix(doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ place.view(np.uint64)
                               ^ key.view(np.uint64)).view(np.int64)
            told = key[order][edges][shared]
            zero = np.zeros(2 * len(told), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.where(known, spread, key), told, told])),
                pa.array(np.concatenate([doc, lo[shared], hi[shared]])), pa.array(np.concatenate([mark, zero.astype(np.int32)])),
                pa.array(np.concatenate([place, zero])),
                pa.array(np.concatenate([key, zero]), mask=np.concatenate([~known, zero == 0]))], names)


def shared_batches(batches):
    """Rows sorted by route: segments that are known to be shared, or whose route two documents have."""
    rest = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        rest = now if rest is None or not rest.num_rows else pa.concat_tables([rest, now]).combine_chunks()
        route = rest["route"].to_numpy()
        cut = int(np.searchsorted(route, route[-1])) if len(route) else 0
        if cut:
            yield from _shared(rest.slice(0, cut))
            rest = rest.slice(cut)
    if rest is not None and rest.num_rows:
        yield from _shared(rest)


def _shared(rows: pa.Table):
    route, doc, place = (rows[c].to_numpy() for c in ("route", "doc_id", "place"))
    edges = np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]]))
    two = np.minimum.reduceat(doc, edges) < np.maximum.reduceat(doc, edges)
    anchor = rows["anchor"].combine_chunks()
    known = anchor.is_valid().to_numpy(zero_copy_only=False)
    take = (np.repeat(two, np.diff(np.append(edges, len(route)))) | known) & (place > 0)
    key = np.where(known, anchor.fill_null(0).to_numpy(), route)[take]
    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc[take]), pa.array(rows["mark"].to_numpy()[take]),
                                      pa.array(place[take])], ["anchor", "doc_id", "mark", "place"])


def _mark():
    """Tells texts of one doc_id apart."""
    return F.expr("int(shiftright(xxhash64(text), 32))")


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")) \
        .select("doc_id", _mark().alias("mark"), "text")


def shared_segments(rows: DataFrame, width: int) -> DataFrame:
    """(anchor, doc_id, mark, place) of the segments whose anchor occurs in two documents."""
    parts = workers.tasks_for(rows.sparkSession)
    found = rows.filter("doc_id is not null and text is not null").mapInArrow(
        workers.task(__name__, "anchor_batches", width=width), "route long, doc_id long, mark int, place long, anchor long")
    met = found.repartition(parts, "route").sortWithinPartitions("route")
    return met.mapInArrow(workers.task(__name__, "shared_batches"), "anchor long, doc_id long, mark int, place long")


def segment_keys(hashes: list[np.ndarray], begin: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of the words from ``begin`` to ``end``, from the words' own two: a polynomial by prefix sums."""
    out = []
    for which, h in enumerate(hashes):
        up, down = words.powers(which, len(h))
        prefix = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(h * up[:len(h)], out=prefix[1:])
        out.append(words.mix((prefix[end] - prefix[begin]) * down[begin] + (end - begin).astype(np.uint64)).view(np.int64))
    return out


def segment_batches(batches, width: int, content: bool):
    """(doc_id, mark, text, places) rows as segments (route, doc_id, content) or their places (doc_id, mark, start, k1, k2)."""
    for batch in batches:
        for a, b in words.pieces(batch.column(2), words.SLICE):
            part = batch.slice(a, b - a)
            texts = [b" ".join(t.as_py().encode().split()) for t in part.column(2)]
            offs = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
            canon = b" ".join(texts)
            buf = np.frombuffer(canon, dtype=np.uint8)
            starts, ends = words.spans(buf, np.minimum(offs, len(buf)))
            first = np.searchsorted(starts, offs[:-1])
            places = part.column(3)
            place, route, often = (places.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(3))
            row = np.repeat(np.arange(b - a), places.value_lengths().to_numpy())
            place, route, often = place.astype(np.int64), route.astype(np.int64), often.astype(bool)
            begin, size = place >> 7, place & 127
            if often.any():  # frequent anchors: every window by itself
                times = np.where(often, size, 1)
                shift = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                begin, size = np.repeat(begin, times) + np.repeat(often, times) * shift, np.repeat(np.where(often, 1, size), times)
                route, often, row = np.repeat(route, times), np.repeat(often, times), np.repeat(row, times)
            w = first[row] + begin
            if not content or often.any():
                k1, k2 = segment_keys([words.hashes(buf, starts, ends, i) for i in (0, 1)], w, w + size + width - 1)
            doc = part.column(0).take(pa.array(row))
            if content:
                s, e = starts[w], ends[w + size + width - 2]
                parts = [canon[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)]
                if often.any():
                    route = np.where(often, k1, route)
                yield pa.RecordBatch.from_arrays([pa.array(route), doc, pa.array(parts, pa.binary())], ["route", "doc_id", "content"])
            else:
                yield pa.RecordBatch.from_arrays([doc, part.column(1).take(pa.array(row)), pa.array(begin.astype(np.int32)),
                                                  pa.array(k1), pa.array(k2)], ["doc_id", "mark", "start", "k1", "k2"])


def shard_windows(table: pa.Table, width: int) -> pa.Table:
    """One shard: index its segments, stream them through, and give each window's least doc_id."""
    parts = table["content"].combine_chunks()
    buf, offs = words.text_bytes(parts)
    starts, ends = words.spans(buf, offs)
    hashes = [words.hashes(buf, starts, ends, i) for i in (0, 1)]
    symbols = np.unique(hashes[0], return_inverse=True)[1].astype(np.int64) + 1
    lengths = np.bincount(np.searchsorted(offs, starts, "right") - 1, minlength=len(parts))
    index = FMIndex(symbols, lengths, width)
    docs = table["doc_id"].to_numpy()[index.sequence[index.order]]  # of each row of the index
    seq, at, lo, hi = window_intervals(index, symbols, lengths)
    # the intervals of full matches are equal or apart: one reduction over the distinct ones gives the least document
    begin, back = np.unique(lo, return_inverse=True)
    stop = np.zeros(len(begin), dtype=np.int64)
    stop[back] = hi
    cuts = np.stack([begin, stop], axis=1).ravel()
    least = np.minimum.reduceat(np.append(docs, docs[-1]), cuts)[::2][back]
    order = np.lexsort((at, seq))
    counts = np.bincount(seq, minlength=len(parts))
    end = np.cumsum(lengths)
    k1, k2 = segment_keys(hashes, end - lengths, end)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.table({"k1": k1, "k2": k2,
                     "least": pa.ListArray.from_arrays(pa.array(offsets), pa.array(least[order]))})


def distinct_segments(segments: DataFrame) -> DataFrame:
    """(route, content, doc_id): equal segments as one, with their least doc_id."""
    return segments.groupBy("route", "content").agg(F.min("doc_id").alias("doc_id"))


def first_documents(distinct: DataFrame, width: int) -> DataFrame:
    """(k1, k2, least): for each distinct segment the least doc_id of each of its windows."""
    spark = distinct.sparkSession
    shards = max(workers.tasks_for(spark), -(-distinct.count() // SHARD))
    dealt = distinct.select(F.pmod(F.xxhash64("route"), F.lit(shards)).alias("shard"), "content", "doc_id")
    schema = "k1 long, k2 long, least array<long>"
    return dealt.groupBy("shard").applyInArrow(workers.task(__name__, "shard_windows", width=width), schema) \
        .groupBy("k1", "k2").agg(F.first("least").alias("least"))


def _kept_words(text: str, spans, width: int) -> tuple[list[bytes], int]:
    found = text.encode().split()
    if not spans:
        return found, 0
    cover = np.zeros(len(found) + 1, dtype=np.int32)
    at = np.array(spans, dtype=np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    gone = np.cumsum(cover[:-1]) > 0
    return [w for w, g in zip(found, gone.tolist(), strict=True) if not g], int(gone.sum())


def removed_windows(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, mark, starts): where windows start, in words, that a smaller doc_id has too. ``rows`` as by ``_rows``."""
    shared = workers.keep(shared_segments(rows, width), "anchors")
    # written, so that the join below reads a plain table: small enough to broadcast, or a shuffle that Spark can split
    often = workers.keep(shared.groupBy("anchor").count().filter(F.col("count") > FREQUENT)
                         .select("anchor", F.lit(True).alias("often")), "often")
    placed = shared.join(often, "anchor", "left").groupBy("doc_id", "mark").agg(F.collect_list(F.struct(
        "place", "anchor", F.coalesce("often", F.lit(False)).alias("often"))).alias("places"))
    texts = rows.filter("doc_id is not null and text is not null").dropDuplicates(["doc_id", "mark"])
    held = workers.keep(texts.join(placed, ["doc_id", "mark"]).select("doc_id", "mark", "text", "places"), "texts")
    workers.drop(shared, often)
    cut = held.mapInArrow(workers.task(__name__, "segment_batches", width=width, content=True),
                          "route long, doc_id long, content binary")
    distinct = workers.keep(distinct_segments(cut), "segments")
    least = workers.keep(first_documents(distinct, width), "windows")
    workers.drop(distinct)
    where = held.mapInArrow(workers.task(__name__, "segment_batches", width=width, content=False),
                            "doc_id long, mark int, start int, k1 long, k2 long")
    hits = where.join(least, ["k1", "k2"]).select("doc_id", "mark", F.explode(F.filter(F.transform(
        "least", lambda m, i: F.when(m < F.col("doc_id"), F.col("start") + i.cast("int"))), lambda x: x.isNotNull())).alias("at"))
    found = workers.keep(hits.groupBy("doc_id", "mark").agg(F.collect_list("at").alias("starts")), "removed")
    workers.drop(held, least)
    return found


def digest_batches(batches, width: int):
    """(doc_id, text, starts) rows as doc_id, n_words, n_removed, kept_sha256."""
    for batch in batches:
        out = [[], [], []]
        for text, starts in zip(batch.column(1), batch.column(2), strict=True):
            kept, gone = _kept_words(text.as_py() or "", starts.as_py(), width)
            for x, y in zip(out, (len(kept) + gone, gone, hashlib.sha256(b" ".join(kept)).hexdigest()), strict=True):
                x.append(y)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                                          pa.array(out[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def text_batches(batches, width: int):
    """(row, text, starts) rows as (row, text): the kept words, or the text itself if none goes."""
    for batch in batches:
        for a, b in words.pieces(batch.column(1), words.SLICE):
            part, texts = batch.slice(a, b - a), []
            for text, starts in zip(part.column(1), part.column(2), strict=True):
                texts.append(b" ".join(_kept_words(text.as_py(), starts.as_py(), width)[0]).decode() if starts.as_py() else text.as_py())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["row", "text"])


def removal_report(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    rows = _rows(docs, "doc_id", "text")
    gone = removed_windows(rows, width)
    return rows.join(gone, ["doc_id", "mark"], "left").select("doc_id", "text", "starts") \
        .mapInArrow(workers.task(__name__, "digest_batches", width=width), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``; ``n_chars``, if a column, is the new length where text changed."""
    gone = removed_windows(_rows(docs, "doc_id", "text"), width)
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.col("text").cast("string").alias("text")).withColumn("tell", _mark())
    joined = wide.join(gone, (wide.id == gone.doc_id) & (wide.tell == gone.mark), "left").select("row", "text", "starts")
    schema = T.StructType([joined.schema["row"], joined.schema["text"]])
    new = joined.mapInArrow(workers.task(__name__, "text_batches", width=width), schema)
    kind = dict(docs.dtypes)

    def column(c):
        old = F.col(f"row.`{c}`")
        if c == "text":
            return F.col("text").cast(kind[c]).alias(c)
        if c == "n_chars":
            changed = ~F.col("text").eqNullSafe(F.col("row.text").cast("string"))
            return F.when(changed, F.length("text")).otherwise(old).cast(kind[c]).alias(c)
        return old.alias(c)

    return new.select(*[column(c) for c in docs.columns])
