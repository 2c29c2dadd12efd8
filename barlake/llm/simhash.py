"""Operator 4: SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints at distance d meet at a point half-way: if each emits all
variants within half the radius, a shuffle on the variants brings every pair
within the radius together. An odd radius r has no whole half; so the 64 bits
are cut into r blocks and the variants are formed once for each block with
that block blanked. A pair at distance r or less differs in at least one
block (or nowhere), and with it blanked at most r - 1 bits are left: half of
that, (r - 1) / 2, from either side. For r = 3 that is 3 * (1 + 43) variants
of about 43 bits instead of the 2,081 of a ball of radius 2; for an even r the
whole fingerprint is used and nothing is blanked.

Only distinct fingerprints are hashed (copies are grouped first), a colliding
pair is verified on all 64 bits, and a bucket gives the links of a spanning
forest (as many as its members at most), not its pairs. Members of a bucket
differ in one block and at most r - 1 further bits, which bounds it.

Defined cases: null text counts as empty; empty text has fingerprint zero and
is linked like any other; a null doc_id takes part, but a component's id is
the least doc_id that is not null (null if there is none); repeated rows give
repeated rows; other columns of the input are not looked at.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import workers
from barlake.llm.components import components

SEED = 42  # of XXH64
CHUNK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str | None, width: int) -> int:
    """Signed 64-bit SimHash of a text's word shingles."""
    from xxhash import xxh64_digest
    words = (text or "").encode().lower().split()  # bytes.lower() changes A-Z only
    if not words:
        return 0
    k = min(width, len(words))
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.concatenate([[0], np.cumsum(lens + 1)[:-1]])
    first, last = starts[:len(words) - k + 1].tolist(), (starts + lens)[k - 1:].tolist()
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(first), CHUNK):
        digests = b"".join([xxh64_digest(joined[s:e], SEED)
                            for s, e in zip(first[at:at + CHUNK], last[at:at + CHUNK], strict=True)])
        bits = np.unpackbits(np.frombuffer(digests, dtype=np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(first)).view(">i8")[0])


def fingerprint_batches(batches, width: int):
    """The first columns as they are and, for the text in the last, its fingerprint."""
    for batch in batches:
        fps = pa.array([fingerprint(t.as_py(), width) for t in batch.columns[-1]], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fps], [*batch.schema.names[:-1], "fp"])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def variants(radius: int) -> list[tuple[int, list[int]]]:
    """(bits kept, flips) for each blanked block: all flips of at most half the remaining radius."""
    if radius == 0:
        return [((1 << 64) - 1, [0])]
    if radius % 2 == 0:
        masks, half = [(1 << 64) - 1], radius // 2
    else:
        edges = [round(64 * i / radius) for i in range(radius + 1)]
        masks = [((1 << 64) - 1) & ~(((1 << b) - (1 << a))) for a, b in zip(edges, edges[1:], strict=False)]
        half = (radius - 1) // 2
    out = []
    for mask in masks:
        bits = [1 << i for i in range(64) if mask >> i & 1]
        out.append((mask, [sum(c) for n in range(half + 1) for c in combinations(bits, n)]))
    return out


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (least member, member) of the groups that distances up to ``radius`` join in one bucket."""
    left = np.unique(fps)
    us, vs = [], []
    while len(left) > 1:
        root, frontier, left = left[0], [left[0]], left[1:]
        while frontier and len(left):
            near = np.bitwise_count(left ^ frontier.pop()) <= radius
            if near.any():
                found, left = left[near], left[~near]
                frontier.extend(found)
                us.append(np.full(len(found), root))
                vs.append(found)
    none = np.zeros(0, dtype=np.uint64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def _links(keys: np.ndarray, fps: np.ndarray, radius: int):
    """Links of whole buckets, sorted by key."""
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(edges)
    two = edges[:-1][sizes == 2]
    a, b = fps[two], fps[two + 1]
    ok = (np.bitwise_count(a ^ b) <= radius) & (a != b)
    us, vs = [a[ok]], [b[ok]]
    for k in np.flatnonzero(sizes > 2):
        u, v = forest(fps[edges[k]:edges[k + 1]], radius)
        us.append(u)
        vs.append(v)
    u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
    pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def link_batches(batches, radius: int):
    """Batches sorted by key; the last bucket of a batch waits for the next one."""
    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield _links(keys[:cut], fps[:cut], radius)
            keys, fps = keys[cut:], fps[cut:]
    if len(keys):
        yield _links(keys, fps, radius)


def links(fps: DataFrame, radius: int) -> DataFrame:
    """Distinct links (a, b) that join all distinct values of ``fp`` at ``radius`` bits or fewer."""
    parts = workers.tasks_for(fps.sparkSession)
    keyed = []
    for block, (mask, flips) in enumerate(variants(radius)):
        kept = F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long"))
        blank = ~mask & ((1 << 64) - 1)
        tag = block * (blank & -blank)  # the blanked bits hold the block's number: keys of different blocks differ mostly
        keyed += [kept.bitwiseXOR(F.lit(_signed(flip | tag)).cast("long")) for flip in flips]
    buckets = fps.repartition(parts, "fp").select(F.explode(F.array(*keyed)).alias("key"), "fp") \
        .repartition(parts, "key").sortWithinPartitions("key")
    return buckets.mapInArrow(workers.task(__name__, "link_batches", radius=radius), "a long, b long").distinct()


def _marked(docs: DataFrame, width: int, radius: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Every row's (doc_id, digest of the text, fp), and (fp, root of its component) for every fp."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    prints = workers.keep(rows.select("doc_id", F.xxhash64("text").alias("digest"), "text").mapInArrow(
        workers.task(__name__, "fingerprint_batches", width=width), "doc_id long, digest long, fp long"), "fingerprints")
    distinct = workers.keep(prints.select("fp").distinct(), "distinct")
    roots = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    classes = workers.keep(distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")), "classes")
    workers.drop(distinct)
    return prints, classes


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row: documents linked at ``radius`` bits or fewer."""
    prints, classes = _marked(docs, width, radius, doc_id, text)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("first")).join(classes, "fp") \
        .groupBy("root").agg(F.min("first").alias("component_id"))
    members = classes.join(least, "root").select("fp", "component_id")
    return prints.join(members, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates, with all columns.

    The row with the least doc_id stays (null last); of several rows with that
    doc_id, the one with the least digest of its text.
    """
    prints, classes = _marked(docs, width, radius, "doc_id", "text")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    heads = prints.groupBy("fp").agg(F.min(order).alias("head")).join(classes, "fp") \
        .groupBy("root").agg(F.min("head").alias("head")).select("head.doc_id", "head.digest")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("mark"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = rows.join(heads, (rows.mark == heads.digest) & rows.id.eqNullSafe(heads.doc_id))
    return kept.select("id", "mark", "row").dropDuplicates(["id", "mark"]) \
        .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
