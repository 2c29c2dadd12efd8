"""Operator 5: chat formatting into prefix trees.

Conversations that begin with the same turns share those tokens: they form a
tree whose nodes are turns, and each node is emitted once, depth-first, with
its place in the tree's sequence, the position its first token has in a
conversation, and the token intervals of its ancestors, which with the node
itself are all that its tokens may attend to. A token is a code point of the
formatted text. Text under the loss is what assistants say.

A turn is written ``<|turn|>role\\ntext<|end|>\\n``. In roles and texts a
backslash is doubled and one is put after every character that may begin a
control string, so no control string can occur in them and reading back is exact.

Scale: a node's id is a digest of all turns up to it, so a conversation's ids
are found without its neighbours. Distinct conversations are sorted by their
path of ids over range partitions; each then adds the nodes that the one before
it lacks. What crosses a partition's edge - last path, tokens so far, starts
of the open branch - is one small row for each partition. So a tree that holds
a third of all conversations is spread over many tasks.

Defined cases: null text or role counts as empty; rows of one conv_id form one
conversation, ordered by turn (null first), then role and text; a repeated row
is one more turn; a null conv_id is a conversation too; an empty table gives
empty results; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import workers

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
LOSS_ROLE = "assistant"
#: Control strings of known chat templates; none may occur inside a text.
CONTROLS = ("<|turn|>", "<|end|>", "<|im_start|>", "<|im_end|>", "<|startoftext|>", "<|endoftext|>", "<s>", "</s>",
            "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
_FIRST = "".join(sorted({c[0] for c in CONTROLS}))
_ESCAPE = re.compile(rf"[{re.escape(_FIRST)}\\]")
_BACK = re.compile(rf"[{re.escape(_FIRST)}]\\|\\\\|\\n")
ID = 16  # bytes of a node id


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: "\n" if m[0] == "\\n" else m[0][0], text)


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A turn as formatted, and where its text lies in it."""
    head = OPEN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    if not formatted.startswith(OPEN) or not formatted.endswith(CLOSE):
        raise ValueError("not a formatted turn")
    role, _, body = formatted[len(OPEN):-len(CLOSE)].partition("\n")
    return unescape(role), unescape(body)


def path_batches(batches):
    """A conversation's turns as its path of node ids and its formatted turns."""
    for batch in batches:
        paths, segments, losses = [], [], []
        for turns in batch.column(1).to_pylist():
            at, path, segs, loss = b"", [], [], []
            for t in turns:
                role = t["role"] or ""
                seg, a, b = segment(role, t["text"] or "")
                at = hashlib.blake2b(at + seg.encode(), digest_size=ID).digest()
                path.append(at)
                segs.append(seg)
                loss.append([a, b] if role == LOSS_ROLE else [0, 0])
            paths.append(b"".join(path))
            segments.append(segs)
            losses.append(loss)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.binary()),
                                          pa.array(segments, pa.list_(pa.string())),
                                          pa.array(losses, pa.list_(pa.list_(pa.int32())))],
                                         ["conv_id", "path", "segments", "losses"])


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, segments, losses), one row for each conversation."""
    turn = F.struct(F.col("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    grouped = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")) \
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return grouped.mapInArrow(workers.task(__name__, "path_batches"),
                              "conv_id long, path binary, segments array<string>, losses array<array<int>>")


def _shared(a: bytes, b: bytes) -> int:
    """Number of ids that two paths have in common at the beginning."""
    n, end = 0, min(len(a), len(b))
    while n < end and a[n:n + ID] == b[n:n + ID]:
        n += ID
    return n // ID


class _Walk:
    """Depth-first place of each new node while sorted paths go by."""

    def __init__(self, path: bytes = b"", offset: int = 0, starts: list | None = None):
        self.path, self.offset, self.starts = path, offset, list(starts or [])
        self.fresh = False  # a tree has begun since

    def step(self, path: bytes, lengths: list[int]) -> int:
        """Take the next path; returns the depth from which its nodes are new."""
        common = _shared(self.path, path)
        if not common:
            self.offset, self.fresh = 0, True
        self.starts = self.starts[:common]
        for n in lengths[common:]:
            self.starts.append(self.offset)
            self.offset += n
        self.path = path
        return common


def _by_part(batches):
    """(part, path, segments, losses) rows, one at a time."""
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield row


_SUMS = "part int, fresh boolean, offset long, starts array<long>"


def sum_batches(batches, before):
    """For each part: tokens of its last tree and the starts of its open branch, null where they lie in an earlier part."""
    now, walk = None, None
    for part, path, segments, _ in _by_part(batches):
        if part != now:
            if walk:
                yield _sums(now, walk)
            prev = before[part]
            now, walk = part, _Walk(prev, 0, [None] * (len(prev) // ID))
        walk.step(path, [len(s) for s in segments])
    if walk:
        yield _sums(now, walk)


def _sums(part, walk):
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([walk.fresh]), pa.array([walk.offset]),
                                       pa.array([walk.starts], pa.list_(pa.int64()))], ["part", "fresh", "offset", "starts"])


_NODES = ("tree_id binary, node_id binary, depth int, start long, n_tokens int, position long, "
          "ancestors array<struct<start:long,end:long>>, segment string, loss_start int, loss_end int")


def _joined(intervals: tuple, start: int, n: int) -> tuple:
    """Token intervals of a branch with the next node's, neighbours joined."""
    if intervals and intervals[-1][1] == start:
        return (*intervals[:-1], (intervals[-1][0], start + n))
    return (*intervals, (start, start + n))


def node_batches(batches, carried):
    """The nodes that each sorted path adds."""
    names = [x.split()[0] for x in _NODES.split(", ")]
    interval = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = [pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), interval, pa.string(), pa.int32(),
             pa.int32()]
    now, walk, rows = None, None, []
    for part, path, segments, losses in _by_part(batches):
        if part != now:
            now, walk = part, _Walk(*carried[part])
        lengths = [len(s) for s in segments]
        common, position, ancestors = walk.step(path, lengths), 0, ()
        for d, n in enumerate(lengths):
            if d >= common:
                rows.append((path[:ID], path[d * ID:(d + 1) * ID], d, walk.starts[d], n, position,
                             [{"start": a, "end": b} for a, b in ancestors], segments[d], *losses[d]))
            position += n
            ancestors = _joined(ancestors, walk.starts[d], n)
        if len(rows) > 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def prefix_trees(convs: DataFrame) -> DataFrame:
    """The nodes of all trees from the result of ``paths``; ordered by (tree_id, start) they are the sequences."""
    spark = convs.sparkSession
    parts = workers.tasks_for(spark)
    # copies of a conversation are one path
    leaves = convs.groupBy("path").agg(F.first("segments").alias("segments"), F.first("losses").alias("losses")) \
        .filter(F.length("path") > 0)
    dealt = workers.keep(leaves.repartitionByRange(parts, "path")
                         .select(F.spark_partition_id().alias("part"), "path", "segments", "losses"), "paths")
    lasts = sorted((r["part"], bytes(r["last"])) for r in dealt.groupBy("part").agg(F.max("path").alias("last")).collect())
    before, last = {}, b""
    for part, path in lasts:
        before[part], last = last, path
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "path")
    sums = {r["part"]: r for r in ordered.mapInArrow(workers.task(__name__, "sum_batches", before=before), _SUMS).collect()}
    carried, offset, starts = {}, 0, []
    for part, _ in lasts:
        carried[part] = (before[part], offset, starts)
        r = sums[part]
        base = 0 if r["fresh"] else offset
        starts = [starts[d] if s is None else base + s for d, s in enumerate(r["starts"])]
        offset = base + r["offset"]
    return ordered.mapInArrow(workers.task(__name__, "node_batches", carried=carried), _NODES)


def read_back_batches(batches):
    """Digests of each conversation from its nodes in order."""
    for batch in batches:
        out = {k: [] for k in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        for conv, nodes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            turns, loss, spoken, chars, before = hashlib.sha256(), hashlib.sha256(), 0, 0, ()
            for n in nodes:
                if n["position"] != chars or before != tuple((a["start"], a["end"]) for a in n["ancestors"]):
                    raise ValueError("a node's position or ancestors do not fit its conversation")
                before = _joined(before, n["start"], n["n_tokens"])
                role, text = parse(n["segment"])
                turns.update(f"{role}\n{text}\n".encode())
                under = unescape(n["segment"][n["loss_start"]:n["loss_end"]])
                loss.update(under.encode())
                spoken += len(under)
                chars += len(n["segment"])
            for k, v in zip(out, (conv, len(nodes), turns.hexdigest(), spoken, loss.hexdigest(), chars), strict=True):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if k.endswith("sha256") else pa.int64())
                                          for k, v in out.items()], list(out))


def read_back(convs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Each conversation's digests, from the emitted nodes on its path."""
    n = F.expr(f"int(length(path) div {ID})")
    ids = F.transform(F.sequence(F.lit(0), n - 1), lambda d: F.expr("path").substr(d * ID + 1, F.lit(ID)))
    # one row for each conversation, also where conv_id is null
    steps = convs.select("conv_id", F.posexplode(ids).alias("d", "node_id"))
    cols = ["start", "n_tokens", "position", "ancestors", "segment", "loss_start", "loss_end"]
    found = steps.join(nodes.select("node_id", F.struct("depth", *cols).alias("node")), "node_id")
    whole = found.groupBy("conv_id").agg(F.array_sort(F.collect_list("node"), lambda a, b: a["depth"] - b["depth"]).alias("nodes"))
    return whole.mapInArrow(workers.task(__name__, "read_back_batches"),
                            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted_digests(conversations: DataFrame) -> DataFrame:
    """Format all conversations into trees, keep the trees, and read every conversation back from them."""
    convs = workers.keep(paths(conversations), "conversations")
    return read_back(convs, workers.keep(prefix_trees(convs), "nodes"))
