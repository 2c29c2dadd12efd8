"""Operator 10: token ids in files of independent zstandard frames with a seek table.

File layout (little-endian), after the public seekable format of zstandard:

* frames: each a complete zstandard frame holding the ids (unsigned 32-bit) of
  whole documents, closed at ``frame_bytes``; a longer document fills several;
* a skippable frame with the documents: count, then doc_id, number of ids and
  position in the uncompressed ids for each;
* a skippable frame with the seek table: for each frame its compressed size,
  decompressed size and a checksum (low 32 bits of XXH64 of the content), then
  number of frames, a descriptor byte (0x80: checksums) and the magic number.

A reader fetches the end of a file, then only the frames that hold the wanted
documents. Writing sorts by doc_id over range partitions, one file each. A
task writes to a name of its own and the file counts only if the task's row
reaches the manifest, so a lost executor or a second attempt leaves at most an
unlisted file. Storage is reached through pyarrow's file systems by URI.

Defined cases: a null or empty text holds the end id alone; rows with a null
doc_id come first and spread over files; rows of one doc_id are ordered by
their text's first 16 characters, then by its hash, and each is kept; an empty
table gives an empty manifest.
"""

from __future__ import annotations

import json
import string
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import workers
from barlake.llm.tokens import Pieces

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

NO_ID = -(1 << 63)  # stands for a null doc_id inside a file
JOINED = 2_000  # new pieces that the library encodes as one text
#: a vocabulary without a special token: nothing can be joined
NO_MARK = {"content": None, "id": None, "special": True, "normalized": False, "single_word": False, "lstrip": False, "rstrip": False}


class Library:
    """Ids by the tokenizers library; pieces between ASCII white space are remembered (``tokens.Pieces``).

    No normaliser, pattern or added token of the file spans white space, so a
    piece's ids do not depend on its neighbours.
    """

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.pieces = Pieces(self.learn)

        self.mark = next((t["content"], t["id"]) for t in [*json.loads(self.tok.to_str())["added_tokens"], NO_MARK]
                         if t["special"] and not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]))

        probe = string.ascii_lowercase * 2
        self.model = self.tok.model if (
            (self.tok.normalizer is None or self.tok.normalizer.normalize_str(probe) == probe)
            and self.tok.pre_tokenizer is not None and self.tok.pre_tokenizer.pre_tokenize_str(probe) == [(probe, (0, 52))]) else None

    def learn(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces.

        Where a word of a to z is left as it is and is one pre-token, the
        library's model is asked for it directly; other pieces are joined by a
        special token and encoded together, apart from those that may hold one.
        """
        mark, mark_id = self.mark
        out: list = [None] * len(pieces)
        rest = list(range(len(pieces)))
        if self.model is not None:
            ask = self.model.tokenize
            for i, p in enumerate(pieces):
                if p.isalpha() and p.isascii() and p.islower():
                    out[i] = np.array([t.id for t in ask(p.decode())], dtype="<u4")
            rest = [i for i in rest if out[i] is None]
        alone = rest if mark is None else [i for i in rest if mark[0].encode() in pieces[i]]
        if mark is not None:
            own = set(alone)
            rest = [i for i in rest if i not in own]
            for a in range(0, len(rest), JOINED):
                group = rest[a:a + JOINED]
                text = mark.join([pieces[i].decode() for i in group])
                ids = np.array(self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
                cuts = np.flatnonzero(ids == mark_id).tolist()
                for i, x, y in zip(group, [-1, *cuts], [*cuts, len(ids)], strict=True):
                    out[i] = ids[x + 1:y]
        got = self.tok.encode_batch_fast([pieces[i].decode() for i in alone], add_special_tokens=False)
        for i, e in zip(alone, got, strict=True):
            out[i] = np.array(e.ids, dtype="<u4")
        return out

    def encode(self, text: str) -> bytes:
        return self.pieces.encode(text)


_library: dict[str, Library] = {}


def library(path: str) -> Library:
    if path not in _library:
        _library[path] = Library(path)
    return _library[path]


def open_fs(uri: str):
    """pyarrow file system and path of a URI or an absolute path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


class Writer:
    """Streams documents into one file."""

    def __init__(self, sink, frame_bytes: int, level: int):
        import zstandard
        self.sink, self.frame_bytes = sink, frame_bytes
        self.press = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.buffer, self.pending = [], 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []
        self.total = 0

    def add(self, doc_id, ids: bytes) -> None:
        self.docs.append((NO_ID if doc_id is None else doc_id, len(ids) // 4, self.total // 4))
        self.total += len(ids)
        for at in range(0, len(ids), self.frame_bytes):
            part = ids[at:at + self.frame_bytes]
            self.buffer.append(part)
            self.pending += len(part)
            if self.pending >= self.frame_bytes:
                self.flush()

    def flush(self) -> None:
        import xxhash
        if self.pending:
            raw = b"".join(self.buffer)
            packed = self.press.compress(raw)
            self.sink.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.buffer, self.pending = [], 0

    def close(self) -> None:
        self.flush()
        docs = struct.pack("<I", len(self.docs)) + np.array(self.docs, dtype="<i8").tobytes()
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(docs)) + docs)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        foot = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(foot)) + table + foot)


class Reader:
    """Random access to the documents of one file."""

    def __init__(self, source):
        self.source, size = source, source.size()
        source.seek(size - 9)
        n, flag, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        source.seek(size - 9 - 12 * n)
        self.frames = np.frombuffer(source.read(12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.packed = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.raw = np.concatenate([[0], np.cumsum(self.frames[:, 1])])
        source.seek(int(self.packed[-1]))
        magic, _, docs = struct.unpack("<III", source.read(12))
        if magic != SKIPPABLE_MAGIC:
            raise ValueError("no table of documents after the frames")
        self.docs = np.frombuffer(source.read(24 * docs), dtype="<i8").reshape(docs, 3)
        self.last = (-1, b"")
        self.decompressed = 0

    def frame(self, k: int) -> bytes:
        import xxhash
        import zstandard
        if self.last[0] != k:
            self.source.seek(int(self.packed[k]))
            raw = zstandard.ZstdDecompressor().decompress(self.source.read(int(self.frames[k, 0])))
            if len(raw) != self.frames[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k, 2]:
                raise ValueError(f"checksum of frame {k} does not hold")
            self.last = (k, raw)
            self.decompressed += 1
        return self.last[1]

    def ids(self, row: int):
        """The parts of a document's ids, frame by frame."""
        at, end = 4 * self.docs[row, 2], 4 * (self.docs[row, 2] + self.docs[row, 1])
        while at < end:
            k = int(np.searchsorted(self.raw, at, "right")) - 1
            stop = min(end, self.raw[k + 1])
            yield self.frame(k)[at - self.raw[k]:stop - self.raw[k]]
            at = stop


_MANIFEST = "file_no int, file string, docs long, ids long, bytes long, checksum long"


def write_batches(batches, path: str, folder: str, end_id: int, frame_bytes: int, level: int):
    from pyspark import TaskContext
    lib, end = library(path), np.array([end_id], dtype="<u4").tobytes()
    writer = sink = None
    for batch in batches:
        ids, at = lib.pieces.encode_column(batch.column(1))
        for doc_id, a, b in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
            if writer is None:
                fs, root = open_fs(folder)
                fs.create_dir(root, recursive=True)
                name = f"ids-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.zst"
                sink = fs.open_output_stream(f"{root}/{name}", compression=None)
                writer = Writer(sink, frame_bytes, level)
            writer.add(doc_id, ids[a:b].tobytes() + end)
    if writer is not None:
        writer.close()
        size = sink.tell()
        sink.close()
        yield pa.RecordBatch.from_pydict({
            "file_no": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [f"{folder}/{name}"],
            "docs": [len(writer.docs)], "ids": [writer.total // 4], "bytes": [size],
            "checksum": [zlib.crc32(np.array(writer.frames, dtype="<i8").tobytes())]})


def write_ids(df: DataFrame, path: str, folder: str | None = None, end_id: int = 1, frame_bytes: int = 1 << 18,
              level: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write every row's ids, in ascending doc_id order, and return the manifest: one row per file."""
    spark = df.sparkSession
    folder = folder or workers.new_folder(spark, "ids")
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    # the driver samples the keys: the text itself, however long, is none of them
    order = ["doc_id", F.substring("text", 1, 16).alias("head"), F.xxhash64("text").alias("hash")]
    rows = rows.select("doc_id", "text", *order[1:])
    rows = rows.repartitionByRange(workers.tasks_for(spark), "doc_id", "head", "hash").sortWithinPartitions("doc_id", "head", "hash")
    manifest = rows.select("doc_id", "text").mapInArrow(workers.task(__name__, "write_batches", path=path, folder=folder, end_id=end_id,
                                            frame_bytes=frame_bytes, level=level), _MANIFEST)
    return workers.keep(manifest, "manifest")


def starts_of(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``: ids in all files before. One row per file, so one small task."""
    from pyspark.sql import Window
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_batches(batches):
    for batch in batches:
        for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fs, name = open_fs(file)
            with fs.open_input_file(name) as source:
                reader = Reader(source)
                n = len(reader.docs)
                for a in range(0, n, 10_000):
                    part = reader.docs[a:a + 10_000]
                    crc = np.zeros(len(part), dtype=np.int64)
                    for i in range(len(part)):
                        c = 0
                        for ids in reader.ids(a + i):
                            c = zlib.crc32(ids, c)
                        crc[i] = c
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part[:, 0], mask=part[:, 0] == NO_ID), pa.array(part[:, 2] + start),
                         pa.array(part[:, 1]), pa.array(crc)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(manifest: DataFrame) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    files = starts_of(manifest).select("file", "start").repartition(workers.tasks_for(manifest.sparkSession), "file")
    return files.mapInArrow(workers.task(__name__, "read_batches"),
                            "doc_id long, start long, n_tokens long, ids_crc32 long")


def wanted_batches(batches, wanted):
    for batch in batches:
        for file in batch.column(0).to_pylist():
            fs, name = open_fs(file)
            with fs.open_input_file(name) as source:
                reader = Reader(source)
                for row in np.flatnonzero(np.isin(reader.docs[:, 0], wanted)):
                    ids = np.frombuffer(b"".join(reader.ids(int(row))), dtype="<u4").astype(np.int64)
                    yield pa.RecordBatch.from_pydict({"doc_id": [int(reader.docs[row, 0])],
                                                      "ids": pa.array([ids], pa.list_(pa.int64()))})


def read_documents(manifest: DataFrame, wanted: list[int]) -> DataFrame:
    """The ids of the listed documents; only the frames that hold them are decompressed."""
    return manifest.select("file").mapInArrow(workers.task(__name__, "wanted_batches", wanted=wanted),
                                              "doc_id long, ids array<long>")


