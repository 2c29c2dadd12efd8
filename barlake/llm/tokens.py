"""Operator 7: BPE encoding and decoding by a contiguous rank array.

A pre-token is held as a list of parts and, beside it, a list of the ranks of
adjacent pairs. The smallest rank is searched by a scan, the boundary is
deleted, and the ranks of the two neighbouring pairs are worked out anew. For
pre-tokens (short) this beats heaps and linked lists. A very long pre-token
uses a heap of (rank, position) instead, with the same result.

Texts are cut at ASCII white space first; neither the normaliser (NFC, white
space, lower case), the pattern nor an added token of the vocabulary spans
it, so a piece's ids do not depend on its neighbours and are remembered, up to
a bound, in each worker; a whole column is cut, looked up and gathered at once.

Defined cases: a null or empty text has no ids and decodes to the empty text;
an id outside the vocabulary is left out when decoding; repeated rows give
repeated results; other columns are carried along unchanged, and a table that
has the output's name already is refused.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm import words, workers
from barlake.llm.probing import Slots

CACHE = 1_500_000  # remembered pieces per worker (about 60 bytes each); beyond it the worker starts anew
SHORT = 16  # bytes up to which a piece is found by its bytes as two 64-bit numbers
LONG = 256  # symbols from which a heap replaces the scan
TAIL = b".,!?;:#*$%&|"  # characters that are neither letters, digits, white space nor an apostrophe

_IN_TAIL = np.zeros(256, dtype=bool)
_IN_TAIL[list(TAIL)] = True
_LETTER = np.zeros(256, dtype=bool)  # ASCII letters
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LATIN = np.zeros(256, dtype=bool)  # second bytes of U+00C0 to U+00FF without the signs for times and division
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FIRST = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)  # the first bytes of a 64-bit number


def _eights(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on, as little-endian numbers; 24 positions beyond the end may be asked."""
    padded = np.concatenate([buf, np.zeros(32, dtype=np.uint8)])
    return np.ndarray(len(padded) - 8, dtype="<u8", buffer=padded, strides=(1,))


class Pieces:
    """Ids of texts from the remembered ids of their pieces between ASCII white space, for whole columns.

    A piece that ends in a letter and then characters of ``TAIL`` is two
    pre-tokens and is cut there, so that a word costs one encoding whatever
    follows it. It is cut only after a letter that the normaliser leaves a
    letter for certain: ASCII or Latin-1. A piece of ASCII without ``<`` is
    remembered in lower case. Pieces of up to ``SHORT`` bytes are found by
    their very bytes, longer ones in a dictionary.
    """

    def __init__(self, learn):
        self.learn = learn  # list of pieces -> list of id arrays
        self._clear()

    def _clear(self) -> None:
        self.slots = Slots(16)
        self.count = self.used = 0
        self.key = np.zeros((3, 1 << 12), dtype=np.uint64)  # first 8 bytes, next 8, length
        self.at = np.zeros(1 << 12, dtype=np.int64)
        self.n = np.zeros(1 << 12, dtype=np.int32)
        self.ids = np.zeros(1 << 14, dtype="<u4")
        self.long: dict[bytes, int] = {}

    def _store(self, pieces: list[bytes]) -> np.ndarray:
        """Learn new pieces; their numbers."""
        got = self.learn(pieces) if pieces else []
        n = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        a, b = self.count, self.count + len(got)
        while b > len(self.n):
            self.key = np.concatenate([self.key, np.zeros_like(self.key)], axis=1)
            self.at, self.n = np.concatenate([self.at, self.at]), np.concatenate([self.n, self.n])
        total = int(n.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.at[a:b] = self.used + np.cumsum(n) - n
        self.n[a:b] = n
        if total:
            self.ids[self.used:self.used + total] = np.concatenate(got)
        self.count, self.used = b, self.used + total
        return np.arange(a, b)

    def _cut(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Starts, ends and "lower the case" of the pieces of words; number of pieces of each word."""
        odd, special = np.zeros(len(starts), dtype=bool), np.zeros(len(starts), dtype=bool)
        for flags, here in ((odd, buf >= 128), (special, buf == 60)):  # words with other than ASCII, with a <
            flags[np.searchsorted(starts, np.flatnonzero(here), "right") - 1] = True
        stem = ends.copy()
        left = np.flatnonzero(_IN_TAIL[buf[stem - 1]] & ~special)
        for _ in range(64):  # what has more of such characters stays whole
            if not len(left):
                break
            stem[left] -= 1
            left = left[stem[left] > starts[left]]
            left = left[_IN_TAIL[buf[stem[left] - 1]]]
        stem[left] = ends[left]
        last = buf[np.maximum(stem - 1, 0)]
        letter = _LETTER[last] | (_LATIN[last] & (stem - starts >= 2) & (buf[np.maximum(stem - 2, 0)] == 0xC3))
        cut = (stem > starts) & (stem < ends) & letter
        pieces = 1 + cut.astype(np.int64)
        first = np.cumsum(pieces) - pieces
        s, e = np.empty(int(pieces.sum()), np.int64), np.empty(int(pieces.sum()), np.int64)
        s[first], e[first] = starts, np.where(cut, stem, ends)
        s[first[cut] + 1], e[first[cut] + 1] = stem[cut], ends[cut]
        lower = np.zeros(len(s), dtype=bool)
        lower[first] = ~odd & ~special
        return s, e, lower, pieces

    def _numbers(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """The number of every piece, learnt if it is new."""
        size = (e - s).astype(np.uint64)
        plain, folded = _eights(buf), _eights(_LOWER[buf])
        part = np.minimum(size, np.uint64(8)).astype(np.int64)
        lo = np.where(lower, folded[s], plain[s]) & _FIRST[part]
        more = np.minimum(np.maximum(size, np.uint64(8)) - np.uint64(8), np.uint64(8)).astype(np.int64)
        hi = np.where(more > 0, np.where(lower, folded[s + 8 * (more > 0)], plain[s + 8 * (more > 0)]), np.uint64(0)) & _FIRST[more]
        h = words.mix(lo + words.mix(hi + size))
        out = self.slots.find(h).astype(np.int64)
        short = size <= SHORT
        at = np.maximum(out, 0)
        same = short & (out >= 0) & (self.key[0, at] == lo) & (self.key[1, at] == hi) & (self.key[2, at] == size)
        new = np.flatnonzero(~same)
        if not len(new):
            return out
        raw = buf.tobytes()

        def names(at):
            spans = zip(s[at].tolist(), e[at].tolist(), lower[at].tolist(), strict=True)
            return [raw[a:b].lower() if f else raw[a:b] for a, b, f in spans]

        mine = new[short[new] & (out[new] < 0)]
        hashes, first, back = np.unique(h[mine], return_index=True, return_inverse=True)
        kind = mine[first]  # one piece of each new hash
        same = (lo[mine] == lo[kind][back]) & (hi[mine] == hi[kind][back]) & (size[mine] == size[kind][back])
        numbers = self._store(names(kind))
        self.key[0, numbers], self.key[1, numbers], self.key[2, numbers] = lo[kind], hi[kind], size[kind]
        self.slots.add(hashes, numbers.astype(np.int32))
        out[mine] = np.where(same, numbers[back], -1)
        # long pieces, and short ones whose hash another piece has, go by name
        by_key = np.zeros(len(out), dtype=bool)
        by_key[mine[same]] = True
        rest = new[~by_key[new]]
        found = names(rest)
        unknown = list(dict.fromkeys(x for x in found if x not in self.long))
        self.long.update(zip(unknown, self._store(unknown).tolist(), strict=True))
        out[rest] = [self.long[x] for x in found]
        return out

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of an Arrow string column, one after the other, and n+1 offsets; null is empty."""
        parts, counts = [], [np.zeros(1, dtype=np.int64)]
        for a, b in words.pieces(column, words.SLICE):
            if self.count > CACHE:
                self._clear()
            buf, offs = words.text_bytes(column.slice(a, b - a))
            starts, ends = words.spans(buf, offs)
            if not len(starts):
                counts.append(np.zeros(b - a, dtype=np.int64))
                continue
            s, e, lower, pieces = self._cut(buf, starts, ends)
            number = self._numbers(buf, s, e, lower)
            n = self.n[number].astype(np.int64)
            done = np.concatenate([[0], np.cumsum(n)])
            total = int(done[-1])
            parts.append(self.ids[np.repeat(self.at[number] - done[:-1], n) + np.arange(total)])
            edge = np.concatenate([[0], np.cumsum(pieces)])[np.searchsorted(starts, offs)]  # first piece of each text
            counts.append(np.diff(done[edge]))
        ids = np.concatenate(parts) if parts else np.zeros(0, dtype="<u4")
        return ids, np.cumsum(np.concatenate(counts))

    def encode(self, text: str) -> bytes:
        return self.encode_column(pa.array([text], pa.string()))[0].tobytes()


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Codec:
    """Encodes and decodes with a tokenizer file that has NFC, lower case, a pattern and word ends."""

    def __init__(self, path: str):
        import regex
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.added = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None
        self.marks = [s[:2] for s in self.special]
        self.symbols = byte_symbols()
        self.pieces = Pieces(lambda new: [np.array(self.piece(p), dtype="<u4") for p in new])

    def merge(self, symbols: list[str]) -> list[int]:
        """Ids of one pre-token: merge the pair of least rank, leftmost first, until none is left."""
        vocab = self.vocab
        last = symbols[-1] + self.suffix
        parts = [vocab[s] for s in symbols[:-1] if s in vocab] + ([vocab[last]] if last in vocab else [])
        if len(parts) > LONG:
            return self.merge_long(parts)
        merges, none = self.merges, (1 << 60, -1)
        ranks = [merges.get(p, none) for p in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best is none:
                break
            i = ranks.index(best)
            parts[i] = best[1]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = merges.get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = merges.get((parts[i], parts[i + 1]), none)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in O(n log n), over neighbours kept by position."""
        merges, n = self.merges, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, parts[i], parts[i + 1]) for i in range(n - 1)
                if (m := merges.get((parts[i], parts[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = merges[a, b][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (m := merges.get((parts[x], parts[y]))):
                    heapq.heappush(heap, (m[0], x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def plain(self, text: str) -> list[int]:
        """Ids of a text without added tokens."""
        text = unicodedata.normalize("NFC", text)
        # character by character: no final form of sigma
        text = (text.replace("Σ", "σ") if "Σ" in text else text).lower()
        symbols, out = self.symbols, []
        for word in self.pattern.findall(text):
            out += self.merge([symbols[b] for b in word.encode()])
        return out

    def piece(self, raw: bytes) -> list[int]:
        """Ids of a piece without ASCII white space."""
        text = raw.decode()
        if self.added is None or not any(m in text for m in self.marks):
            return self.plain(text)
        out, at = [], 0
        for m in self.added.finditer(text):
            out += self.plain(text[at:m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self.plain(text[at:])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.pieces.encode(text), dtype="<u4").tolist()

    def decode(self, ids) -> str:
        """Token texts joined by one space (the file has no decoder); unknown ids are left out."""
        names = self.names
        return " ".join([names[i] for i in ids if i in names])


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_batches(batches, path: str):
    """(row, text) as (row, value): the text's ids."""
    c = codec(path)
    for batch in batches:
        for a, b in words.pieces(batch.column(1), words.SLICE):
            texts = batch.column(1).slice(a, b - a)
            flat, offsets = c.pieces.encode_column(texts)
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.view("<i4")), mask=texts.is_null())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], ["row", "value"])


def decode_batches(batches, path: str):
    """(row, ids) as (row, value): the ids' text."""
    c = codec(path)
    for batch in batches:
        texts = pa.array([None if x.as_py() is None else c.decode(x.as_py()) for x in batch.column(1)], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["row", "value"])


def _beside(df: DataFrame, batches: str, path: str, source, kind: str, out: str) -> DataFrame:
    """``df`` with a column ``out`` that a task works out from ``source``; the row travels as one struct, whatever its names."""
    if out in df.columns:
        raise ValueError(f"{out} is already a column")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), source.alias("value"))
    schema = rows.withColumn("value", F.lit(None).cast(kind)).schema
    done = rows.mapInArrow(workers.task(__name__, batches, path=path), schema)
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns], F.col("value").alias(out))


def bpe_encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text`` (null for a null text) as an array column ``out``."""
    return _beside(df, "encode_batches", path, F.col(f"`{text}`").cast("string"), "array<int>", out)


def bpe_decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of the ids in ``ids`` as a column ``out``."""
    return _beside(df, "decode_batches", path, F.col(f"`{ids}`"), "string", out)


def digest_batches(batches, path: str):
    """Ids and decoded text of each row as digests: neither leaves the task."""
    c = codec(path)
    for batch in batches:
        ids, at = c.pieces.encode_column(batch.column(1))
        each = [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        raw = [hashlib.sha256(x).hexdigest() for x in each]
        text = [hashlib.sha256(c.decode(x.tolist()).encode()).hexdigest() for x in each]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at)), pa.array(raw, pa.string()), pa.array(text, pa.string())],
                                         ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs``."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(workers.task(__name__, "digest_batches", path=path),
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
