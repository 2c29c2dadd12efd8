"""Operator 11: collocations of two to five words, counted by direct-address tiles.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends and
into words at spaces and tabs. Words are counted exactly, per language; the
frequent ones get ids in falling order of frequency, and every text becomes a
sequence of such ids with breaks in place of other words and piece ends. Pairs
of neighbouring ids are counted in tiles of ``TILE`` x ``TILE`` ids: a tile
that fills is a dense array that ``numpy.bincount`` adds to by address, the
rest is sorted (code, count) lists. Pairs that are frequent are ranked again
and their ids take part as first halves of the next round's pairs, so that
round k counts the phrases of k + 1 words whose two halves of k words are
frequent. No phrase that is frequent can be missed: its parts occur at least
as often.

Ids: the ``RANKS`` most frequent words (phrases) of a round are numbered and
their hashes are given to every task: a bounded table. All others carry two
independent 62-bit hashes instead, and a filter of fixed size (``FILTER``
bits) tells the tasks which may be frequent; what it lets through wrongly
falls out when the counts are summed. Nothing is capped: how many words or
phrases have ids, and how many have hashes, changes no result. Identity rests
on two hashes, 124 bits together.

Defined cases: a null text is empty and adds nothing; a null lang is ``und``;
repeated rows count each; words longer than a batch's buffer are words like
others; other columns are not read; an empty table gives no rows. Ties in the
score are broken by count, then by the phrase's bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm import words, workers
from barlake.llm.probing import Slots

RANKS = 1 << 18  # ids of a round given to every task
FILTER = 1 << 26  # bits of the filter for all others
TILE = 1 << 10  # ids on a tile's side
OPEN = 8  # dense tiles a task holds at once (4 MB each)
BUFFER = 1 << 19  # symbols worked on at once, and pairs that a task gathers before it counts them
SPARSE = 1 << 20  # distinct pairs of sparse tiles that a task holds before it hands them on
PARTS = 32  # shares of a language that are ranked by themselves first

NONE = np.iinfo(np.int64).min  # no symbol: another word, or the end of a piece
_BREAK, _HASHED = -1, -2  # the same in stored sequences; and a symbol that is a pair of hashes

_SEP = np.zeros(256, dtype=bool)  # ends a word
_SEP[list(b" \t.,;:!?\n\x0b\x0c\r")] = True
_END = np.zeros(256, dtype=bool)  # ends a piece as well
_END[list(b".,;:!?\n\x0b\x0c\r")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_62 = np.uint64((1 << 62) - 1)


def _u(x: np.ndarray) -> np.ndarray:
    return x.view(np.uint64)


def pair_hashes(a, b, a2, b2, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 62-bit hashes of the phrase made of symbol a (a2) and word b (b2)."""
    out = []
    for seed in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
        x = words.mix(_u(a) + np.uint64(seed + level))
        for y in (b, a2, b2):
            x = words.mix(x * np.uint64(seed | 1) + _u(y))
        out.append(x & _62)
    return out[0], out[1]


class Symbols:
    """Which hashes have a rank, and which may be frequent without one."""

    def __init__(self, h: np.ndarray, h2: np.ndarray, bits: np.ndarray | None):
        self.slots, self.h2, self.bits = Slots(8), _u(h2), bits
        first = np.unique(_u(h), return_index=True)[1]  # of two with one first hash the rarer goes without rank
        self.slots.add(_u(h)[first], first.astype(np.int32))

    def of(self, h: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of hash pairs: (rank, 0), (-2 - hash, other hash), or (NONE, 0)."""
        rank = self.slots.find(h).astype(np.int64)
        if not len(self.h2):
            rank[:] = -1
        else:
            rank[(rank >= 0) & (self.h2[np.maximum(rank, 0)] != h2)] = -1
        sym, sym2 = np.where(rank >= 0, rank, NONE), np.zeros(len(h), dtype=np.int64)
        if self.bits is not None:
            rest = np.flatnonzero(rank < 0)
            may = np.ones(len(rest), dtype=bool)
            for p in filter_places(h[rest].view(np.int64), 64 * len(self.bits)):
                may &= (self.bits[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) > 0
            rest = rest[may]
            sym[rest], sym2[rest] = -2 - h[rest].view(np.int64), h2[rest].view(np.int64)
        return sym, sym2


def filter_places(h, size: int):
    """Two places of a 62-bit hash in a filter of ``size`` (a power of two) bits; for arrays and for columns."""
    if isinstance(h, np.ndarray):
        return h & (size - 1), (h >> 31) & (size - 1)
    return h.bitwiseAND(F.lit(size - 1)), F.shiftright(h, 31).bitwiseAND(F.lit(size - 1))


def _texts(batch, which=(0, 1)):
    """For pieces of a (lang, text) batch: (rows, bytes, starts, ends, row of each word, end of piece after it, hashes)."""
    lang = batch.column(0).fill_null("und")
    for a, b in words.pieces(batch.column(1), 2 * words.PIECE):
        buf, offs = words.text_bytes(batch.column(1).slice(a, b - a))
        buf = _LOWER[buf]
        if not len(buf):
            continue
        sep = _SEP[buf]
        word = ~sep
        begins, ends = word.copy(), word.copy()
        begins[1:] &= sep[:-1]
        ends[:-1] &= sep[1:]
        edges = offs[:-1][offs[:-1] < len(buf)]
        begins[edges] = word[edges]
        edges = offs[1:][offs[1:] > 0] - 1
        ends[edges] = word[edges]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        if not len(starts):
            continue
        row = np.searchsorted(offs, starts, "right") - 1
        last = np.empty(len(starts), dtype=bool)  # another piece, or text, begins behind the word
        last[:-1] = row[1:] != row[:-1]
        last[-1] = True
        stops = np.flatnonzero(_END[buf])
        before = np.searchsorted(starts, stops) - 1
        last[before[before >= 0]] = True
        names = lang.slice(a, b - a).dictionary_encode()
        lbuf, loffs = words.text_bytes(names.dictionary.cast(pa.string()))
        code = names.indices.to_numpy(zero_copy_only=False)[row]
        hashes = []
        for w in which:
            of_lang = words.hashes(lbuf, loffs[:-1], loffs[1:], w) if len(lbuf) else np.zeros(len(loffs) - 1, np.uint64)
            hashes.append(words.mix(words.hashes(buf, starts, ends, w) + np.uint64(3) * of_lang[code]) & _62)
        yield names.dictionary, buf, starts, ends, code, last, row, hashes[0], hashes[1]


def _strings(buf, starts, ends) -> pa.Array:
    """The spans of a byte array as an Arrow string column."""
    n = ends - starts
    offs = np.concatenate([[0], np.cumsum(n)])
    data = buf[np.repeat(starts - offs[:-1], n) + np.arange(int(offs[-1]))]
    return pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offs.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _runs(*keys) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by the keys, and where runs of equal rows start in it."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        k = k[order]
        new[1:] |= k[1:] != k[:-1]
    return order, np.flatnonzero(new)


def word_batches(batches):
    """(lang, text) as (lang, word, h, h2, n): the words of each few MB of text, counted."""
    for batch in batches:
        for langs, buf, starts, ends, code, _, _, h, h2 in _texts(batch):
            order, at = _runs(h)
            same = h2[order] == np.repeat(h2[order[at]], np.diff(np.append(at, len(order))))
            if not same.all():  # two words of one first hash
                order, at = _runs(h, h2)
            n, one = np.diff(np.append(at, len(order))), order[at]
            yield pa.RecordBatch.from_arrays(
                [langs.take(pa.array(code[one])).cast(pa.string()), _strings(buf, starts[one], ends[one]),
                 pa.array(h[one].view(np.int64)), pa.array(h2[one].view(np.int64)), pa.array(n)],
                ["lang", "word", "h", "h2", "n"])


def sequence_batches(batches, symbols):
    """(lang, text) as (symbols, hashes): ranks, ``_BREAK``, or ``_HASHED`` with its two hashes in turn."""
    known = Symbols(*symbols)
    for batch in batches:
        for _, _, starts, _, _, last, row, h, h2 in _texts(batch):
            sym, sym2 = known.of(h, h2)
            none = sym == NONE
            stored = np.where(none, _BREAK, np.where(sym < 0, _HASHED, sym)).astype(np.int32)
            # a break after the last word of a piece; of breaks in a row one is enough
            places = np.arange(len(starts)) + np.cumsum(last) - last
            out = np.full(len(starts) + int(last.sum()), _BREAK, dtype=np.int32)
            out[places] = stored
            rows = np.empty(len(out), dtype=np.int64)
            rows[places] = row
            rows[places[last] + 1] = row[last]
            hashed = np.flatnonzero((sym < 0) & ~none)
            keep = np.ones(len(out), dtype=bool)
            keep[1:] = (out[1:] != _BREAK) | (out[:-1] != _BREAK)
            out, rows = out[keep], rows[keep]
            ids = np.unique(rows)
            cut = np.append(np.searchsorted(rows, ids), len(rows))
            pairs = np.stack([-2 - sym[hashed], sym2[hashed]], axis=1).ravel()
            pair_cut = 2 * np.append(np.searchsorted(row[hashed], ids), len(hashed))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(out)),
                 pa.ListArray.from_arrays(pa.array(pair_cut, pa.int32()), pa.array(pairs, pa.int64()))], ["symbols", "hashes"])


class PairCounts:
    """Counts of symbol pairs: dense tiles by address, sorted lists for the rest."""

    def __init__(self):
        self.codes: list[np.ndarray] = []
        self.waiting = 0
        self.slot = np.full((RANKS // TILE + 1) ** 2, -1, dtype=np.int8)
        self.dense: list[tuple[int, np.ndarray]] = []
        self.sparse = [np.zeros(0, np.int64), np.zeros(0, np.int64)]  # codes in order, counts
        self.hashed: list[np.ndarray] = []

    def add(self, a, b, a2, b2):
        """Take pairs; yields counts when more than a bound is held."""
        ranked = (a >= 0) & (b >= 0)
        if not ranked.all():
            rest = ~ranked
            self.hashed.append(np.stack([a[rest], b[rest], a2[rest], b2[rest]]))
            a, b = a[ranked], b[ranked]
            if sum(x.shape[1] for x in self.hashed) > BUFFER:
                yield from self._hand_on_hashed()
        self.codes.append(a << 32 | b)
        self.waiting += len(a)
        if self.waiting > BUFFER:
            self._count()
            if len(self.sparse[0]) > SPARSE:
                yield from self._hand_on_sparse()

    def _count(self) -> None:
        code = np.concatenate(self.codes) if self.codes else np.zeros(0, np.int64)
        self.codes, self.waiting = [], 0
        side = RANKS // TILE + 1
        tile = (code >> 32) // TILE * side + (code & 0xFFFFFFFF) // TILE
        held = np.bincount(tile, minlength=len(self.slot))
        for t in np.argsort(-held)[:OPEN].tolist():
            if held[t] * 16 >= TILE * TILE and self.slot[t] < 0 and len(self.dense) < OPEN:
                self.slot[t] = len(self.dense)
                self.dense.append((t, np.zeros(TILE * TILE, dtype=np.int32)))
        slot = self.slot[tile]
        for k, (_, cells) in enumerate(self.dense):
            here = code[slot == k]
            if len(here):
                cells += np.bincount(((here >> 32) % TILE) * TILE + (here & 0xFFFFFFFF) % TILE, minlength=TILE * TILE).astype(np.int32)
        rest = np.sort(code[slot < 0])
        if len(rest):
            at = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
            code = np.concatenate([self.sparse[0], rest[at]])
            n = np.concatenate([self.sparse[1], np.diff(np.append(at, len(rest)))])
            order, at = _runs(code)
            self.sparse = [code[order[at]], np.add.reduceat(n[order], at)]

    @staticmethod
    def _batch(a, b, a2, b2, n):
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, a2, b2, n)], ["a", "b", "a2", "b2", "n"])

    def _hand_on_sparse(self):
        code, n = self.sparse
        self.sparse = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for i in range(0, len(code), 1 << 16):
            c = code[i:i + (1 << 16)]
            none = np.zeros(len(c), np.int64)
            yield self._batch(c >> 32, c & 0xFFFFFFFF, none, none, n[i:i + (1 << 16)])

    def _hand_on_hashed(self):
        if self.hashed:
            x = np.concatenate(self.hashed, axis=1)
            self.hashed = []
            order, at = _runs(*x)
            yield self._batch(*x[:, order[at]], np.diff(np.append(at, len(order))))

    def finish(self):
        self._count()
        side = RANKS // TILE + 1
        for t, cells in self.dense:
            at = np.flatnonzero(cells)
            none = np.zeros(len(at), np.int64)
            yield self._batch(t // side * TILE + at // TILE, t % side * TILE + at % TILE, none, none, cells[at])
        yield from self._hand_on_sparse()
        yield from self._hand_on_hashed()


def parts(batch: pa.RecordBatch):
    """A batch of stored sequences in slices of about ``BUFFER`` symbols; every sequence ends with a break."""
    ends = np.cumsum(pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BUFFER, "right")))
        yield batch.slice(at, to - at)
        at = to


def pair_batches(batches, levels):
    """Stored sequences as counts of (phrase of len(levels) + 1 words, next word) pairs."""
    known = [Symbols(*x) for x in levels]
    counts = PairCounts()
    for batch in (part for whole in batches for part in parts(whole)):
        sym = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sym2 = np.zeros(len(sym), dtype=np.int64)
        hashed = np.flatnonzero(sym == _HASHED)
        if len(hashed):
            pairs = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
            sym[hashed], sym2[hashed] = -2 - pairs[:, 0], pairs[:, 1]
        sym[sym == _BREAK] = NONE
        head, head2, width = sym, sym2, 1  # the phrase of ``width`` words at each place
        for level in range(2, len(known) + 2):
            head, head2 = longer(head, head2, sym, sym2, width, level, known[level - 2])
            width += 1
        here = followed(head, sym, width)
        yield from counts.add(head[here], sym[here + width], head2[here], sym2[here + width])
    yield from counts.finish()


def followed(head, sym, width: int) -> np.ndarray:
    """Places where a phrase, the one a word later, and the word behind are all there."""
    n = max(len(sym) - width, 0)
    return np.flatnonzero((head[:n] != NONE) & (head[1:n + 1] != NONE) & (sym[width:] != NONE))


def longer(head, head2, sym, sym2, width: int, level: int, known: Symbols):
    """The frequent phrases of one word more at each place."""
    out, out2 = np.full(len(sym), NONE), np.zeros(len(sym), dtype=np.int64)
    here = followed(head, sym, width)
    h, h2 = pair_hashes(head[here], sym[here + width], head2[here], sym2[here + width], level)
    out[here], out2[here] = known.of(h, h2)
    return out, out2


def hash_batches(batches, level: int):
    """(a, b, a2, b2, n) with the hashes of the pair."""
    for batch in batches:
        a, b, a2, b2, _ = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        h, h2 = pair_hashes(a, b, a2, b2, level)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h.view(np.int64)), pa.array(h2.view(np.int64))],
                                         [*batch.schema.names, "h", "h2"])


def id_batches(batches, symbols):
    """Rows with hashes ``h`` and ``h2`` as the first two columns, and the symbol in their place."""
    known = Symbols(symbols[0], symbols[1], np.full(1, np.iinfo(np.uint64).max, dtype=np.uint64))
    for batch in batches:
        sym, sym2 = known.of(_u(batch.column(0).to_numpy(zero_copy_only=False)), _u(batch.column(1).to_numpy(zero_copy_only=False)))
        yield pa.RecordBatch.from_arrays([pa.array(sym), pa.array(sym2), *batch.columns], ["id", "id2", *batch.schema.names])


def ranked(frequent: DataFrame, tag: str) -> tuple[DataFrame, tuple]:
    """A round's frequent rows (h, h2, n, ...) with their symbols, and the tables that tasks need to find them."""
    names = [c for c in frequent.columns if c not in ("h", "h2")]
    top = frequent.select("h", "h2", "n").orderBy(F.desc("n"), "h", "h2").limit(RANKS).toArrow()
    head = (top["h"].to_numpy(), top["h2"].to_numpy())
    rows = frequent.select("h", "h2", *names)
    schema = "id long, id2 long, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    done = workers.keep(rows.mapInArrow(workers.task(__name__, "id_batches", symbols=head), schema), tag)
    place = F.explode(F.array(*filter_places(F.col("h"), FILTER))).alias("p")
    set_bits = done.where("id < 0").select(place).groupBy(F.shiftright("p", 6).alias("w")) \
        .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits")).toArrow()
    bits = None
    if set_bits.num_rows:
        bits = np.zeros(FILTER // 64, dtype=np.uint64)
        bits[set_bits["w"].to_numpy()] = set_bits["bits"].to_numpy().view(np.uint64)
    return done, (*head, bits)


def frequent_phrases(df: DataFrame, least: int = 100, longest: int = 5, text: str = "text",
                     lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words that occur ``least`` times in a language, and the words of each language.

    Returns (lang, k, phrase, f) and (lang, n).
    """
    rows = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                     F.col(f"`{text}`").cast("string").alias("text"))
    counted = rows.mapInArrow(workers.task(__name__, "word_batches"), "lang string, word string, h long, h2 long, n long")
    counted = workers.keep(counted.groupBy("lang", "word", "h", "h2").agg(F.sum("n").alias("n")), "words")
    sizes = workers.keep(counted.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    one, table = ranked(counted.where(F.col("n") >= least), "word-ids")
    workers.drop(counted)
    sequences = workers.keep(rows.mapInArrow(workers.task(__name__, "sequence_batches", symbols=table),
                                             "symbols array<int>, hashes array<long>"), "sequences")
    plain = one.select("id", "id2", "lang", F.col("word").alias("phrase"), "n")
    found, names, levels = [plain.select("lang", F.lit(1).alias("k"), "phrase", F.col("n").alias("f"))], plain, []
    unit = plain.select(F.col("id").alias("b"), F.col("id2").alias("b2"), F.col("phrase").alias("word"))
    for k in range(2, longest + 1):
        pairs = sequences.mapInArrow(workers.task(__name__, "pair_batches", levels=levels),
                                     "a long, b long, a2 long, b2 long, n long")
        pairs = pairs.groupBy("a", "b", "a2", "b2").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        pairs = pairs.mapInArrow(workers.task(__name__, "hash_batches", level=k),
                                 "a long, b long, a2 long, b2 long, n long, h long, h2 long")
        pairs = workers.keep(pairs, f"pairs-{k}")
        many, table = ranked(pairs, f"phrase-ids-{k}")
        levels.append(table)
        before = names.select(F.col("id").alias("a"), F.col("id2").alias("a2"), "lang", "phrase")
        names = many.join(before, ["a", "a2"]).join(unit, ["b", "b2"]).select(
            "id", "id2", "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "n")
        names = workers.keep(names, f"phrases-{k}")
        found.append(names.select("lang", F.lit(k).alias("k"), "phrase", F.col("n").alias("f")))
        workers.drop(pairs, many)
    workers.drop(sequences)
    out = found[0]
    for level in found[1:]:
        out = out.unionByName(level)
    return out, sizes


def score_batches(batches):
    """floor(1000 a n / (l r)) in whole numbers of any size."""
    for batch in batches:
        cols = [batch.column(batch.schema.names.index(c)).to_pylist() for c in ("a", "n", "l", "r")]
        score = [1000 * a * n // (x * y) for a, n, x, y in zip(*cols, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.int64())], [*batch.schema.names, "score"])


def collocations(df: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, share: int = 100,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """The best ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase inside a longer frequent one that has ``share`` percent of its
    count is left out. The score is that of the cut into two parts at which
    it is lowest.
    """
    known, sizes = frequent_phrases(df, least, longest, text, lang)
    several = known.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("ws"))
    part = lambda x, y: F.array_join(F.slice("ws", x, y), " ")
    ends = F.explode(F.array(part(F.lit(1), F.col("k") - 1), part(F.lit(2), F.col("k") - 1))).alias("phrase")
    # a longer phrase that holds it has one of the next length in between, at least as frequent
    inside = several.where("k > 2").select("lang", "a", ends).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = several.join(inside, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    cuts = free.select("lang", "phrase", "a", "k", "ws", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"),
                       part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.join(sizes, "lang").select("lang", "phrase", "a", "n", "cut", "l", "r")
    scored = cuts.mapInArrow(workers.task(__name__, "score_batches"),
                             "lang string, phrase string, a long, n long, cut int, l long, r long, score long")
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("c"))
    order = [F.desc("c.score"), F.desc("a"), "phrase"]
    # the best of each of PARTS shares of a language first, so that its last task meets PARTS * top rows at most
    share_of = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    near = share_of.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranks = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return near.withColumn("rank", ranks).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").alias("score"))
