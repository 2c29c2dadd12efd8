import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from awkward import document_rows, documents
from tokenizers import Tokenizer

from barlake.llm import packing
from barlake.llm.queries import vocabulary


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(pieces, rows, library, window):
    """Every id of every row in exactly one piece, sequences gapless, no token of padding."""
    want = defaultdict(Counter)
    for doc_id, text, *_ in rows:
        ids = ids_of(library, text)
        want[doc_id, len(ids)][ids.tobytes()] += 1
    got = defaultdict(list)
    for p in pieces:
        assert p.length > 0
        got[p.doc_id, p.doc_tokens].append(p)
    assert set(got) == set(want)
    for key, texts in want.items():
        expected = Counter()
        starts = Counter()
        for p in got[key]:
            starts[p.start] += 1
            fits = [ids for ids in texts if zlib.crc32(ids[4 * p.start:4 * (p.start + p.length)]) == p.ids_crc32]
            assert fits, "a piece whose ids are no part of its document"
            expected[p.start, p.length] += 1
        total = sum(p.length for p in got[key])
        assert total == key[1] * sum(texts.values())
        if sum(texts.values()) == 1:
            at = 0
            for p in sorted(got[key], key=lambda p: p.start):
                assert p.start == at
                at += p.length
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    return sequences


@pytest.mark.parametrize("shard", [7, 1024])
def test_every_id_in_one_piece_and_no_padding(spark, library, shard):
    rows = document_rows()
    pieces = packing.packed(documents(spark, rows), vocabulary(), window=256, shard=shard).collect()
    check(pieces, rows, library, 256)


def test_production_window_and_empty_table(spark, library):
    rows = document_rows()
    sequences = check(packing.packed(documents(spark, rows), vocabulary()).collect(), rows, library, 2048)
    assert sum(sum(n for _, n in s) == 2048 for s in sequences.values()) >= 8
    assert packing.packed(documents(spark, []), vocabulary()).count() == 0


def test_bm25_equals_the_formula():
    rng = np.random.default_rng(4)
    items = [rng.zipf(1.4, rng.integers(1, 60)).clip(0, 99).astype("<u2") for _ in range(40)]
    idf = rng.random(100)
    mean = 20.0
    index = packing.Shard(pa.array([x.tobytes() for x in items], pa.binary()), "<u2", idf, mean)
    for q in range(40):
        want = [sum(idf[t] * (d == t).sum() * 2.2 / ((d == t).sum() + 1.2 * (0.25 + 0.75 * len(d) / mean))
                    for t in np.unique(items[q]) if (d == t).any()) for d in items]
        assert np.allclose(index.scores(q), want, rtol=1e-5)


def test_windows_hold_the_best_unused_neighbours():
    """Two topics, interleaved: no window mixes them, but the one that the first topic leaves open."""
    rng = np.random.default_rng(6)
    items = [(rng.integers(0, 50, 32) + 50 * (i % 2)).astype("<u2") for i in range(64)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(64)), "start": [0] * 64, "doc_tokens": [32] * 64,
                                        "ids": pa.array([x.tobytes() for x in items], pa.binary())})
    packer = packing.Packer(128, 0)
    packing.fill(packer, batch, "<u2", np.ones(100), 32.0)
    packer.finish()
    topics = defaultdict(set)
    for doc_id, *_, sequence, _ in packer.out:
        topics[sequence].add(doc_id % 2)
    assert sum(len(t) == 1 for t in topics.values()) == len(topics) == 16


def test_hot_token_spreads_over_tasks(spark):
    """A third of all rows are copies: their shards lie in several tasks."""
    rows = [(i, "copies of one text stand here" if i % 3 == 0 else f"text number {i} of many {i * 7}", "en", "a", 0) for i in range(3_000)]
    pieces = packing.packed(documents(spark, rows), vocabulary(), window=64, shard=100).collect()
    tasks = Counter(p.sequence_id >> 36 for p in pieces)
    assert len(tasks) >= 3 and max(tasks.values()) < 2_200
    assert sum(p.length for p in pieces) == sum({p.doc_id: p.doc_tokens for p in pieces}.values())
