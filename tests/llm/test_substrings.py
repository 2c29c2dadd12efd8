import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from awkward import document_rows, documents, sentence, words

from barlake.llm import substrings
from barlake.llm import words as wordpieces
from barlake.llm.fmindex import FMIndex, window_intervals


def brute(rows, width):
    first = {}
    for r in rows:
        w = words(r[1])
        for i in range(len(w) - width + 1):
            if r[0] is not None:
                k = tuple(w[i:i + width])
                first[k] = min(first.get(k, r[0]), r[0])
    out = []
    for r in rows:
        w, gone = words(r[1]), set()
        for i in range(len(w) - width + 1):
            if r[0] is not None and first[tuple(w[i:i + width])] < r[0]:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def report(docs, width):
    return sorted(map(tuple, substrings.removal_report(docs, width).collect()), key=str)


def hot_rows():
    """One passage in very many documents, whole and in parts, each time among other words."""
    p = sentence(50, 40).split()
    return [(i, " ".join([sentence(900 + i, 9), *p[i % 13:i % 13 + 8 + i % 20], sentence(2900 + i, 9)]), "en", "a", 0) for i in range(400)]


@pytest.mark.parametrize("width", [13, 3])
def test_report_equals_brute_force(spark, width):
    assert report(documents(spark), width) == brute(document_rows(), width)


def test_frequent_anchors(spark, monkeypatch):
    monkeypatch.setattr(substrings, "FREQUENT", 20)
    assert report(documents(spark, hot_rows()), 13) == brute(hot_rows(), 13)


def test_texts_and_columns(spark):
    docs = documents(spark)
    got = substrings.without_repeats(docs)
    assert got.columns == docs.columns and dict(got.dtypes) == dict(docs.dtypes)
    want = {x for x in brute(document_rows(), 13)}
    for r in got.collect():
        w = words(r.text)
        if (r.doc_id, len(w), 0, hashlib.sha256(" ".join(w).encode()).hexdigest()) not in want:
            kept = hashlib.sha256((r.text or "").encode()).hexdigest()
            assert any(x[0] == r.doc_id and x[2] and x[3] == kept for x in want) and r.n_chars == len(r.text)
    assert got.count() == len(document_rows())
    assert substrings.removal_report(documents(spark, [])).count() == 0
    assert substrings.without_repeats(documents(spark, [])).count() == 0


def test_backward_search_finds_every_occurrence():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 40, 60)
    symbols = rng.integers(1, 4, int(lengths.sum()))
    for depth in (2, 5, 13):
        index = FMIndex(symbols, lengths, depth)
        cuts = np.split(symbols, np.cumsum(lengths)[:-1])
        streams = [rng.integers(1, 5, n) for n in (30, 7, 1)] + cuts[:20]
        seq, at, lo, hi = window_intervals(index, np.concatenate([np.minimum(s, index.sigma - 1) for s in streams]),
                                           np.array([len(s) for s in streams]))
        got = {(s, a): h - b for s, a, b, h in zip(seq.tolist(), at.tolist(), lo.tolist(), hi.tolist(), strict=True)}
        for s, stream in enumerate(streams):
            stream = np.minimum(stream, index.sigma - 1).tolist()
            for a in range(len(stream) - depth + 1):
                p = stream[a:a + depth]
                n = sum(c[i:i + depth].tolist() == p for c in cuts for i in range(len(c) - depth + 1))
                assert got.get((s, a), 0) == n


def test_a_batch_takes_little_memory():
    """Reused workers keep their peak: batches of any size are worked on in slices."""
    texts = pa.array([f"{i} " + sentence(i % 50, 300) for i in range(9000)], pa.string())
    ids, marks = pa.array(np.arange(len(texts))), pa.array(np.zeros(len(texts), dtype=np.int32))
    starts = pa.array([[0]] * len(texts), pa.list_(pa.int32()))
    tracemalloc.start()
    for _ in substrings.anchor_batches([pa.RecordBatch.from_arrays([ids, marks, texts], ["doc_id", "mark", "text"])], 13):
        pass
    assert tracemalloc.get_traced_memory()[1] < 70e6
    tracemalloc.reset_peak()
    done = 0
    for out in substrings.text_batches([pa.RecordBatch.from_arrays([ids, texts, starts], ["row", "text", "starts"])], 13):
        assert out.nbytes < 3e6 and out.column(1)[0].as_py() == " ".join(texts[done].as_py().split()[13:])
        done += out.num_rows
    assert done == len(texts) and tracemalloc.get_traced_memory()[1] < 20e6
    tracemalloc.stop()
    assert sum(a.nbytes for both in wordpieces._pow.values() for a in both) < 10e6
