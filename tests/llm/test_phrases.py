import re
from collections import Counter

import numpy as np
import pytest
from awkward import document_rows, documents

from barlake.llm import phrases


def brute(rows, least, longest, top, share=100):
    """lang, rank, phrase, a, l, r, n, score by counting every phrase in Python."""
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i:i + k])] += 1
    several = {x: c for x, c in f.items() if len(x[1]) > 1 and c >= least}
    held = set()
    for (lang, p), c in several.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p) and 100 * c >= share * f[lang, p[i:j]]:
                    held.add((lang, p[i:j]))
    out = {}
    for (lang, p), a in several.items():
        if (lang, p) not in held:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0])
                  for lang, found in out.items() for i, x in enumerate(sorted(found)[:top]))


def text_rows():
    """Frequent words and phrases over two languages, breaks, upper case, repeats."""
    rng = np.random.default_rng(5)
    common = ["the", "of", "To", "a,", "in", "é", "Éa", "new", "york.", "city", "x\x85y", "\U0001F600"]
    rows = []
    for i in range(300):
        ws = rng.choice(common, 40, p=np.arange(12, 0, -1) / 78).tolist()
        ws += ["as a matter of fact", "new york city", f"w{i}"] * int(rng.integers(0, 3))
        rows.append((i, "\t".join(ws[:20]) + "\n" + " ".join(ws[20:]), ["en", "de", None, "und"][i % 4], "a", 0))
    return rows


@pytest.mark.parametrize(("ranks", "least", "share"), [(1 << 18, 5, 100), (4, 5, 100), (4, 3, 60)])
def test_equals_brute_force_whatever_has_a_rank(spark, monkeypatch, ranks, least, share):
    """With four ranks nearly all words and phrases go by their hashes."""
    monkeypatch.setattr(phrases, "RANKS", ranks)
    rows = document_rows() + text_rows()
    got = phrases.collocations(documents(spark, rows), least=least, longest=5, top=200, share=share)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, 5, 200, share)


def test_awkward_and_empty_tables(spark):
    rows = document_rows()
    assert sorted(map(tuple, phrases.collocations(documents(spark, rows), least=2, longest=4, top=10_000).collect())) == brute(rows, 2, 4, 10_000)
    assert phrases.collocations(documents(spark, [])).count() == 0
    none = [(1, None, None, None, None), (2, "", "en", None, None), (3, " .,;", "en", None, None)]
    assert phrases.collocations(documents(spark, none), least=1).count() == 0


def test_pair_counts_dense_sparse_and_hashed(monkeypatch):
    monkeypatch.setattr(phrases, "BUFFER", 5_000)
    monkeypatch.setattr(phrases, "SPARSE", 2_000)
    monkeypatch.setattr(phrases, "TILE", 16)
    rng = np.random.default_rng(1)
    counts, want, got, batches = phrases.PairCounts(), Counter(), Counter(), []
    for _ in range(20):
        a, b = np.minimum(rng.zipf(1.3, 3_000), 200) - 1, np.minimum(rng.zipf(1.3, 3_000), 200) - 1
        a, b = np.where(rng.random(3_000) < 0.1, -5 - a, a), b.astype(np.int64)
        a2 = np.where(a < 0, 7 + a, 0)
        want.update(zip(a.tolist(), b.tolist(), a2.tolist(), strict=True))
        batches += list(counts.add(a, b, a2, np.zeros_like(a)))
    assert counts.dense
    for batch in [*batches, *counts.finish()]:
        for a, b, a2, _, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got[a, b, a2] += n
    assert got == want


def test_scores_beyond_64_bits():
    import pyarrow as pa
    big = 1 << 60
    batch = pa.RecordBatch.from_pydict({"a": [big, 3], "n": [big, 10], "l": [big, 7], "r": [big, 2]})
    assert next(iter(phrases.score_batches([batch]))).column(4).to_pylist() == [1000, 2142]
