import collections
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from awkward import document_rows, documents, sentence, words

from barlake.llm import classifier, outliers
from barlake.llm.queries import op8_outliers, op9_quality

FOLDER = "/root/testdata/sf0.1"


def brute_stats(text):
    t, w = text or "", words(text)
    grams = list(zip(w, w[1:], w[2:], strict=False))
    often = collections.Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_text_statistics(spark):
    got = outliers.quality_outliers(documents(spark)).collect()
    stats = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert stats == sorted((str(r[0]), *brute_stats(r[1])) for r in document_rows())
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept is False if r.base_failed else isinstance(r.kept, bool)
    assert outliers.quality_outliers(documents(spark, [])).count() == 0


def test_plan_is_native(spark, capsys):
    outliers.text_statistics(documents(spark)).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_outliers_against_numpy_and_planted_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(a), float(b), "g" if i % 2 else None) for i, (a, b) in
            enumerate(rng.multivariate_normal([3, 1], [[1, 0.6], [0.6, 1]], 600))]
    rows += [(1000 + i, 12.0 + i, -9.0, "g") for i in range(40)] + [(2000, None, float("nan"), "one")]
    df = spark.createDataFrame(rows, "doc_id long, x double, y double, grp string")
    got = outliers.outlier_distances(df, ["x", "y"], ["grp"], [0.01, 0.01], shrink=0.61).collect()
    d2 = {r.doc_id: r.d2 for r in got}
    assert len(d2) == len(rows) and all(d2[1000 + i] > 60 for i in range(40))
    assert np.quantile([d2[i] for i in range(600)], 0.99) < 30
    inner = np.array([[r[1], r[2]] for r in rows[1:600:2]])
    exact = np.einsum("ij,jk,ik->i", inner - inner.mean(0), np.linalg.inv(np.cov(inner.T)), inner - inner.mean(0))
    assert np.corrcoef(exact, [d2[r[0]] for r in rows[1:600:2]])[0, 1] > 0.9


def test_clean_documents_are_kept_and_junk_goes(spark):
    got = op8_outliers(spark, FOLDER).toPandas().merge(pq.read_table(f"{FOLDER}/labels.parquet").to_pandas(), on="doc_id")
    passed = got[~got.base_failed]
    assert passed[passed.quality == 1].kept.mean() > 0.995
    assert passed[passed.quality == 0].kept.mean() < 0.5


def test_held_out_accuracy(spark):
    got = op9_quality(spark, FOLDER).toPandas().merge(pq.read_table(f"{FOLDER}/labels.parquet").to_pandas(), on="doc_id")
    held = got[got.held_out]
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in zip(got.doc_id, got.held_out, strict=True))
    assert (held.predicted == held.quality).mean() > 0.97
    assert held[held.quality == 1].predicted.mean() > 0.99


def test_scores_by_the_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    m = classifier.Machine(dims=30, dense=3, rank=4)
    m.w, m.v, m.w0 = rng.normal(size=33), rng.normal(size=(33, 4)), 0.3
    cols, value, first, dense = np.array([1, 5, 9, 2]), rng.normal(size=4), np.array([0, 3, 3, 4]), rng.normal(size=(3, 3))
    for k, z in enumerate(m.raw(cols, value, first, dense)[0]):
        x = np.zeros(33)
        x[cols[first[k]:first[k + 1]]] = value[first[k]:first[k + 1]]
        x[30:] = dense[k]
        pairs = sum(m.v[i] @ m.v[j] * x[i] * x[j] for i in range(33) for j in range(i))
        assert abs(z - (0.3 + m.w @ x + pairs)) < 1e-9


def test_awkward_documents_and_labels(spark):
    docs = documents(spark, document_rows() + [(200 + i, ("### | " * 40) + sentence(i, 20), "en", "a", 0) for i in range(40)])
    labels = spark.createDataFrame([(i, 1, "x") for i in range(1, 70)] + [(200 + i, 0, "x") for i in range(40)]
                                   + [(None, 1, "x"), (3, None, "x"), (3, 0, "x"), (9999, 1, "x")], "doc_id long, quality int, row string")
    first = classifier.scored(docs, classifier.train(docs, labels), columns=["doc_id"])
    got = [(r.row.doc_id, r.score) for r in first.collect()]
    assert len(got) == docs.count() and all(0 <= s <= 1 for _, s in got)
    again = classifier.scored(docs, classifier.train(docs.repartition(7), labels.repartition(5)), columns=["doc_id"])
    assert sorted(got, key=str) == sorted(((r.row.doc_id, r.score) for r in again.collect()), key=str)
    kept = classifier.keep_good(docs, labels)
    assert kept.columns == docs.columns and not {r.doc_id for r in kept.collect()} & set(range(200, 240))
    none = classifier.train(docs, labels.limit(0))
    assert {round(r.score, 6) for r in classifier.scored(docs, none, columns=["doc_id"]).collect()} == {0.5}
    assert classifier.keep_good(documents(spark, []), labels).count() == 0


def test_a_batch_is_scored_in_little_memory(spark):
    """A batch of many texts, and one long text, take a small multiple of a slice; ``keep_good`` sends a text once."""
    texts = [f"{i} " + sentence(i % 50, 300) for i in range(9000)]
    assert sum(map(len, texts)) > 10_000_000

    class Model:
        value = classifier.Machine()

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["row", "text"])
    list(classifier.score_batches([batch.slice(0, 500)], Model))  # tables that a worker keeps
    tracemalloc.start()
    rows = sum(out.num_rows for out in classifier.score_batches([batch], Model))
    many = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    buf = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    kinds = classifier._kinds(buf, np.array([0, 0, len(buf), len(buf)]))
    one = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and many < 100e6 and one < 100e6
    assert not kinds[[0, 2]].any() and kinds[1].tolist() == np.bincount(classifier._KIND[buf], minlength=classifier.KINDS).tolist()
    kept = classifier.scored(documents(spark), classifier.Machine(), keep_from=0.0)
    sent = kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count() == documents(spark).count() and "AS text#" not in sent.split("MapInArrow", 1)[1].split("Project", 2)[1]


def test_slices_change_no_feature(monkeypatch):
    column = pa.array([r[1] for r in document_rows()], pa.string())
    got = {}
    for size in (1 << 24, 1 << 20, 1000, 7):
        monkeypatch.setattr(classifier, "SLICE", size)
        got[size] = [(cols[first[i]:first[i + 1]].tolist(), value[first[i]:first[i + 1]].tolist(), dense[i].tolist())
                     for cols, value, first, dense in classifier.features(column) for i in range(len(first) - 1)]
    assert len(got[7]) == len(column) and all(rows == got[7] for rows in got.values())


def test_each_statistic_alone_makes_an_outlier(spark):
    rng = random.Random(3)

    def prose(n):
        return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n)]
    usual = [(i, " ".join(prose(rng.randint(100, 400)))) for i in range(300)]
    short = prose(12)
    lines = [line for i in range(90) for line in (" ".join(prose(8)), *rng.choices(short, k=3))]
    odd = {1000: " ".join(prose(40_000)),  # length
           1001: " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(200)),  # letter by letter
           1002: " ".join(w + "#" * (i % 2) for i, w in enumerate(prose(250))),  # symbols
           1003: "\n".join(lines),  # short lines repeated between others
           1004: " ".join(prose(130) + (run := prose(45)) + prose(5) + run)}  # repeated words, within the base rule
    docs = documents(spark, [(i, t, "en", "a", None) for i, t in [*usual, *odd.items()]])
    got = {r.doc_id: r for r in outliers.quality_outliers(docs).collect()}
    assert not any(got[i].base_failed for i in odd) and not any(got[i].kept for i in odd), {i: got[i].d2 for i in odd}
    assert sum(got[i].kept for i, _ in usual) >= 297
