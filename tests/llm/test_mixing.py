from collections import defaultdict

from awkward import document_rows, documents, words

from barlake.llm import mixing


def brute_targets(rows, weights, share, cap=2):
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(words(r[1]))
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = share * sum(size.values()), set()
    while True:
        free = sum(weight[s] for s in order if s not in full)
        level = (budget - sum(cap * size[s] for s in full)) / free if free else 0
        new = {s for s in order if s not in full and weight[s] * level > cap * size[s]}
        if not new:
            return {s: float(cap * size[s]) if s in full else weight[s] * level for s in order}, size
        full |= new


def check(rows, got, weights=(3, 1, 2), share=1.5, near=0.02):
    target, size = brute_targets(rows, weights, share)
    taken = defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) <= 1e-6 * max(1, target[r.source])
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    assert sorted(r.size for r in got) == sorted(len(words(r[1])) for r in rows)
    due = defaultdict(float)
    for r in got:
        due[r.source] += r.rate * r.size
    for s in target:
        assert abs(due[s] - target[s]) <= 1e-6 * max(1, target[s])  # the dual is solved
        if size[s] > 5000 and len([r for r in got if r.source == s]) > 20:
            assert abs(taken[s] - target[s]) <= near * target[s]


def many(n=1500):
    return [(i, "w " * (1 + (i * 7919) % 300), "en", f"s{i % 7}" if i % 3 else "hot", None) for i in range(n)]


def test_targets_rates_and_copies(spark):
    rows = many()
    first = mixing.mix_report(documents(spark, rows)).collect()
    check(rows, first, near=0.002)
    again = mixing.mix_report(documents(spark, rows[::-1])).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)


def test_awkward_documents(spark):
    docs = documents(spark)
    got = mixing.mix_report(docs).collect()
    check(document_rows(), got)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in got)
    assert mixing.mix_report(documents(spark, [])).count() == 0 and mixing.mixed(documents(spark, [])).count() == 0
    empty = [(1, "", "en", "a", 0), (2, None, "en", None, 0)]
    assert [(r.target, r.taken) for r in mixing.mix_report(documents(spark, empty)).collect()] == [(0.0, 0), (0.0, 0)]


def test_all_sources_at_the_cap(spark):
    rows = many(200)
    got = mixing.mix_report(documents(spark, rows), share=2.0).collect()
    assert all(r.copies == 2 for r in got)


def test_ranks_over_two_thousand_partitions(spark):
    dealt = spark.range(6_000).selectExpr("cast(id % 2000 as int) as part")
    got = {r.part: r.before for r in dealt.join(mixing.starts(dealt), "part").distinct().collect()}
    assert got == {p: 3 * p for p in range(2_000)}
