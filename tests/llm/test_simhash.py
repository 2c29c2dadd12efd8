import random
import re

import numpy as np
import xxhash
from awkward import document_rows, documents, words

from barlake.llm import simhash
from barlake.llm.components import components


def brute_print(text, width):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    sh = [" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(nodes, linked):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in nodes}


def test_near_duplicates_equal_brute_force(spark):
    rows = document_rows()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.fp & (2 ** 64 - 1), r.component_id is None, r.component_id or 0)
                 for r in simhash.near_duplicates(documents(spark)).collect())
    prints = [brute_print(r[1], 3) for r in rows]
    distinct = sorted(set(prints))
    roots = brute_roots(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 3])
    least = {}
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            least[roots[p]] = min(least.get(roots[p], 1 << 62), r[0])
    want = sorted((r[0] is None, r[0] or 0, p, least.get(roots[p]) is None, least.get(roots[p]) or 0)
                  for r, p in zip(rows, prints, strict=True))
    assert got == want


def test_links_find_every_pair_within_the_radius(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base:  # neighbours at all distances, and chains
        for d in range(1, 6):
            x = b
            for bit in rng.sample(range(64), d):
                x ^= 1 << bit
            fps.add(x)
    centre = rng.getrandbits(64)  # one crowd
    fps |= {centre ^ (1 << i) ^ (1 << j) for i in range(0, 24) for j in range(0, 24)}
    signed = [(int(np.uint64(x).view(np.int64)),) for x in fps]
    for radius in (0, 2, 3):
        edges = simhash.links(spark.createDataFrame(signed, "fp long"), radius)
        got = {r.node: r.root for r in components(edges).collect()}
        pairs = [(a[0], b[0]) for i, a in enumerate(signed) for b in signed[:i] if ((a[0] ^ b[0]) & (2 ** 64 - 1)).bit_count() <= radius]
        want = brute_roots([x[0] for x in signed], pairs)
        assert {x: got.get(x, x) for x in want} == want


def test_components_of_long_paths_stars_and_nothing(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 1200)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (7, 6), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_keeps_a_row_of_each_group(spark):
    docs = documents(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    marked = simhash.near_duplicates(docs)
    groups = {r.component_id for r in marked.collect()}
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert {i for i in ids if i is not None} == groups - {None}
    # the two texts that call themselves 3 are far apart: two groups
    assert len([i for i in ids if i is not None]) == len(groups - {None}) + 1
    assert ids.count(None) == 0 or None in groups
    assert simhash.keep_one(documents(spark, [])).count() == 0
    alone = simhash.keep_one(documents(spark, [(None, "a b c d", None, None, None), (None, "e f g h i", None, None, None)]))
    assert alone.count() == 2
