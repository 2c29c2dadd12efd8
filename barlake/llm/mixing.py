"""Operator 1: mixing sources to target weights by entropy balancing.

Every document gets a rate r in [0, 2]. The rates are those nearest to 1 in
relative entropy, sum of r ln r - r + 1, for which each source's words come to
its target. The solution tilts exponentially, r = min(2, exp(a * size)), with
one dual variable a for each source; its convex dual is solved by Newton
steps on ln(words) - ln(target), kept inside a shrinking bracket. A step is an
aggregation over (source, size) counts joined to the sources' state, so
documents are read once and no source meets in one task. Sums are decimals:
the order in which partitions arrive does not change a digit, and reruns agree.

Rounding: documents of a source are dealt by hash into groups of about
``GROUP``; within a group, largest first, the copies (0, 1 or 2) are those
that bring the words taken so far nearest to the words due so far, so the
error left is about one small document for each group.

Defined cases: null text has size 0 and takes no words; a source without words
has target 0; null is a source of its own and stands last; rows that agree in
doc_id, source and text are treated alike (same copies for each); an empty
table gives an empty result; other columns are carried by ``mixed`` as they are.
"""

from __future__ import annotations

import warnings

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm import workers

CAP = 2
GROUP = 1000
ROUNDS = 40  # of two Newton steps each; a handful is needed
CLOSE = 1e-9
WORD = r"[^\x20\x09-\x0D]+"


def _source_key(c):
    """Orders like the source by code point, null last, and is never null."""
    return F.coalesce(F.concat(F.lit("s"), c.cast("string")), F.lit("t"))


def _units(docs: DataFrame) -> DataFrame:
    """One row for each (doc_id, source, text): its size in words and how many rows have it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _source_key(F.col("source")).alias("skey"),
                       F.xxhash64(F.col("text").cast("string")).alias("digest"),
                       F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return rows.groupBy("doc_id", "skey", "digest", "size").agg(F.count("*").alias("n"))


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with their rank by key, from counts of range partitions."""
    spark = sources.sparkSession
    parts = workers.tasks_for(spark)
    dealt = workers.keep(sources.repartitionByRange(parts, "skey").withColumn("part", F.spark_partition_id()), "sources")
    return dealt.join(starts(dealt), "part").withColumn(
        "rank", F.row_number().over(Window.partitionBy("part").orderBy("skey")) - 1 + F.col("before")).drop("part", "before")


def starts(dealt: DataFrame) -> DataFrame:
    """(part, before): the rows in all partitions before each; a row for each partition, however many rows they have."""
    counts = sorted((r["part"], r["count"]) for r in dealt.groupBy("part").count().collect())
    before, total = [], 0
    for part, n in counts:
        before.append((part, total))
        total += n
    return dealt.sparkSession.createDataFrame(before, "part int, before long")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, cap: float = CAP) -> DataFrame:
    """``sources`` (skey, source_size, docs) with weight and target.

    Targets share ``share`` times all words by weight; one that would pass
    ``cap`` times its source's words stops there and the rest is shared anew.
    """
    ranked = workers.keep(_ranked(sources).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("rank") % len(weights) + 1).cast("int"))), "ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, None
    while True:  # each round stops at least one more source; in practice two or three rounds
        full = F.lit(False) if stopped is None else F.col("weight") * level >= cap * F.col("source_size")
        free, held, n = ranked.agg(F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, cap * F.col("source_size"))),
                                   F.count(F.when(full, 1))).first()
        if n == stopped or not free:
            break
        level, stopped = (share * total - (held or 0)) / free, n
    if not free:
        level = float("inf")
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(level), cap * F.col("source_size").cast("double"))) \
        .withColumn("full", F.col("target") >= cap * F.col("source_size"))


def _rate(a, x):
    return F.least(F.lit(float(CAP)), F.exp(a * x))


def _step(hist: DataFrame, state: DataFrame) -> DataFrame:
    """One safeguarded Newton step for every source."""
    x, words = F.col("size") / F.col("scale"), F.col("n") * F.col("size")
    rate = _rate(F.col("a"), x)
    exact = lambda c: F.sum(c.cast("decimal(38,12)")).cast("double")
    sums = hist.join(state.select("skey", "a", "scale"), "skey").groupBy("skey").agg(
        exact(words * rate).alias("got"), exact(F.when(rate < CAP, words * rate * x).otherwise(0.0)).alias("slope"))
    both = state.drop("err").join(sums, "skey").withColumn("err", F.log(F.col("got") / F.col("target")))
    lo = F.when(F.col("err") < 0, F.col("a")).otherwise(F.col("lo"))
    hi = F.when(F.col("err") > 0, F.col("a")).otherwise(F.col("hi"))
    newton = F.col("a") - F.col("err") * F.col("got") / F.when(F.col("slope") > 0, F.col("slope"))
    inside = (newton > lo) & (newton < hi)
    a = F.when(F.abs("err") <= CLOSE, F.col("a")).when(inside, newton).otherwise((lo + hi) / 2)
    return both.select("skey", a.alias("a"), lo.alias("lo"), hi.alias("hi"), "scale", "target", "err")


def tilts(hist: DataFrame, sources: DataFrame) -> DataFrame:
    """(skey, a, scale) for the sources whose target lies below the cap, from (skey, size, n) counts."""
    shape = hist.groupBy("skey").agg((F.sum(F.col("n") * F.col("size") * F.col("size")) / F.sum(F.col("n") * F.col("size")))
                                     .alias("scale"), F.min("size").alias("least"))
    state = sources.filter("not full and target > 0").select("skey", "target", "source_size").join(shape, "skey")
    edge = F.col("least") / F.col("scale")
    down = F.log(F.col("target") / F.col("source_size")) / edge
    state = workers.keep(state.select(
        "skey", F.lit(0.0).alias("a"), F.least(down, F.lit(0.0)).alias("lo"),
        F.when(down < 0, 0.0).otherwise(F.log(F.lit(float(CAP))) / edge).alias("hi"), "scale", "target",
        F.lit(1.0).alias("err")), "state")
    for _ in range(ROUNDS):
        last, state = state, workers.keep(_step(hist, _step(hist, state)), "state")
        workers.drop(last)
        worst = state.agg(F.max(F.when(F.col("hi") - F.col("lo") > 1e-14, F.abs("err")))).first()[0]
        if worst is None or worst <= CLOSE:
            break
    else:
        warnings.warn(f"the rates have not settled: a source is {worst:.1e} off its target", RuntimeWarning, stacklevel=2)
    return state.select("skey", "a", "scale")


def round_group(table: pa.Table) -> pa.Table:
    """Copies of one group's rows: largest first, what is taken follows what is due."""
    import numpy as np
    t = table.sort_by([("size", "descending"), ("tie", "ascending")])
    size, n, rate = (t[c].to_numpy() for c in ("size", "n", "rate"))
    copies, lag = np.zeros(len(size), dtype=np.int32), 0.0
    for i in range(len(size)):
        words = float(size[i] * n[i])
        if words:
            lag += words * rate[i]
            copies[i] = min(CAP, max(0, int(lag / words + 0.5)))
            lag -= words * copies[i]
    return t.append_column("copies", pa.array(copies))


def balance(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """One row for each (doc_id, skey, digest): size, rows n, source_size, target, rate and copies."""
    units = workers.keep(_units(docs), "units")
    sources = units.groupBy("skey").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.count("*").alias("docs"))
    sources = workers.keep(targets(sources, weights, share), "targets")
    hist = workers.keep(units.filter("size > 0").groupBy("skey", "size").agg(F.sum("n").alias("n")), "counts")
    known = sources.join(tilts(hist, sources), "skey", "left")
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("full"), float(CAP)) \
        .otherwise(F.coalesce(_rate(F.col("a"), F.col("size") / F.col("scale")), F.lit(0.0)))
    tie = F.xxhash64("doc_id", "digest", F.lit(1))
    group = F.pmod(F.xxhash64("digest", "doc_id"), F.ceil(F.col("docs") / GROUP).cast("long"))
    rated = units.join(known, "skey").select("doc_id", "skey", "digest", "size", "n", "source_size", "target",
                                             rate.alias("rate"), tie.alias("tie"), group.alias("part"))
    schema = rated.select("*", F.lit(0).alias("copies")).schema
    # dealt by group: the join leaves a source's rows together, and its groups need not be
    done = rated.repartition("skey", "part").groupBy("skey", "part").applyInArrow(workers.task(__name__, "round_group"), schema)
    copies = workers.keep(done.drop("tie", "part"), "copies")
    workers.drop(units, sources, hist)
    return copies


def mix_report(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """For every row of ``docs``: doc_id, source, size, source_size, target, rate, copies, taken."""
    got = balance(docs, weights, share)
    return got.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select(
        "doc_id", F.when(F.col("skey") != "t", F.substring("skey", 2, 1 << 30)).alias("source"), "size", "source_size",
        "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    got = balance(docs, weights, share).filter("copies > 0").select("doc_id", "skey", "digest", "copies")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), _source_key(F.col("source")).alias("sk"),
                       F.xxhash64(F.col("text").cast("string")).alias("mark"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = rows.join(got, rows.id.eqNullSafe(got.doc_id) & (rows.sk == got.skey) & (rows.mark == got.digest))
    return taken.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("copies")))) \
        .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
