"""Operator 8: robust multivariate outliers by minimum covariance determinant, in DataFrame functions only.

Text statistics are worked out row by row. For each (language, source) group
the method looks for the share ``half`` of rows whose covariance has the least
determinant: from two starts (medians with median deviations; plain mean and
covariance) concentration steps keep the rows nearest to the current centre
and estimate anew until no determinant changes, and the start that ends with the smaller determinant wins.
A row is an outlier if its squared Mahalanobis distance exceeds the cutoff,
the 97.5 % point of chi-square for the number of statistics.

Scale: groups are only ever aggregated (partial sums of values and products,
mergeable quantile sketches), so a hot group meets in no task; what is joined
back is one row per group. The covariance gets two additions: ``floors``, the
spread below which a statistic's differences do not matter (many statistics
are exactly 0 in most rows, which would make the determinant 0; each is small
enough that its statistic alone can exceed the cutoff), and a pull
of ``PRIOR`` rows towards the estimate over all groups, for small groups.

Defined cases: null text counts as empty; null language or source is a group
of its own; a statistic that is null or not finite counts as 0; an empty
table gives an empty result; repeated rows each get the same verdict; the
input's other columns are not looked at.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm import workers

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
PRIOR = 30.0
STEPS = 12  # at most; a step that changes no log determinant by SETTLED is the last
SETTLED = 0.01
HALF = 0.75
SALTS = 32  # parts of a group's rows when they meet its estimate
#: Rows of a normal sample within its nearest 75 % have a covariance smaller by this factor (5 statistics).
SHRINK = 0.708
#: 97.5 % point of chi-square with 5 degrees of freedom.
CUTOFF = 12.833
FEATURES = ["f_len", "f_word", "f_sym", "f_dup", "f_rep"]
FLOORS = [0.5, 0.3, 0.35, 0.22, 0.16]


def _let(value: Column, body) -> Column:
    """``body`` over ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, each word once.

    Windows are compared by a 64-bit hash of their words. Sorting (hash,
    position) pairs brings equal windows together; the sorted positions of
    those then each add the words that the position before did not cover.
    """
    n = F.size(words)
    hashed = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(
        F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)))

    def covered(h):
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = _let(pairs, lambda s: F.flatten(F.zip_with(
            F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-9).alias("last"))
        return F.aggregate(F.array_sort(F.array_distinct(same)), start, lambda acc, x: F.struct(
            (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"), x.alias("last")))["n"]

    return F.when(n < 4, F.lit(0).cast("long")).otherwise(_let(hashed, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))))


def text_statistics(df: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The carried columns and each text's n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (long)."""
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    base = df.select(*[F.col(f"`{c}`").alias(c) for c in carry], t.alias("t"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.filter(F.split("t", SPACES, -1), lambda x: x != "")
    measured = _let(F.struct(words.alias("w"), lines.alias("l")), lambda s: F.struct(
        F.size(s["w"]).cast("long").alias("n_words"),
        (F.size(s["l"]) - F.size(F.array_distinct(s["l"]))).cast("long").alias("n_dup_lines"),
        F.size(s["l"]).cast("long").alias("n_lines"),
        repeated_words(s["w"]).alias("n_repeat_words")))
    return base.select(*carry, measured.alias("m"),
                       F.length(F.regexp_replace("t", SPACES, "")).cast("long").alias("word_chars"),
                       (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols")) \
        .select(*carry, "m.n_words", "word_chars", "n_symbols", "m.n_dup_lines", "m.n_repeat_words", "m.n_lines")


def with_features(stats: DataFrame) -> DataFrame:
    """The transformed statistics: logarithms of counts, square roots of shares."""
    some = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return stats.withColumns({
        "f_len": F.log1p(F.col("n_words").cast("double")),
        "f_word": F.log1p(F.col("word_chars") / some) * 3,
        "f_sym": F.log1p(20 * F.col("n_symbols") / some),
        "f_dup": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)).cast("double")),
        "f_rep": F.sqrt(F.col("n_repeat_words") / some),
    })


def _moments(rows: DataFrame, keys: list[str], xs: list[str]) -> DataFrame:
    """Count, means and covariances (columns n, m_i, c_i_j) of each group."""
    p = range(len(xs))
    x = [F.col(c) for c in xs]
    aggs = [F.count("*").cast("double").alias("n"), *[F.avg(x[i]).alias(f"m_{i}") for i in p],
            *[F.covar_pop(x[i], x[j]).alias(f"c_{i}_{j}") for i in p for j in range(i + 1)]]
    return rows.groupBy(*keys).agg(*aggs)


def _settled(est: DataFrame, pooled: DataFrame, floors: list[float], scale: float) -> DataFrame:
    """Pull towards the pooled estimate, add the floors, and factor: columns m_i, l_i_j and logdet."""
    p = range(len(floors))
    w = F.col("n") / (F.col("n") + PRIOR)
    both = est.join(pooled, "start")  # one pooled row for each of the two starts
    out = both.select(*[c for c in est.columns if c[:2] not in ("m_", "c_")],
                      *[(w * F.col(f"m_{i}") + (1 - w) * F.col(f"pm_{i}")).alias(f"m_{i}") for i in p],
                      *[((w * F.col(f"c_{i}_{j}") + (1 - w) * F.col(f"pc_{i}_{j}")) / scale
                         + F.lit(floors[i] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}") for i in p for j in range(i + 1)])
    for i in p:  # Cholesky factor, a row at a time
        for j in range(i + 1):
            rest = reduce(lambda a, k: a - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}"), range(j), F.col(f"c_{i}_{j}"))  # noqa: B023
            out = out.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l_{j}_{j}"))
    return out.withColumn("logdet", reduce(lambda a, b: a + b, [F.log(F.col(f"l_{i}_{i}")) for i in p])) \
        .drop(*[f"c_{i}_{j}" for i in p for j in range(i + 1)])


def _pooled(rows: DataFrame, xs: list[str]) -> DataFrame:
    all_rows = _moments(rows, ["start"], xs).drop("n")
    return all_rows.select("start", *[F.col(c).alias(f"p{c}") for c in all_rows.columns if c != "start"])


def _distance(rows: DataFrame, est: DataFrame, keys: list[str], xs: list[str], *more: str) -> DataFrame:
    """Rows joined to their group's estimate, with the squared Mahalanobis distance ``d2``."""
    # each group's one row stands SALTS times, so that a hot group's rows go to as many tasks
    spread = est.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    got = rows.withColumn("salt", (F.monotonically_increasing_id() % SALTS).cast("int")).join(spread, [*keys, "salt"])
    for i in range(len(xs)):  # forward substitution
        rest = reduce(lambda a, k: a - F.col(f"l_{i}_{k}") * F.col(f"y_{k}"), range(i), F.col(xs[i]) - F.col(f"m_{i}"))  # noqa: B023
        got = got.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
    d2 = reduce(lambda a, b: a + b, [F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(len(xs))])
    return got.select(*rows.columns, d2.alias("d2"), "logdet", *more)


def outlier_distances(df: DataFrame, xs: list[str], groups: list[str], floors: list[float], half: float = HALF,
                      steps: int = STEPS, shrink: float = SHRINK) -> DataFrame:
    """``df`` with the squared robust distance of each row from its group as ``d2``."""
    keys = [f"g_{g}" for g in groups]
    p = range(len(xs))
    clean = df.withColumns({x: F.coalesce(F.when(F.abs(x) < float("inf"), F.col(x).cast("double")), F.lit(0.0)) for x in xs})
    # null as a value of its own, so that groups can be joined by equality
    clean = clean.withColumns({f"g_{g}": F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("null")) for g in groups})
    rows = workers.keep(clean.select(*keys, *xs), "vectors")

    med = rows.groupBy(*keys).agg(F.count("*").cast("double").alias("n"),
                                  *[F.percentile_approx(x, 0.5, 1000).alias(f"m_{i}") for i, x in enumerate(xs)])
    spread = med.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    away = rows.withColumn("salt", (F.monotonically_increasing_id() % SALTS).cast("int")).join(spread, [*keys, "salt"])
    mad = away.groupBy(*keys).agg(*[F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{i}")), 0.5, 1000).alias(f"d_{i}")
                                    for i, x in enumerate(xs)])
    start0 = med.join(mad, keys).select(
        *keys, F.lit(0).alias("start"), "n", *[f"m_{i}" for i in p],
        *[((F.col(f"d_{i}") * 1.4826) ** 2 if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i in p for j in range(i + 1)])
    two = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    start1 = _moments(rows, keys, xs).withColumn("start", F.lit(1)).select(*start0.columns)
    est = _settled(workers.keep(start0.unionAll(start1), "starts"), _pooled(two, xs), floors, 1.0)
    by = [*keys, "start"]
    last = None
    est = workers.keep(est, "estimate")
    for _ in range(steps):
        if last is not None:
            workers.drop(last)
        last = est
        near = _distance(two, est, by, xs)
        limits = near.groupBy(*by).agg(F.percentile_approx("d2", half, 1000).alias("limit"))
        inner = _distance(two, est.join(limits, by), by, xs, "limit").filter("d2 <= limit")
        est = workers.keep(_settled(_moments(inner, by, xs), _pooled(inner, xs), floors, shrink), "estimate")
        moved = est.join(last.select(*by, F.col("logdet").alias("before")), by) \
            .agg(F.max(F.abs(F.col("logdet") - F.col("before")))).first()[0]
        if moved is None or moved < SETTLED:
            break
    else:
        warnings.warn(f"the estimates have not settled in {steps} steps: a log determinant moved by {moved}", RuntimeWarning, stacklevel=2)
    best = est.groupBy(*keys).agg(F.min(F.struct("logdet", "start")).alias("best"))
    final = est.join(best, keys).filter("start = best.start").drop("best", "start", "n")
    out = _distance(clean, workers.keep(final, "final"), keys, xs)
    return out.drop("logdet", *keys)


def quality_outliers(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, the text statistics, d2, base_failed and kept of every row.

    base_failed: fewer than 50 words, or more than half of them in repeated
    windows. The estimates are made from the rows that pass; a row is kept if
    it passes and its distance is within ``cutoff``.
    """
    stats = with_features(text_statistics(docs).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))
    stats = workers.keep(stats, "statistics")
    passed = outlier_distances(stats.filter(~F.col("base_failed")), FEATURES, ["lang", "source"], FLOORS)
    failed = stats.filter("base_failed").withColumn("d2", F.lit(None).cast("double"))
    return passed.unionByName(failed).withColumn("kept", F.coalesce(~F.col("base_failed") & (F.col("d2") <= cutoff), F.lit(False)))
