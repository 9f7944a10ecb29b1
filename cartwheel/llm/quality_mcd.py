"""Operator 1: quality rules by robust multivariate outliers.

Base rules reject very short texts and texts that mostly repeat five-word
windows.  For the others, a vector of smoothed log-ratios (mean word length,
symbols, capitals and exclamation marks, repeated lines, repeated windows) is
compared with what is usual for its language and source: location and scatter are
minimum-covariance-determinant estimates over the documents of the group, found
by concentration steps from the medians, and a document is rejected if its
squared Mahalanobis distance exceeds a chi-square quantile.

All of it is DataFrame operations.  Texts are read once; the vectors, a few
numbers a document, are staged.  A concentration step is one aggregation: moments
by group and distance bin (bins of equal width in log distance, so that many a
group, however large, is a bounded number of rows after map-side aggregation), then
the bins that hold the nearest ``SHARE`` of a group give the next estimate.
Groups of every size are judged by one rule: estimates are made for each group, for
each language and for the whole corpus, in the same aggregations, and a language's
are drawn to the corpus's and a group's to its language's, with weight n / (n +
``PRIOR_DOCS``) for the n documents of the finer one (``FLOORS`` keep the scatter of
a tiny corpus regular).  Estimates are joined to documents by group; Spark
broadcasts them where they are small, and splits hot groups' joins where not.

Windows are compared by 64-bit hash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

LEAST_WORDS = 10
REPEAT_PERCENT = 20
PRIOR_DOCS = 200  # documents of a group that weigh as much as the level above it
SHARE = 0.75  # of a group's documents that estimates rest on
STEPS = 5  # concentration steps
#: Chi-square quantiles for the five statistics below: that of SHARE, the share
#: that seven degrees of freedom have below it, and the limit (at 1 - 1e-7).
INNER, INNER_SHARE, LIMIT = 6.6257, 0.5311, 40.86
#: Least standard deviations of the statistics, in their units.
FLOORS = (0.06, 0.35, 0.25, 0.35, 0.35)
BINS_PER_UNIT, MOST_BIN = 64, 2000
SPACES = " \t\n\x0b\f\r"
X = ("x0", "x1", "x2", "x3", "x4")
_CROSS = [(i, j) for i in range(len(X)) for j in range(i + 1)]


def base_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, lang, source, text) with counts instead of the text."""
    def kept(chars: str) -> Column:
        return F.length("text") - F.length(F.translate("text", chars, ""))

    capitals = "".join(chr(c) for c in range(65, 91)) + "!"
    words = docs.select(
        "doc_id", "lang", "source", F.filter(F.split("text", r"\s+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"\S")).alias("lines"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        kept("#*$%&|<>").cast("long").alias("n_symbols"), kept(capitals).cast("long").alias("n_loud"))
    hashed = words.select(
        "*", F.size("words").cast("long").alias("n_words"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines")).drop("words", "lines")
    windows = hashed.withColumn("win", F.when(F.col("n_words") >= 5, F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("n_words").cast("int") - 5, F.lit(0))), lambda i: F.xxhash64(*(F.get("h", i + k) for k in range(5)))))
        .otherwise(F.array().cast("array<bigint>"))).drop("h")
    # only texts with a repeated window are sorted
    order = F.when(F.size(F.array_distinct("win")) < F.size("win"), F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    placed = windows.withColumn("s", order).drop("win")
    again = placed.withColumn("at", F.sort_array(F.transform(
        F.filter("s", lambda e, i: F.coalesce(e["x"] == F.get("s", i - 1)["x"], F.lit(False)) | F.coalesce(e["x"] == F.get("s", i + 1)["x"], F.lit(False))),
        lambda e: e["i"]))).drop("s")
    covered = F.aggregate("at", F.struct(F.lit(0).alias("n"), F.lit(-5).alias("last")),
                          lambda a, p: F.struct((a["n"] + F.least(F.lit(5), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])
    return again.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("at")


def _vectors(counts: DataFrame) -> DataFrame:
    """Smoothed log-ratios: what a short text cannot show is drawn to the middle."""
    n, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")
    return counts.withColumns({
        "x0": F.log((chars + 200.0) / (n + 40.0)),
        "x1": F.log((F.col("n_symbols") + 2.0) / (chars + 400.0)),
        "x2": F.log((F.col("n_loud") + 8.0) / (chars + 400.0)),
        "x3": F.log((F.col("n_dup_lines") + 1.0) / (lines + 10.0)),
        "x4": F.log((F.col("n_repeat_words") + 10.0) / (n + 200.0))})


_M = [f"m{i}" for i in range(len(X))]
_C = [f"c{i}_{j}" for i, j in _CROSS]


def _scatter(moments: DataFrame, widen: float) -> DataFrame:
    """Means and covariances from ``n`` and sums."""
    out = moments.withColumns({m: F.col(f"s{i}") / F.col("n") for i, m in enumerate(_M)})
    return out.select("g", *_M, *((widen * (F.col(f"s{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
                                   + F.lit(FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}_{j}") for i, j in _CROSS))


def _factor(out: DataFrame, key: str = "g") -> DataFrame:
    """Means and the Cholesky factor of the covariances."""
    for i, j in _CROSS:
        rest = reduce(lambda a, k, i=i, j=j: a - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}"), range(j), F.col(f"c{i}_{j}"))
        out = out.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-9))) if i == j else rest / F.col(f"l{j}_{j}"))
    return out.select(key, *_M, *(f"l{i}_{j}" for i, j in _CROSS))


def _distance(rows: DataFrame) -> DataFrame:
    """``d2``, by forward substitution."""
    for i in range(len(X)):
        rest = reduce(lambda a, k, i=i: a - F.col(f"l{i}_{k}") * F.col(f"y{k}"), range(i), F.col(f"x{i}") - F.col(f"m{i}"))
        rows = rows.withColumn(f"y{i}", rest / F.col(f"l{i}_{i}"))
    return rows.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, len(X))), F.col("y0") * F.col("y0")))


def _estimates(rows: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant location and scatter of each group ``g``."""
    # start: medians, and a scatter without covariances from the quartiles
    quartiles = rows.groupBy("g").agg(*(F.percentile_approx(x, [0.25, 0.5, 0.75], 10000).alias(f"q{i}") for i, x in enumerate(X)))
    start = quartiles.select("g", *(F.col(f"q{i}")[1].alias(f"m{i}") for i in range(len(X))), *(
        (F.sqrt(F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(2)) + F.lit(FLOORS[i] ** 2)) if i == j else F.lit(0.0)).alias(f"l{i}_{j}") for i, j in _CROSS))
    now = model = stage(start, "mcd-0")
    for step in range(1, STEPS + 1):
        binned = _distance(rows.join(now, "g")).withColumn("bin", F.least(F.floor(F.log1p("d2") * BINS_PER_UNIT), F.lit(MOST_BIN)).cast("int"))
        # written, so that bins are summed by (group, bin): dealt by group, as the window wants them,
        # every task's sums of a large group would meet in one
        sums = stage(binned.groupBy("g", "bin").agg(
            F.count(F.lit(1)).alias("n"), *(F.sum(x).alias(f"s{i}") for i, x in enumerate(X)),
            *(F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}_{j}") for i, j in _CROSS)), f"bins-{step}")
        nearest = (sums.withColumns({"before": F.expr("sum(n) OVER (PARTITION BY g ORDER BY bin) - n"), "size": F.expr("sum(n) OVER (PARTITION BY g)")})
                   .where(F.col("before") < F.ceil(F.col("size") * SHARE)))
        kept = nearest.groupBy("g").agg(*(F.sum(c).alias(c) for c in ("n", *(f"s{i}" for i in range(len(X))), *(f"s{i}_{j}" for i, j in _CROSS))))
        # the nearest share of a normal group is narrower than the group
        model = stage(_scatter(kept, SHARE / INNER_SHARE), f"mcd-{step}")
        now = _factor(model)
    return model


def _drawn(groups: DataFrame, model: DataFrame) -> DataFrame:
    """Each group's factor, its estimates drawn to its language's and the corpus's."""
    def at(level: str) -> DataFrame:
        return model.select(F.col("g").alias(level), *(F.col(c).alias(f"{level}_{c}") for c in (*_M, *_C)))

    corpus = at("corpus").where("corpus = 'all'").drop("corpus")
    levels = groups.join(at("fine"), "fine").join(at("coarse"), "coarse").withColumn("corpus", F.lit("all")).join(
        corpus.withColumn("corpus", F.lit("all")), "corpus")
    own, lang = (F.col(n) / (F.col(n) + F.lit(float(PRIOR_DOCS))) for n in ("size", "lang_size"))
    return _factor(levels.select("fine", *(
        (own * F.col(f"fine_{c}") + (1 - own) * (lang * F.col(f"coarse_{c}") + (1 - lang) * F.col(f"corpus_{c}"))).alias(c) for c in (*_M, *_C))), "fine")


def quality_rules(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance)`` for every row of ``docs``.  ``distance`` is the
    squared robust distance; it is null where the base rules reject, and only
    there.  Null texts have no words (and fail);
    null languages and sources are groups of their own; ids may be null or
    repeat; other columns are ignored."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    counts = stage(_vectors(base_statistics(base).withColumn("base_failed", failed))
                   .withColumn("fine", F.to_json(F.struct("lang", "source")))
                   .withColumn("coarse", F.concat(F.lit("all of "), F.to_json(F.struct("lang")))), "quality")
    good = counts.where("NOT base_failed")
    fine = good.groupBy("fine", "coarse").agg(F.count(F.lit(1)).alias("size"))
    langs = fine.groupBy("coarse").agg(F.sum("size").alias("lang_size"))
    groups = stage(fine.join(langs, "coarse").select("fine", "size", "coarse", "lang_size"), "groups")
    rows = good.select(F.explode(F.array("fine", "coarse", F.lit("all"))).alias("g"), *X)
    model = _estimates(stage(rows, "vectors"))
    judged = _distance(counts.join(stage(_drawn(groups, model), "drawn"), "fine", "left"))
    distance = F.when(~F.col("base_failed"), F.col("d2"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (F.col("d2") <= LIMIT)).alias("kept"), distance.alias("distance"))
