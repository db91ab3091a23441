"""Quality rules with robust multivariate outliers, all in DataFrame functions.

Each text gives a vector of transformed statistics. Per language and source the minimum
covariance determinant (the tightest three quarters of the rows) is found by concentration
steps, each a grouped aggregation; so it is per language and over all rows. A group's
estimate is drawn towards its language's and that towards the whole's, the more the fewer
rows it has, and a text is rejected by its Mahalanobis distance to it. Distances use the
Cholesky factor, written out in column expressions; the cutoff comes from their distribution.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SYMBOLS = "#*$%&|<>"
SHARE = 0.75  # rows of a group its estimate rests on
# The covariance of the inner three quarters of a normal vector in four dimensions is smaller
# by this factor: share / P(chi2_6 <= quantile of chi2_4 at share).
CONSISTENT = 1.485
STEPS = 6
PRIOR = 40  # rows the estimate of the next wider level counts as beside a group's own
TAIL = 1e-4  # share of texts like the inner ones that the cutoff may cost
# Of chi-square in four dimensions: its point at TAIL, and its quantile at SHARE over its median.
NORMAL_LIMIT, NORMAL_RATIO = 23.51, 1.605
HEAVY_RATIO = 5.66  # of a Weibull tail of exponent 0.4: a few tiny distances do not put the cutoff out of reach
SHRINK = 50  # words added to each text, so that short ones vary no more than long ones
# Least deviation of each statistic: many are 0 for nearly all texts of a group.
FLOOR = (0.02, 0.25, 0.25, 0.25)
DIMS = range(len(FLOOR))
MEAN = [f"_m{i}" for i in DIMS]
COVARIANCE = [f"_s{i}{j}" for i in DIMS for j in range(i + 1)]
FACTOR = [f"_l{i}{j}" for i in DIMS for j in range(i + 1)]


def repeat_words(words: Column, width: int = 5) -> Column:
    """Words inside windows of ``width`` words that the text holds twice or more.

    Windows are compared by 64-bit hashes; their starts are sorted by hash, equal neighbours
    kept, and the union of the covered words counted from the sorted starts.
    """
    n = F.size(words)
    starts = F.when(n >= width, F.sequence(F.lit(1), F.greatest(n - (width - 1), F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(F.xxhash64(F.slice(words, i, width)).alias("h"), i.alias("p")))


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (nulls count as empty)."""
    t = F.coalesce(F.col(text), F.lit(""))
    blanks = F.lit(common.SPACES)
    core = F.btrim(t, blanks)
    words = F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, common.GAP_SQL))
    symbols = reduce(lambda s, c: F.replace(s, F.lit(c), F.lit("")), SYMBOLS, t)
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, blanks) != "")
    rows = docs.withColumn("_words", words).withColumn("_lines", lines)
    rows = rows.withColumn("_windows", F.sort_array(repeat_words(F.col("_words"))))
    w = F.col("_windows")

    def same(x: Column, i: Column) -> Column:
        before = F.get(w, i - 1)["h"]
        after = F.get(w, i + 1)["h"]
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter(w, same), lambda x: x["p"]))
    none = F.struct(F.lit(-9).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(
        starts, none, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(5), p - a["last"])).alias("n")), lambda a: a["n"]
    )
    hashes = F.transform(w, lambda x: x["h"])
    repeated = F.when(F.size(F.array_distinct(hashes)) == F.size(w), 0).otherwise(covered)
    return rows.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(symbols)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
    )


def vector() -> list[Column]:
    """Transformed statistics: mean word length, symbols, repeated words, equal lines."""
    n = F.col("n_words") + F.lit(float(SHRINK))
    return [
        F.log((F.col("word_chars") + F.lit(6.0 * SHRINK)) / n),
        F.log1p(100 * F.col("n_symbols") / n),
        F.log1p(100 * F.col("n_repeat_words") / n),
        F.log1p(100 * F.col("n_dup_lines") / n),
    ]


def cholesky(covariance) -> dict[tuple[int, int], Column]:
    """Lower factor of a matrix of columns, ``covariance(i, j)`` for j <= i."""
    low: dict[tuple[int, int], Column] = {}
    for i in DIMS:
        for j in range(i + 1):
            rest = covariance(i, j)
            for k in range(j):
                rest = rest - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
            low[i, j] = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"_l{j}{j}")
    return low


def estimate(rows: DataFrame, keys: list[str], inside: Column) -> DataFrame:
    """Mean, covariance and Cholesky factor per group of the rows ``inside``; one partial aggregation."""
    x = [F.when(inside, F.col(f"_x{i}")) for i in DIMS]
    sums = [F.avg(x[i]).alias(f"_m{i}") for i in DIMS]
    sums += [F.covar_pop(x[i], x[j]).alias(f"_c{i}{j}") for i in DIMS for j in range(i + 1)]
    table = rows.groupBy(*keys).agg(F.count("*").alias("_rows"), *sums)
    ridge = [f * f for f in FLOOR]
    for i in DIMS:
        for j in range(i + 1):
            value = F.coalesce(F.col(f"_c{i}{j}"), F.lit(0.0)) * CONSISTENT + (ridge[i] if i == j else 0.0)
            table = table.withColumn(f"_s{i}{j}", value)
    means = (F.coalesce(F.col(f"_m{i}"), F.lit(0.0)).alias(f"_m{i}") for i in DIMS)
    return with_factor(table.select(*keys, "_rows", *means, *COVARIANCE))


def with_factor(table: DataFrame) -> DataFrame:
    """``table`` with the Cholesky factor of its covariance."""
    for (i, j), value in cholesky(lambda i, j: F.col(f"_s{i}{j}")).items():
        table = table.withColumn(f"_l{i}{j}", value)
    return table


def distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    y: list[Column] = []
    for i in DIMS:
        rest = F.col(f"_x{i}") - F.col(f"_m{i}")
        for j in range(i):
            rest = rest - F.col(f"_l{i}{j}") * y[j]
        y.append(rest / F.col(f"_l{i}{i}"))
    return reduce(lambda a, b: a + b, (v * v for v in y))


def by_group(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null; Spark broadcasts a small table, else skew is split."""
    on = reduce(lambda a, b: a & b, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys))
    other = [F.col(f"r.{c}") for c in table.columns if c not in keys]
    return rows.alias("l").join(table.alias("r"), on, "left").select("l.*", *other)


def robust_estimates(rows: DataFrame, keys: list[str], steps: int = STEPS) -> DataFrame:
    """MCD per group: start at medians, then concentration steps on the nearest SHARE of rows."""
    half = [F.percentile_approx(f"_x{i}", [0.5, 0.125, 0.875], 1000).alias(f"_q{i}") for i in DIMS]
    first = common.staged(rows.groupBy(*keys).agg(*half), "mcd-start")
    # Inside the middle of every coordinate, or at least at the median where all rows agree.
    near = reduce(
        lambda a, b: a & b,
        (F.abs(F.col(f"_x{i}") - F.col(f"_q{i}")[0]) <= F.greatest(F.col(f"_q{i}")[2] - F.col(f"_q{i}")[1], F.lit(FLOOR[i])) for i in DIMS),
    )
    table = common.staged(estimate(by_group(rows, first, keys), keys, near), "mcd")
    for _ in range(steps):
        far = by_group(rows, table, keys).withColumn("_d", distance())
        limit = far.groupBy(*keys).agg(F.percentile_approx("_d", F.lit(SHARE), F.lit(1000)).alias("_limit"))
        table = common.staged(estimate(by_group(far.drop("_rows"), limit, keys), keys, F.col("_d") <= F.col("_limit")), "mcd")
    return table


def levelled(rows: DataFrame) -> DataFrame:
    """Each row three times: for all rows (level 0), for its language (1), for language and source (2)."""
    none = F.lit(None).cast("string")
    at = [(0, none, none), (1, F.col("lang"), none), (2, F.col("lang"), F.col("source"))]
    levels = F.array(*(F.struct(F.lit(n).alias("level"), a.alias("lang"), b.alias("source")) for n, a, b in at))
    return rows.select(F.explode(levels).alias("_at"), *(f"_x{i}" for i in DIMS)).select("_at.*", *(f"_x{i}" for i in DIMS))


def towards(near: DataFrame, far: DataFrame, keys: list[str]) -> DataFrame:
    """Means and covariances of ``near`` drawn towards those of its wider level ``far``.

    Its own count by its rows, the wider level's by PRIOR rows.
    """
    own = F.col("_rows") / (F.col("_rows") + F.lit(PRIOR))
    wide = far.select(*keys, *(F.col(c).alias(f"_far{c}") for c in MEAN + COVARIANCE))
    both = by_group(near, wide, keys) if keys else near.join(F.broadcast(wide))
    return both.select("lang", "source", "_rows", *((own * F.col(c) + (1 - own) * F.col(f"_far{c}")).alias(c) for c in MEAN + COVARIANCE))


def group_estimates(rows: DataFrame) -> DataFrame:
    """Mean and Cholesky factor for each language and source, drawn towards the wider levels."""
    table = robust_estimates(levelled(rows), ["level", "lang", "source"])
    whole, languages, groups = (table.filter(F.col("level") == n).drop("level", *FACTOR) for n in range(3))
    found = towards(groups, towards(languages, whole, []), ["lang"])
    return common.staged(with_factor(found).select("lang", "source", *MEAN, *FACTOR), "mcd-groups")


def limit_of(distances: DataFrame) -> float:
    """Squared distance that a share of TAIL of texts like the inner ones exceeds.

    A Weibull tail through the median and the quantile at SHARE of the different distances, so
    that copies count once; what lies beyond them has no part in it. It is never lighter than
    that of a normal vector, nor heavier than HEAVY_RATIO says.
    """
    # One row of two numbers.
    middle, inner = distances.select("distance").distinct().agg(F.percentile_approx("distance", [0.5, SHARE], 10_000)).first()[0] or (0.0, 0.0)
    ratio = min(HEAVY_RATIO, max(NORMAL_RATIO, inner / max(middle, 1e-9)))
    power = math.log(ratio) / math.log(math.log(1 - SHARE) / math.log(0.5))
    return max(NORMAL_LIMIT, inner * (math.log(TAIL) / math.log(1 - SHARE)) ** power)


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", cutoff: float | None = None) -> DataFrame:
    """doc_id, base statistics, base_failed, distance and kept per row.

    Null texts have no words and fail the base rule. Null languages and sources are groups
    of their own. A group of any size is judged; only where no row passes the base rules
    there is no distance. Without ``cutoff`` it is ``limit_of`` all rows that passed.
    Repeated rows count and stay each.
    """
    some = docs.select("doc_id", F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("_text"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = text_statistics(some, "_text").drop("_text").withColumn("base_failed", failed)
    rows = common.staged(rows.select("*", *(v.alias(f"_x{i}") for i, v in zip(DIMS, vector()))), "quality")
    table = group_estimates(rows.filter(~F.col("base_failed")))
    out = by_group(rows, table, ["lang", "source"]).withColumn("distance", distance())
    if cutoff is None:
        cutoff = limit_of(out.filter(~F.col("base_failed")))
    kept = ~F.col("base_failed") & (F.col("distance") <= cutoff)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance"
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.read(spark, sf_dir, "documents"))
