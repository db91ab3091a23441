"""URL filter by two character models: accepted and rejected URLs as variable-order Markov chains.

All in DataFrame functions. URLs that a rule decides are the labelled ones. Each class gets
counts of character runs; the probability of a character after its context is the context's
own estimate mixed with that of the next shorter context by the number of different
followers (Witten-Bell), down to an even spread. A URL is judged by the difference of its
log likelihoods per character against a threshold calibrated on labelled URLs left out of
the counts.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ORDER = 5  # longest run counted: four characters of context and the next
START, END = "\x02", "\x03"
ALPHABET = 256  # size of the even spread under all contexts
FOLDS = 5  # one labelled URL in so many calibrates the threshold
STEP = 0.01  # resolution of the threshold, in nats per character
FARTHEST = 8.0  # thresholds are searched between minus and plus this


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; '' without it."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address_of(url: Column, host: Column) -> Column:
    """All behind the first ``://`` with the host as in ``host``; the text itself where there is none."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + F.lit(3) + F.length(host))
    return F.coalesce(F.when(at > 0, F.concat(host, rest)).otherwise(url), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits host (or a parent of it) and the start of the path; its text and verdict."""
    fits = None
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        here = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        fits = F.when(here, value) if fits is None else fits.when(here, value)
    return fits


def runs(rows: DataFrame, *keep: str) -> DataFrame:
    """A row for each character of ``_url`` and its end: the run of up to ORDER characters ending there."""
    padded = F.concat(F.lit(START * (ORDER - 1)), F.col("_url"), F.lit(END))
    at = F.explode(F.sequence(F.lit(1), F.length("_url") + 1)).alias("_at")
    return rows.select(*keep, padded.alias("_p"), at).select(*keep, F.expr(f"substring(_p, _at, {ORDER})").alias("gram"))


def run_table(train: DataFrame, needed: DataFrame) -> DataFrame:
    """Every run in ``needed`` with its log probability in both classes, ``_a`` and ``_r``.

    Shorter runs are summed from longer ones, so the URLs are cut once. A context's followers
    are at most the characters in use, so the windows are small.
    """
    one = lambda label: F.sum(F.when(F.col("_label") == label, 1).otherwise(0))
    counts = runs(train, "_label").groupBy("gram").agg(one("allow").alias("ca"), one("block").alias("cr"))
    zero = needed.select("gram", F.lit(0).cast("long").alias("ca"), F.lit(0).cast("long").alias("cr"))
    levels = {ORDER: common.staged(counts.unionByName(zero).groupBy("gram").agg(F.sum("ca").alias("ca"), F.sum("cr").alias("cr")), "url-runs")}
    for n in range(ORDER - 1, 0, -1):
        short = levels[n + 1].select(F.expr(f"right(gram, {n})").alias("gram"), "ca", "cr")
        levels[n] = short.groupBy("gram").agg(F.sum("ca").alias("ca"), F.sum("cr").alias("cr"))
    table = None
    for n in range(1, ORDER + 1):
        context = Window.partitionBy(F.expr(f"left(gram, {n - 1})")) if n > 1 else None
        level = levels[n]
        if context is None:
            # One row: the sums over single characters.
            whole = level.agg(*_sums())
            level = level.join(F.broadcast(whole))
            level = level.withColumn("_pa0", F.lit(1.0 / ALPHABET)).withColumn("_pr0", F.lit(1.0 / ALPHABET))
        else:
            level = level.select("*", *(s.over(context).alias(name) for name, s in _named()))
            shorter = table.select(F.col("gram").alias("_short"), F.col("_pa").alias("_pa0"), F.col("_pr").alias("_pr0"))
            level = level.join(shorter, F.expr(f"right(gram, {n - 1})") == F.col("_short")).drop("_short")
        for c in "ar":
            mixed = (F.col(f"c{c}") + F.col(f"_k{c}") * F.col(f"_p{c}0")) / (F.col(f"_n{c}") + F.col(f"_k{c}"))
            level = level.withColumn(f"_p{c}", F.when(F.col(f"_n{c}") > 0, mixed).otherwise(F.col(f"_p{c}0")))
        table = common.staged(level.select("gram", "_pa", "_pr"), "url-level")
    return table.select("gram", F.log("_pa").alias("_a"), F.log("_pr").alias("_r"))


def _named():
    for c in "ar":
        yield f"_n{c}", F.sum(f"c{c}")
        yield f"_k{c}", F.sum(F.when(F.col(f"c{c}") > 0, 1).otherwise(0))


def _sums():
    return [s.alias(name) for name, s in _named()]


def scored(urls: DataFrame) -> DataFrame:
    """_row and _diff: log likelihood accepted less rejected per character, for every row.

    ``urls`` holds _row (unique), _url, _label (allow, block or null) and _fold.
    """
    cut = runs(urls, "_row")
    table = run_table(urls.filter(F.col("_label").isNotNull() & (F.col("_fold") != 0)), cut.select("gram").distinct())
    # Common runs are in every URL: adaptive execution splits their partitions in this join.
    found = cut.join(table, "gram")
    return found.groupBy("_row").agg((F.sum(F.col("_a") - F.col("_r")) / F.count("*")).alias("_diff"))


def threshold(diffs: DataFrame) -> float:
    """Difference from which a URL counts as accepted: the least sum of both error rates on the
    labelled URLs left out of the counts; of equal ones the nearest to 0. 0 without both labels."""
    place = F.greatest(F.least(F.col("_diff"), F.lit(FARTHEST)), F.lit(-FARTHEST))
    # At most two labels times 2 * FARTHEST / STEP + 1 bins.
    rows = diffs.groupBy(F.floor(place / STEP).cast("int").alias("bin"), "_label").count().collect()
    total = {label: sum(r["count"] for r in rows if r._label == label) for label in ("allow", "block")}
    if not all(total.values()):
        return 0.0
    best = None
    for b in sorted({r.bin for r in rows} | {r.bin + 1 for r in rows} | {0}):
        lost = sum(r["count"] for r in rows if r._label == "allow" and r.bin < b) / total["allow"]
        kept = sum(r["count"] for r in rows if r._label == "block" and r.bin >= b) / total["block"]
        if best is None or (lost + kept, abs(b)) < best[:2]:
            best = (lost + kept, abs(b), b)
    return best[2] * STEP


def filter_urls(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule (or null), verdict, and the model's ``difference``.

    Columns of these names in the input are replaced. Null URLs and those without ``://``
    have empty host and path and fit no rule. The model reads the whole address behind the scheme,
    query and fragment included, the raw text where there is no scheme, and the empty text for null.
    Repeated rows stay rows. Without labelled URLs of both verdicts, what no rule decides is
    allowed by a difference of 0.
    """
    names = ("host", "path", "rule", "verdict", "difference")
    rows = pages.select(*(c for c in pages.columns if c not in names), F.col(url).alias("_address"))
    rows = rows.withColumn("host", host_of(F.col("_address"))).withColumn("path", path_of(F.col("_address")))
    rows = rows.withColumn("_url", address_of(F.col("_address"), F.col("host"))).drop("_address")
    rows = rows.withColumn("_fit", rule_of(F.col("host"), F.col("path"), rules)).withColumn("_row", F.monotonically_increasing_id())
    rows = common.staged(rows, "urls")
    labelled = rows.select("_row", "_url", F.col("_fit.verdict").alias("_label"), (F.crc32(F.col("_url").cast("binary")) % FOLDS).alias("_fold"))
    diffs = common.staged(scored(labelled), "url-scores")
    left_out = diffs.join(labelled.filter(F.col("_label").isNotNull() & (F.col("_fold") == 0)).select("_row", "_label"), "_row")
    least = threshold(left_out)
    out = rows.join(diffs, "_row", "left")
    model = F.when(F.col("_diff") >= least, "allow").otherwise("block")
    kept = [c for c in rows.columns if c not in ("_fit", "_row", "_url")]
    return out.select(
        *kept, F.col("_fit.rule").alias("rule"), F.coalesce(F.col("_fit.verdict"), model).alias("verdict"), F.col("_diff").alias("difference")
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.read(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "difference")
