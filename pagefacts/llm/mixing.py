"""Mixing sources to token targets by entropy balancing.

Every document gets a rate; among all rates that give each source its target tokens, those
nearest to 1 in relative entropy are exp(lambda * size), cut at the most copies allowed. The
lambda of each source solves the convex dual, found by Newton steps that are jobs over
(source, size) counts. Rates become copies by a threshold on hashed fractions, chosen from
histograms so that a source's copies meet its target within about one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

MOST = 3  # copies of a document, and times a source's size its target may reach
STEPS = 40
NEAR = 1e-7
BINS = 1024


def same_source() -> Column:
    return F.col("l.source").eqNullSafe(F.col("r.source"))


def with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Columns of ``sources`` for each row by source, null being a source too.

    A small table of sources is sent to all tasks by Spark; a large one is joined with a
    shuffle in which adaptive execution splits the rows of large sources.
    """
    other = [F.col(f"r.{c}") for c in sources.columns if c != "source"]
    return rows.alias("l").join(sources.alias("r"), same_source(), "left").select("l.*", *other)


def ranked(sources: DataFrame) -> DataFrame:
    """Rank from 0 by code point, null last, without one task for all: by ranges and their counts."""
    parts = sources.withColumn("_none", F.col("source").isNull())
    parts = parts.repartitionByRange(F.col("_none"), F.col("source")).sortWithinPartitions("_none", "source")
    at = F.monotonically_increasing_id()
    parts = common.staged(
        parts.withColumn("_part", F.shiftright(at, 33)).withColumn("_row", at.bitwiseAND(F.lit((1 << 33) - 1))), "mix-ranks"
    )
    counts = parts.groupBy("_part").count()
    # One row per range, at most the number of shuffle partitions.
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", before.alias("_before"))
    return parts.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_row") + F.col("_before")).drop("_part", "_row", "_before", "_none")


def targets(sources: DataFrame, most: int = MOST, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """source, source_size, target: weights repeat over the ranks and share all tokens.

    A target stops at ``most`` times the source's size; what is over is shared among the
    others by weight, until none is above.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double")
    table = common.staged(ranked(sources).withColumn("weight", weight), "mix-sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    cap, level, stopped = F.col("source_size") * most, 0.0, -1
    over = F.lit(False)
    while True:
        row = table.agg(
            F.count_if(over).alias("n"),
            F.sum(F.when(over, cap).otherwise(0)).alias("given"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row.n == stopped or not row.weight:
            break
        stopped, level = row.n, (total - row.given) / row.weight
        over = F.col("weight") * level > cap
    target = F.when(over, cap.cast("double")).otherwise(F.least(cap.cast("double"), F.col("weight") * level))
    return table.select("source", "source_size", target.alias("target"))


def rates(sized: DataFrame, goal: DataFrame, most: int = MOST) -> DataFrame:
    """Per source the lambda of its documents' rates ``min(most, exp(lambda * size / typical))``.

    Newton steps on the dual, kept inside a bracket and halved where they leave it; the loop
    ends when every source is within NEAR of its target.
    """
    per_size = common.staged(sized.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "mix-sizes")
    size, n = F.col("size").cast("double"), F.col("n").cast("double")
    typical = per_size.groupBy("source").agg((F.sum(size * size * n) / F.sum(size * n)).alias("typical"))
    full = F.col("target") >= F.col("source_size") * most * (1 - 1e-12)
    start = F.log(F.greatest(F.col("target"), F.lit(1e-9)) / F.greatest(F.col("source_size"), F.lit(1)))
    state = with_source(goal, typical).select(
        "*", full.alias("full"), start.alias("lam"), F.lit(-1e4).alias("low"), F.lit(1e4).alias("high"), F.lit(False).alias("done")
    )
    state = common.staged(state, "mix-newton")
    for _ in range(STEPS):
        z = size / F.col("typical")
        free = F.col("lam") * z < F.log(F.lit(float(most)))
        w = F.when(free, F.exp(F.col("lam") * z)).otherwise(float(most))
        sums = (
            with_source(per_size, state.select("source", "typical", "lam"))
            .groupBy("source")
            .agg(F.sum(n * size * w).alias("_got"), F.sum(F.when(free, n * size * z * w).otherwise(0.0)).alias("_slope"))
        )
        gap = F.coalesce(F.col("_got"), F.lit(0.0)) - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - gap / F.col("_slope")
        inside = (F.col("_slope") > 0) & (newton > low) & (newton < high)
        done = F.col("full") | F.col("_got").isNull() | (F.abs(gap) <= NEAR * F.greatest(F.col("target"), F.lit(1.0)))
        step = with_source(state.filter("not done"), sums).select(
            *goal.columns, "typical", "full",
            F.when(done, F.col("lam")).when(inside, newton).otherwise((low + high) / 2).alias("lam"),
            low.alias("low"), high.alias("high"), done.alias("done"),
        )
        state = common.staged(step.unionByName(state.filter("done")), "mix-newton")
        if state.filter("not done").isEmpty():
            break
    return state.select("source", "source_size", "target", "typical", "full", "lam")


def copies(sized: DataFrame, solved: DataFrame, most: int = MOST) -> DataFrame:
    """``sized`` with source_size, target, rate and whole ``copies``.

    A copy more than the rate's whole part goes to documents whose hashed number less the
    rate's fraction is under a threshold. Two histograms of these keys per source, the second
    inside the bin chosen in the first, place the threshold so that the source's sum is met.
    """
    rate = F.when(F.col("full"), float(most)).otherwise(
        F.least(F.lit(float(most)), F.exp(F.col("lam") * F.col("size") / F.col("typical")))
    )
    whole = F.floor("rate").cast("long")
    number = F.pmod(F.xxhash64(sized.columns[0], "size", F.lit("copies")), F.lit(1 << 40)) / float(1 << 40)
    rows = with_source(sized, solved).withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(1.0))
    rows = rows.withColumn("_whole", whole).withColumn("_key", number - (F.col("rate") - whole))
    rows = common.staged(rows, "mix-rates")
    may = (F.col("_whole") < most) & (F.col("size") > 0)
    need = rows.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("size") * F.col("_whole"))).alias("need")
    )
    level = common.staged(need.withColumn("low", F.lit(-1.0)).withColumn("width", F.lit(2.0)), "mix-cut")
    for last in (False, True):
        bin_ = F.floor((F.col("_key") - F.col("low")) / F.col("width") * BINS)
        inside = with_source(rows.filter(may).select("source", "size", "_key"), level)
        bins = inside.withColumn("bin", bin_).filter((F.col("bin") >= 0) & (F.col("bin") < BINS))
        bins = bins.groupBy("source", "bin").agg(F.sum("size").alias("n"))
        # A window over at most BINS rows of a source.
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("bin"))
        line = with_source(bins.withColumn("upto", upto), level)
        if last:
            # The cut falls behind the last bin that brings the sum nearer to the need.
            fits = F.col("upto") - F.col("n") / 2 <= F.col("need")
            chosen = line.groupBy("source").agg(F.max(F.when(fits, F.col("bin") + 1).otherwise(0)).alias("bin"))
            cut = F.col("low") + F.coalesce(F.col("bin"), F.lit(0)) * F.col("width") / BINS
            level = with_source(level, chosen).select("source", cut.alias("cut"))
        else:
            under = F.col("upto") <= F.col("need")
            chosen = line.groupBy("source").agg(
                F.max(F.when(under, F.col("bin") + 1).otherwise(0)).alias("bin"), F.max(F.when(under, F.col("upto")).otherwise(0)).alias("met")
            )
            joined = with_source(level, chosen)
            step = F.col("width") / BINS
            level = common.staged(
                joined.select(
                    "source",
                    (F.col("need") - F.coalesce(F.col("met"), F.lit(0))).alias("need"),
                    (F.col("low") + F.coalesce(F.col("bin"), F.lit(0)) * step).alias("low"),
                    step.alias("width"),
                ),
                "mix-cut",
            )
    extra = F.when(may & (F.col("_key") < F.col("cut")), 1).otherwise(0)
    return with_source(rows, level).withColumn("copies", (F.col("_whole") + extra).cast("int"))


def mix(docs: DataFrame, text: str = "text", source: str = "source", most: int = MOST, key: str = "doc_id") -> DataFrame:
    """``key``, source, size, source_size, target, rate and copies (0 to ``most``) per row.

    Size is the number of words; null and empty texts have 0 and stay once (they take no
    words). Null is a source of its own, last in order. Repeated rows each get their copies,
    equal ones the same. The same rows give the same copies in every run.
    """
    sized = common.staged(docs.select(key, F.col(source).alias("source"), common.n_words(F.col(text)).alias("size")), "mix-docs")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return copies(sized, rates(sized, targets(sources, most), most), most)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(common.read(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "copies", "rate")
