"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes are cut into S segments of like size, each with its own index. A query looks up all
segment values at radius 0, then 1, 2, ...: when radius r is done in all segments, every code
within S * (r + 1) - 1 bits has been met. A query ends as soon as its k-th verified distance is
within that bound, so the result is exact. With radius r - 1 done in all segments and r in ``a``
of them, the bound is S * r + a - 1: a query looks up only as many segments as the proof still
needs for the k-th distance it knows so far.

A segment has log2(n) bits less ``FEWER``: looking up a value costs as much as comparing some tens of
codes, so an index row is a block, all codes with one value of a segment. A block's codes are
compared in the condition of a join, on 64 bits at a time in generated code: what is beyond the
k-th distance known never becomes a row. Before its first radius a query learns a k-th distance
from the counts of codes by distance in its own blocks.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

K = 10
FEWER = 6  # so many bits a segment has less than the number of codes: a block holds about 2 ** FEWER codes
MOST = 16  # bits of a segment at most, so values at a radius stay few enough to list
BLOCK_ROWS = 1024  # codes of a block row on average; blocks with more are dealt out over several rows
WORD = 64  # bits compared at a time


def sign_bits(vector: Column) -> Column:
    """One bit per dimension, 1 where it is above 0, as an array of 0 and 1; null stays null."""
    return F.transform(vector, lambda x: F.when(x > 0, 1).otherwise(0))


def cut_into(bits: Column, count: Column) -> Column:
    """Bits cut into ``count`` numbers of like size, none over 64 bits."""
    n = F.size(bits)
    start = lambda i: F.floor(i * n / count).cast("int")
    number = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b.cast("long")))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: number(F.slice(bits, start(i) + 1, start(i + 1) - start(i))))


def pieces(bits: Column, size: int) -> Column:
    """How many pieces of at most ``size`` bits hold all bits."""
    return F.ceil(F.size(bits) / size).cast("int")


def distance(a: str, b: str, words: int) -> Column:
    """Differing bits of two rows' words, columns ``a0``, ``a1``, ... and ``b0``, ``b1``, ...; null words count nothing."""
    differ = [F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in range(words)]
    return reduce(lambda x, y: x + y, (F.coalesce(d, F.lit(0)) for d in differ)).cast("int")


def masks(size: int, radius: int) -> list[int]:
    return [sum(1 << i for i in some) for some in combinations(range(size), radius)]


def first_k(rows: DataFrame, group: str | list[str], k: int, *order: str) -> DataFrame:
    """The first ``k`` rows of each group; tasks drop what cannot be among them before the shuffle."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("rank", place).filter(F.col("rank") <= k)


def segment_bits(n: int, longest: int) -> int:
    """Bits of a segment for ``n`` codes of at most ``longest`` bits."""
    return max(1, min(MOST, max(8, round(math.log2(max(2, n))) - FEWER), longest))


def blocks_of(entries: DataFrame) -> DataFrame:
    """dim, part, high (the segment's value) and the block's codes: an array of (entry, m, _id, words), in as many rows as a large block needs."""
    parts = entries.select("dim", "entry", "m", "_id", "words", F.posexplode("code").alias("part", "high"))
    key = ["dim", "part", "high"]
    sizes = parts.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("_rows"))
    dealt = parts.join(sizes, key).withColumn("_sub", F.pmod(F.xxhash64("entry"), F.col("_rows")))
    return dealt.groupBy(*key, "_sub").agg(F.collect_list(F.struct("entry", "m", "_id", "words")).alias("block")).drop("_sub")


def met(probes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each query next to the codes of the blocks that its probes name, with their distance; codes beyond ``reached`` are left out."""
    words = sum(c.startswith("_q") for c in probes.columns)
    codes = blocks.select("dim", "part", "high", F.explode("block").alias("x"))
    codes = codes.select("dim", "part", "high", "x.entry", "x.m", "x._id", *(F.get("x.words", F.lit(i)).alias(f"_c{i}") for i in range(words)))
    away = distance("_q", "_c", words)
    pairs = probes.join(codes.hint("merge"), ["dim", "part", "high"]).filter(F.col("reached").isNull() | (away <= F.col("reached")))
    return pairs.select("query_id", "part", "entry", "m", "_id", away.alias("distance"))


def hits(probes: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """query_id, entry, m, _id and distance of what the probes find within the k-th distance known.

    A segment's value is in one block, so of each segment only the ``k`` first codes can be in a result.
    """
    first = first_k(met(probes, blocks), ["query_id", "part"], k, "distance", "_id", "entry")
    return first.select("query_id", "entry", "m", "_id", "distance").distinct()


def kth(rows: DataFrame, active: DataFrame, *group: str) -> DataFrame:
    """query_id and a distance within which a query has as many rows of a group as it wants; ``rows`` has group, distance and m."""
    upto = F.sum("m").over(Window.partitionBy(*group).orderBy("distance"))
    counts = rows.groupBy(*group, "distance").agg(F.sum("m").alias("m")).withColumn("_upto", upto)
    enough = counts.join(active.select("query_id", "want"), "query_id").filter(F.col("_upto") >= F.col("want"))
    return enough.groupBy("query_id").agg(F.min("distance").alias("_now"))


def probes_of(active: DataFrame, size: int, radius: int) -> DataFrame:
    """A row for each value of a segment at ``radius`` from a query's own, for as many segments as the query needs."""
    words = [c for c in active.columns if c.startswith("_q")]
    parts = active.select("query_id", "dim", "need", "reached", *words, F.posexplode("code").alias("part", "_v")).filter("part < need")
    ways = F.array(*(F.lit(mask).cast("long") for mask in masks(size, radius)))
    parts = parts.select("query_id", "dim", "part", "reached", "_v", *words, F.explode(ways).alias("_way"))
    return parts.select("query_id", "dim", "part", F.col("_v").bitwiseXOR(F.col("_way")).alias("high"), "reached", *words)


def top_k(codes: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (1 to k), id and distance: for each query the k nearest codes of its length.

    ``codes`` has id and bits, ``queries`` query_id and bits (arrays of 0 and 1; rows with null or
    empty ones are left out). Only codes of a query's own length have a distance to it. Ties go to
    the smaller id, null ids last. Equal codes are one entry with its k smallest ids: more of
    them can never be in a result. A code is not left out of its own query. Repeated query rows
    count once. With fewer than k codes all are returned, with none nothing.
    """
    spark = codes.sparkSession
    whole = F.size("bits") > 0
    longest, n = codes.filter(whole).agg(F.max(F.size("bits")), F.count("*")).first()
    if not n:
        return _empty(spark, codes, queries)
    size = segment_bits(n, longest)
    n_words = math.ceil(longest / WORD)
    bits = F.col("bits")
    cut = lambda rows, *keys: rows.filter(whole).select(*keys, F.size("bits").alias("dim"), cut_into(bits, pieces(bits, WORD)).alias("words"), cut_into(bits, pieces(bits, size)).alias("code"))
    rows = cut(codes, "id").withColumn("_id", F.coalesce("id", F.lit((1 << 63) - 1))).withColumn("_same", F.struct("dim", "words"))
    few = first_k(rows, "_same", k, "_id").select("dim", "words", "code", "id", "_id")
    few = common.staged(few, "mih-codes")
    entries = few.groupBy("dim", "words", "code").agg(F.count("*").alias("m"), F.min("_id").alias("_id"))
    entries = common.staged(entries.withColumn("entry", F.monotonically_increasing_id()), "mih-entries")
    blocks = common.staged(blocks_of(entries), "mih-blocks")
    count = F.size("code")
    asked = cut(queries.filter(F.col("query_id").isNotNull()), "query_id").dropDuplicates(["query_id"])
    wants = entries.groupBy("dim").agg(F.least(F.sum("m"), F.lit(k)).alias("want"))
    asked = asked.join(wants, "dim").select("query_id", "dim", "want", "code", *(F.get("words", F.lit(i)).alias(f"_q{i}") for i in range(n_words)))
    known = asked.columns
    active = common.staged(asked.select("*", F.lit(None).cast("int").alias("reached")), "mih-queries")
    found = None
    done = -1  # the radius that all segments of the queries still active are done with
    while done < size and not active.isEmpty():
        radius = done + 1
        unknown = active.filter(F.col("reached").isNull())
        if not unknown.isEmpty():
            # The codes of one segment's blocks are counted, since those of two may be the same.
            ahead = met(probes_of(unknown.withColumn("need", count), size, radius), blocks)
            bound = kth(ahead, unknown, "query_id", "part")
            last, active = active, common.staged(active.join(bound, "query_id", "left").select(*known, F.coalesce("reached", "_now").alias("reached")), "mih-bound")
            common.dropped(last)
        need = F.least(count, F.coalesce(F.col("reached") + 1 - count * radius, count))
        asking = active.withColumn("need", need)
        new = hits(probes_of(asking, size, radius), blocks, k)
        both = new if found is None else found.unionByName(new).distinct()
        before, found = found, common.staged(first_k(both, "query_id", k, "distance", "_id", "entry").drop("rank"), "mih-found")
        now = asking.join(kth(found, asking, "query_id"), "query_id", "left").withColumn("reached", F.coalesce("_now", "reached"))
        unproved = now.filter(F.col("reached").isNull() | (F.col("reached") > count * radius + F.col("need") - 1))
        done = radius
        last, active = active, common.staged(unproved.select(*known, "reached"), "mih-active")
        common.dropped(last, *([before] if before else []))
    common.dropped(blocks, active)
    if found is None:
        return _empty(spark, codes, queries)
    rows = found.select("query_id", "entry", "distance").join(entries.select("entry", "dim", "words").hint("merge"), "entry").join(few.select("dim", "words", "id", "_id").hint("merge"), ["dim", "words"])
    best = first_k(rows.select("query_id", "distance", "id", "_id"), "query_id", k, "distance", "_id")
    return best.select("query_id", "rank", "id", "distance")


def _empty(spark: SparkSession, codes: DataFrame, queries: DataFrame) -> DataFrame:
    types = dict(codes.dtypes)["id"], dict(queries.dtypes)["query_id"]
    return spark.createDataFrame([], f"query_id {types[1]}, rank int, id {types[0]}, distance int")


def op5_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors by sign bits, for each vector whose id is divisible by 50."""
    vectors = common.read(spark, sf_dir, "embeddings")
    codes = vectors.select(F.col("vec_id").alias("id"), sign_bits(F.col("embedding")).alias("bits"))
    queries = codes.filter(F.col("id") % 50 == 0).withColumnRenamed("id", "query_id")
    return top_k(codes, queries).select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


SQL = {
    "op5_hamming_top_k": """
        WITH codes AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.bits, c.bits), lambda p: CASE WHEN p[1] = p[2] THEN 0 ELSE 1 END)) AS INTEGER) AS distance
            FROM codes q, codes c WHERE q.vec_id % 50 = 0
        ),
        placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM pairs)
        SELECT query_id, rank, vec_id, distance FROM placed WHERE rank <= 10
    """
}
