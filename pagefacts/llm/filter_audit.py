"""Audit of filters that work together: what each removes in every order, and its Shapley share.

Documents count by the set of filters they fail, 2^n sets per part of the corpus. From these
come the removals of every coalition of filters, and from coalitions everything else: what a
filter removes at a step is the difference of two coalitions, and Shapley shares are the least
squares fit of a sum over members to the coalitions' removals, weighted by the Shapley kernel
and held to sum to the removals of all. Its normal equations are solved in rationals, once:
the solution is linear in the removals.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import slices

BATCH_BYTES = 8_000_000
PIECE_BYTES = 1 << 22  # of a long text whose words are listed at once
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SIGNS = b"#$%&*|"


def pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text in runs of about ``size`` bytes that end where a word ends."""
    start = 0
    while len(data) - start > size:
        end = start + size
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


def fails(data: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    n, distinct = 0, set()
    for piece in pieces(data):
        words = piece.split()
        n += len(words)
        distinct.update(words)
    chars = len(data) if data.isascii() else int(((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).sum())
    capitals = len(data) - len(data.translate(None, CAPITALS))
    signs = len(data.translate(None, SIGNS)) < len(data)
    return (n < 200) | (100 * len(distinct) < 50 * n) << 1 | (100 * capitals > 3 * chars) << 2 | signs << 3


def failures(
    docs: DataFrame, labels: DataFrame, judge: Callable[[bytes], int] = fails, copies_bit: int = 4, part: str = "lang"
) -> DataFrame:
    """part, fails (bits of failed filters), good, toxic and docs: how many documents are alike in these.

    ``judge`` gives the bits that follow from a text; ``copies_bit`` is set where a smaller doc_id
    has the same text. Null texts and parts count as empty ones. A row with a null doc_id has no
    smaller one and no labels, and makes no other row a copy. Rows of one doc_id are no copies of
    each other; several labels of one doc_id count as one that holds all. Only doc_id, text,
    ``part`` and the labels' doc_id, quality and toxic are read. Without rows there are none.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_data", BATCH_BYTES):
            texts = batch.column("_data").to_pylist()
            found = [pa.array([judge(t) for t in texts], pa.int32()), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), *found], names=["doc_id", "part", "fails", "digest"])

    parts = F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = common.in_bytes(docs, "text", "doc_id", parts).mapInArrow(work, f"doc_id {kind}, part string, fails int, digest binary")
    rows = common.staged(rows, "audit-rows")
    known = rows.filter(F.col("doc_id").isNotNull())
    # The smallest id of each text is looked up by that id, so a text with very many copies is no
    # hot key; rows that repeat are counted before they are joined.
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    yes = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(yes("quality").alias("good"), yes("toxic").alias("toxic"))
    known = known.groupBy("doc_id", "digest", "part", "fails").agg(F.count("*").alias("docs"))
    known = known.join(first, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    false = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    bits = F.when(F.col("first").isNull(), F.col("fails").bitwiseOR(F.lit(1 << copies_bit))).otherwise(F.col("fails"))
    known = known.select("part", bits.alias("fails"), false("good"), false("toxic"), "docs")
    unknown = rows.filter(F.col("doc_id").isNull()).select("part", "fails", F.lit(False).alias("good"), F.lit(False).alias("toxic"), F.lit(1).cast("long").alias("docs"))
    return known.unionByName(unknown).groupBy("part", "fails", "good", "toxic").agg(F.sum("docs").alias("docs"))


def solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X with matrix X = right, by elimination in rationals; the matrix is regular."""
    n = len(matrix)
    rows = [[*a, *b] for a, b in zip(matrix, right)]
    for i in range(n):
        pivot = next(k for k in range(i, n) if rows[k][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(n):
            if k != i and rows[k][i]:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i])]
    return [row[n:] for row in rows]


def shapley_weights(n: int) -> list[list[Fraction]]:
    """Per filter the weight of each coalition's removals (by its bits) in the filter's Shapley share.

    Shares p minimise sum over coalitions S of w(S) (v(S) - p(S))^2, held to p(all) = v(all), where
    w(S) = (n - 1) / (C(n, s) s (n - s)) for S neither empty nor all. With a multiplier for the
    constraint these are n + 1 linear equations, solved for each unit v.
    """
    everyone = (1 << n) - 1
    kernel = {}
    for coalition in range(1, everyone):
        s = coalition.bit_count()
        kernel[coalition] = Fraction(n - 1, math.comb(n, s) * s * (n - s))
    has = lambda coalition, i: coalition >> i & 1
    matrix = [[sum((w for c, w in kernel.items() if has(c, i) and has(c, k)), Fraction(0)) for k in range(n)] + [Fraction(1)] for i in range(n)]
    matrix.append([Fraction(1)] * n + [Fraction(0)])
    right = [[kernel.get(c, Fraction(0)) * has(c, i) for c in range(everyone + 1)] for i in range(n)]
    right.append([Fraction(int(c == everyone)) for c in range(everyone + 1)])
    return solved(matrix, right)[:n]


def steps(names: str) -> list[dict]:
    """All orders of the filters by step: the filter, and the coalitions before and after it."""
    out = []
    for order in permutations(range(len(names))):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            out.append({"filter_order": "".join(names[k] for k in order), "step": step, "i": i, "before": before, "after": after})
            before = after
    return out


def audit(patterns: DataFrame, names: str = "ABCDE") -> DataFrame:
    """Per part, filter_order and step what the step's filter does, zeros included.

    kept: documents left; removed: removed here; redundant: failing the filter but removed earlier;
    unique_fails: failing this filter only; good_lost, toxic_lost: removed here with that label;
    shapley: removed by the filter, summed over all orders at any step.

    ``patterns`` has part, fails, good, toxic and docs, as ``failures`` gives them; ``names`` has a
    letter for each bit of ``fails``. Per part 2^n counts are held and n! * n rows made, for a
    handful of filters as meant here; what grows with the corpus is only added up.
    """
    n, size = len(names), 1 << len(names)
    docs = F.col("docs")
    counted = {"fail": docs, "good": F.when(F.col("good"), docs).otherwise(0), "toxic": F.when(F.col("toxic"), docs).otherwise(0)}
    of_set = lambda k, value: F.sum(F.when(F.col("fails") == k, value).otherwise(0))
    sets = patterns.groupBy("part").agg(*(F.array(*(of_set(k, v) for k in range(size))).alias(c) for c, v in counted.items()))
    every, none = F.sequence(F.lit(0), F.lit(size - 1)), F.lit(0).cast("long")

    def removals(counts: Column) -> Column:
        """What each coalition removes: all sets that hold one of its filters."""
        add = lambda coalition: lambda total, k: total + F.when(k.bitwiseAND(coalition) != 0, F.get(counts, k)).otherwise(0)
        return F.transform(every, lambda coalition: F.aggregate(every, none, add(coalition)))

    # Times n! the weights are whole numbers.
    weights = [[int(w * math.factorial(n)) for w in row] for row in shapley_weights(n)]
    total = lambda values: F.aggregate(values, none, lambda a, b: a + b)
    share = lambda row: total(F.zip_with(row, F.col("fail_v"), lambda w, v: w * v))
    table = sets.select("part", "fail", total(F.col("fail")).alias("docs"), *(removals(F.col(c)).alias(f"{c}_v") for c in counted))
    table = table.withColumn("shares", F.transform(F.from_json(F.lit(json.dumps(weights)), "array<array<bigint>>"), share))
    kind = "array<struct<filter_order:string,step:int,i:int,before:int,after:int>>"
    rows = table.withColumn("s", F.explode(F.from_json(F.lit(json.dumps(steps(names))), kind)))
    at = lambda column, coalition: F.get(F.col(column), coalition)
    before, after = F.col("s.before"), F.col("s.after")
    own = after - before
    here = lambda column: at(column, after) - at(column, before)
    return rows.select(
        "part", "s.filter_order", "s.step", (F.col("docs") - at("fail_v", after)).alias("kept"), here("fail_v").alias("removed"),
        (at("fail_v", own) - here("fail_v")).alias("redundant"), at("fail", own).alias("unique_fails"),
        here("good_v").alias("good_lost"), here("toxic_v").alias("toxic_lost"), at("shares", F.col("s.i")).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = failures(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))
    return audit(common.staged(rows, "audit-patterns"))


SQL = {
    "op12_filter_audit": r"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
            FROM documents
        ),
        marks AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
            FROM labels GROUP BY doc_id
        ),
        failed AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS fails
            FROM texts LEFT JOIN marks USING (doc_id)
        ),
        sets AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
        filters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
        orders AS (
            SELECT '' AS filter_order, 0 AS used, 0 AS step
            UNION ALL
            SELECT filter_order || f, used + bit, step + 1 FROM orders, filters WHERE used & bit = 0
        ),
        steps AS (
            SELECT o.filter_order, s.step + 1 AS step, f.bit, s.used AS before, s.used + f.bit AS after
            FROM orders o JOIN orders s ON s.step < 5 AND o.filter_order LIKE s.filter_order || '%'
            JOIN filters f ON f.f = o.filter_order[s.step + 1] WHERE o.step = 5
        ),
        found AS (
            SELECT part, filter_order, step, bit,
                   sum(CASE WHEN fails & after = 0 THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN fails & before <> 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
            FROM sets, steps GROUP BY part, filter_order, step, bit
        )
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM found
    """
}
