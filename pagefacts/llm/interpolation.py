"""Language model scores by deleted interpolation of bigrams, unigrams and an even spread.

Texts are dealt into chunks. A chunk sends each different word and word pair once, with its
count in training texts, to the shard of its hash; shards add the counts and answer every
chunk with the totals in the order asked. So hot words cost one number per chunk, and no
row per token is ever shuffled. The mixture weights, one triple per bucket of the
context's frequency, are learnt by expectation-maximisation on pairs of training texts
that were deleted from the counts.

Words are known by 64-bit hashes, of which two different words share one with probability
below 1e-5 in ten million words.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import GOLDEN, mixed, words_of

CHUNK_BYTES = 6_000_000  # text of a chunk
SHARD_BYTES = 12_000_000  # text whose words and pairs one shard adds up
FOLDS = 16  # one training text in so many is deleted for the mixture weights
ROUNDS, NEAR = 25, 1e-6
BUCKETS = 48  # by the binary logarithm of the context's count
# Hashes that stand for the end and the start of a text.
END, START = np.uint64(0x5EED0E4D5EED0E4D), np.uint64(0x5EED57A45EED57A4)
WORD, PAIR, KNOWN, DELETED, TOTAL, VOCABULARY = range(6)  # kinds of rows
ASKED = "kind int, shard int, chunk long, keys binary, n binary, m binary, h binary, w binary"
ANSWERED = "kind int, chunk long, shard int, data binary, h long, w long, n long, m long"


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts in a row as hashes (an end after each text), their contexts, and tokens per text."""
    index: dict[bytes, int] = {}
    parts = []
    for text in texts:
        words = words_of(text)
        for w in set(words).difference(index):
            index[w] = len(index)
        # The end gets its place when all words are known.
        parts.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
        parts.append(np.array([-1], np.int32))
    keys = np.empty(len(index), object)
    keys[:] = list(index)
    hashes = np.append(pd.util.hash_array(keys, categorize=False) if len(index) else np.empty(0, np.uint64), END)
    lengths = np.array([len(p) + 1 for p in parts[::2]], np.int64)
    codes = np.concatenate(parts) if parts else np.empty(0, np.int32)
    tokens = hashes[codes]
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    if len(lengths):
        before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = START
    return tokens, before, lengths


def pair_hashes(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(mixed(before + GOLDEN) ^ tokens)


def by_shard(keys: np.ndarray, shards: int) -> list[np.ndarray]:
    """Positions of sorted ``keys`` in each shard, in order."""
    owner = (keys % np.uint64(shards)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(shards + 1))
    return [order[cuts[s] : cuts[s + 1]] for s in range(shards)]


def packed_keys(kind: int, keys: np.ndarray) -> bytes:
    """Words whole; of pairs the high 40 bits: a shard has some million pairs, so that one in a
    million shares them with another."""
    if kind == WORD:
        return keys.astype("<u8").tobytes()
    return np.ascontiguousarray((keys >> np.uint64(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpacked_keys(kind: int, data: bytes) -> np.ndarray:
    if kind == WORD:
        return np.frombuffer(data, "<u8")
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def small(x: np.ndarray) -> bytes:
    return x.astype("<u4").tobytes()


def questions(table: pa.Table, shards: int) -> pa.Table:
    """What a chunk sends: its different words and pairs with training and deleted counts."""
    texts = table.column("_data").to_pylist()
    tokens, before, lengths = hashed(texts)
    train = np.repeat(np.array(table.column("_train").to_pylist(), bool), lengths)
    deleted = np.repeat(np.array(table.column("_deleted").to_pylist(), bool), lengths)
    chunk = table.column("_chunk")[0].as_py()
    rows: list[tuple] = []
    pairs = pair_hashes(before, tokens)
    for kind, all_keys in ((WORD, tokens), (PAIR, pairs)):
        keys, first, place = np.unique(all_keys, return_index=True, return_inverse=True)
        n = np.bincount(place[train], minlength=len(keys))
        m = np.bincount(place[deleted], minlength=len(keys))
        for s, some in enumerate(by_shard(keys, shards)):
            if not len(some):
                continue
            h = w = None
            if kind == PAIR:
                taken = some[m[some] > 0]
                h, w = before[first[taken]].tobytes(), tokens[first[taken]].tobytes()
            rows.append((kind, s, chunk, packed_keys(kind, keys[some]), small(n[some]), small(m[some]), h, w))
    docs = table.column("_train").to_pylist(), table.column("_deleted").to_pylist()
    rows.append((TOTAL, chunk % shards, chunk, np.array([train.sum(), deleted.sum(), sum(docs[0]), sum(docs[1])], "<i8").tobytes(), b"", b"", None, None))
    return pa.table(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5))],
        names=["kind", "shard", "chunk", "keys", "n", "m", "h", "w"],
    )


def answers(table: pa.Table) -> pa.Table:
    """What a shard sends back to each chunk, and what it found for the mixture weights."""
    kind, shard = table.column("kind")[0].as_py(), table.column("shard")[0].as_py()
    if kind == TOTAL:
        sums = np.sum([np.frombuffer(k, "<i8") for k in table.column("keys").to_pylist()], 0)
        return _table([(TOTAL, None, shard, None, *sums.tolist())])
    chunks, asked = table.column("chunk").to_pylist(), [unpacked_keys(kind, k) for k in table.column("keys").to_pylist()]
    n_in, m_in = (np.concatenate([np.frombuffer(x, "<u4") for x in table.column(c).to_pylist()]) for c in "nm")
    keys, place = np.unique(np.concatenate(asked), return_inverse=True)
    n = np.bincount(place, n_in, len(keys)).astype(np.int64)
    m = np.bincount(place, m_in, len(keys)).astype(np.int64)
    left = n - m
    out: list[tuple] = []
    at = 0
    for c, k in zip(chunks, asked):
        out.append((kind, c, shard, small(n[place[at : at + len(k)]]), None, None, None, None))
        at += len(k)
    blocks = [out]
    if kind == WORD:
        out.append((VOCABULARY, None, shard, None, None, None, int((n > 0).sum()), int((left > 0).sum())))
        some = np.flatnonzero(m)
        blocks.append(_columns(KNOWN, shard, keys[some].view(np.int64), None, left[some], None))
    else:
        h, w = (np.concatenate([np.frombuffer(x, np.uint64) for x in table.column(c).to_pylist()]) for c in "hw")
        counted = m_in > 0
        blocks.append(_columns(DELETED, shard, h.view(np.int64), w.view(np.int64), m_in[counted].astype(np.int64), left[place[counted]]))
    first = _table(out)
    return pa.concat_tables([first, *(b.cast(first.schema) for b in blocks[1:])])


def _table(rows: list[tuple]) -> pa.Table:
    types = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    names = ["kind", "chunk", "shard", "data", "h", "w", "n", "m"]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _columns(kind: int, shard: int, h, w, n, m) -> pa.Table:
    size = len(h)
    whole = lambda v, t: pa.array(np.full(size, v), t)
    some = lambda v: pa.nulls(size, pa.int64()) if v is None else pa.array(v, pa.int64())
    return pa.table(
        [whole(kind, pa.int32()), pa.nulls(size, pa.int64()), whole(shard, pa.int32()), pa.nulls(size, pa.binary()), some(h), some(w), some(n), some(m)],
        names=["kind", "chunk", "shard", "data", "h", "w", "n", "m"],
    )


def bucket_of(count: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the binary logarithm of its count."""
    return np.minimum(np.floor(np.log2(np.maximum(count, 0) + 0.5)).astype(np.int64) + 1, BUCKETS - 1).clip(0)


def mixture_weights(deleted: DataFrame) -> np.ndarray:
    """(BUCKETS, 3) weights of bigram, unigram and even spread, by EM over deleted pairs.

    ``deleted`` has bucket, n, p2, p1, p0. Each round is one grouped sum with at most BUCKETS
    rows. A bucket without pairs takes the weights of all; bucket 0 has no bigrams.
    """
    weights = np.tile([0.5, 0.4, 0.1], (BUCKETS, 1))
    weights[0] = [0.0, 0.8, 0.2]
    last = -math.inf
    for _ in range(ROUNDS):
        lam = [F.element_at(F.lit([float(v) for v in weights[:, k]]), F.col("bucket") + 1) for k in range(3)]
        parts = [lam[0] * F.col("p2"), lam[1] * F.col("p1"), lam[2] * F.col("p0")]
        p = parts[0] + parts[1] + parts[2]
        sums = deleted.groupBy("bucket").agg(
            *(F.sum(F.col("n") * parts[k] / p).alias(f"s{k}") for k in range(3)), F.sum("n").alias("n"), F.sum(F.col("n") * F.log(p)).alias("ll")
        ).collect()
        if not sums:
            return weights
        for r in sums:
            share = np.array([r.s0, r.s1, r.s2]) + [0.01, 0.01, 0.01]
            if r.bucket == 0:
                share[0] = 0
            weights[r.bucket] = share / share.sum()
        likelihood = sum(r.ll for r in sums) / sum(r.n for r in sums)
        if likelihood - last < NEAR:
            break
        last = likelihood
    seen = {r.bucket for r in sums}
    pooled = np.array([sum(getattr(r, f"s{k}") for r in sums) for k in range(3)]) + 1e-3
    for b in range(1, BUCKETS):
        if b not in seen:
            near = [s for s in seen if s < b and s > 0]
            weights[b] = weights[max(near)] if near else pooled / pooled.sum()
    return weights


def scored(texts: list[bytes], words: dict, pairs: dict, shards: int, facts: dict, weights: np.ndarray) -> list[tuple]:
    """n_tokens, n_known, base score and score of each text, from a chunk's answers by shard."""
    tokens, before, lengths = hashed(texts)

    def totals(all_keys, found):
        keys, place = np.unique(all_keys, return_inverse=True)
        out = np.zeros(len(keys), np.int64)
        for s, some in enumerate(by_shard(keys, shards)):
            if len(some):
                out[some] = np.frombuffer(found[s], "<u4")
        return out[place]

    c = totals(tokens, words)
    together = totals(pair_hashes(before, tokens), pairs)
    context = np.empty_like(c)
    context[1:] = c[:-1]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    context[starts] = facts["texts"]
    n, v = facts["tokens"], facts["words"]
    lam = weights[bucket_of(context)]
    p = lam[:, 0] * together / np.maximum(context, 1) + lam[:, 1] * c / max(n, 1) + lam[:, 2] / (v + 1)
    base = np.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    add = lambda x: np.add.reduceat(x, starts)
    return list(zip(lengths.tolist(), add((c > 0).astype(np.int64)).tolist(), add(base).tolist(), add(np.log10(p)).tolist()))


def score_texts(docs: DataFrame, held_out: Column, text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score per row.

    Rows with ``held_out`` are scored and not learnt from. A null or empty text is the end
    token alone. Repeated rows count and are scored each. Without training texts every word
    is unknown and the score is that of the even spread. An empty table gives no rows.
    """
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0]
    chunks, shards = max(1, math.ceil(size / CHUNK_BYTES)), max(1, math.ceil(size / SHARD_BYTES))
    rows = docs.select(
        "doc_id",
        F.pmod(F.xxhash64("doc_id", F.length(F.col(text))), F.lit(chunks)).alias("_chunk"),
        (~held_out).alias("_train"),
        (~held_out & (F.pmod(F.xxhash64("doc_id", F.lit("deleted")), F.lit(FOLDS)) == 0)).alias("_deleted"),
        data.alias("_data"),
    )
    asked = rows.groupBy("_chunk").applyInArrow(lambda t: questions(t, shards), ASKED)
    told = common.staged(asked.groupBy("kind", "shard").applyInArrow(answers, ANSWERED), "lm-answered")
    counts = told.filter(f"kind = {TOTAL}").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("h", "w", "n", "m"))).first()
    vocabulary = told.filter(f"kind = {VOCABULARY}").agg(F.sum("n"), F.sum("m")).first()
    n, gone, texts, texts_gone = (int(v) for v in counts)
    facts = {"tokens": n, "words": int(vocabulary[0] or 0), "texts": texts}

    known = told.filter(f"kind = {KNOWN}").select(F.col("h").alias("_key"), F.col("n").alias("_n"))
    pairs = told.filter(f"kind = {DELETED}").select("h", "w", "n", "m")
    # Frequent words are on many pairs; adaptive execution splits their partitions in these joins.
    pairs = pairs.join(known.select(F.col("_key").alias("h"), F.col("_n").alias("ch")), "h", "left")
    pairs = pairs.join(known.select(F.col("_key").alias("w"), F.col("_n").alias("cw")), "w", "left")
    start = int(START.astype(np.int64))
    ch = F.when(F.col("h") == start, texts - texts_gone).otherwise(F.coalesce("ch", F.lit(0)))
    log2 = F.floor(F.log2(ch + 0.5)).cast("int") + 1
    deleted = pairs.select(
        F.greatest(F.least(log2, F.lit(BUCKETS - 1)), F.lit(0)).alias("bucket"),
        "n",
        (F.col("m") / F.greatest(ch, F.lit(1))).alias("p2"),
        (F.coalesce("cw", F.lit(0)) / F.lit(max(1, n - gone))).alias("p1"),
        F.lit(1.0 / (int(vocabulary[1] or 0) + 1)).alias("p0"),
    )
    weights = mixture_weights(common.staged(deleted, "lm-deleted"))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[dict, dict] = ({}, {})
        for kind, shard, blob in zip(*(right.column(c).to_pylist() for c in ("kind", "shard", "data"))):
            found[kind][shard] = blob
        result = scored(left.column("_data").to_pylist(), *found, shards, facts, weights) if left.num_rows else []
        columns = list(zip(*result)) if result else [(), (), (), ()]
        types = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table(
            [left.column("doc_id"), pc.invert(left.column("_train")), *(pa.array(c, t) for c, t in zip(columns, types))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        )

    replies = told.filter(f"kind in ({WORD}, {PAIR})").select(F.col("chunk").alias("_chunk"), "kind", "shard", "data")
    out = rows.groupBy("_chunk").cogroup(replies.groupBy("_chunk")).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op4_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return score_texts(docs, common.crc_mod(F.col("doc_id"), 5) == 1)
