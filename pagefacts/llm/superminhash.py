"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union of links.

A signature slot is the least ``round + fraction`` over all shingles; in round ``j`` each
shingle visits the slot its own random permutation has at ``j``. Rounds end as soon as no
slot can still fall, which for long texts is after a few. Bands of equal slots propose
links, sketches discard hopeless ones, and the full shingle sets decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .common import GOLDEN, mixed, slices, words_of

SLOTS, ROWS = 192, 6  # 32 bands: a pair at 0.8 is missed 6 times in 100,000, at 0.85 3 in 10 million
BLOCK = 8192  # shingles worked on at once
SLACK = 0.16  # a sketch this far below the threshold (six deviations) is hopeless: that loses far less than the bands do
ROUNDS = 2  # rounds in which each open bucket compares one more of its nodes with all others
BATCH_BYTES = 4_000_000


def word_hashes(texts: list[list[bytes]]) -> list[np.ndarray]:
    """64-bit hashes of the words of each text; each different word is hashed once."""
    index: dict[bytes, int] = {}
    for words in texts:
        index.update(dict.fromkeys(words, 0))
    if not index:
        return [np.empty(0, np.uint64) for _ in texts]
    index = {w: i for i, w in enumerate(index)}
    keys = np.empty(len(index), object)
    keys[:] = list(index)
    hashes = pd.util.hash_array(keys, categorize=False)
    return [hashes[np.fromiter(map(index.__getitem__, words), np.int64, len(words))] for words in texts]


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``width`` words; of fewer words the whole run; of none nothing."""
    n = len(words)
    if not n:
        return words
    size = min(width, n)
    out = np.full(n - size + 1, np.uint64(size))
    for k in range(size):
        out = mixed((out + GOLDEN) ^ words[k : n - size + 1 + k])
    return np.unique(out)


def signature(items: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of a set of 64-bit numbers, as unsigned 64-bit: round in the high, fraction in the low half."""
    out = np.full(slots, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), BLOCK):
        block = items[at : at + BLOCK]
        n = len(block)
        order = np.broadcast_to(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (n, slots)).copy()
        row = np.arange(n)
        with np.errstate(over="ignore"):
            for j in range(slots):
                if int(out.max()) >> 32 < j:
                    break
                draw = mixed(block + np.uint64(j + 1) * GOLDEN)
                other = j + ((draw >> np.uint64(32)) % np.uint64(slots - j)).astype(np.int64)
                here = order[row, other]
                order[row, other] = order[:, j]
                order[:, j] = here
                np.minimum.at(out, here, (np.uint64(j) << np.uint64(32)) | (draw & np.uint64(0xFFFFFFFF)))
    return out


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A signed 64-bit key per band; equal slots of one band give equal keys."""
    parts = sig.reshape(-1, rows)
    with np.errstate(over="ignore"):
        out = np.arange(1, len(parts) + 1, dtype=np.uint64)
        for k in range(rows):
            out = mixed((out + GOLDEN) ^ parts[:, k])
    return out.view(np.int64)


def sets_of(texts: list[bytes], width: int) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        return [shingle_set(h, width) for h in word_hashes([words_of(t) for t in texts])]


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links: these are looked at between components only, of which few move."""
    of = lambda end: found.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
    lifted = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    moved = components(lifted.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")))
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    out = found.join(to, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    out = common.staged(out.unionByName(moved.join(found.select("node"), "node", "left_anti")), "components")
    common.dropped(moved, found)
    return out


def text_key(text: str) -> Column:
    """A number for a row's id and text, never null; equal for repeated rows."""
    return F.xxhash64("doc_id", text).alias("_key")


def signed(docs: DataFrame, text: str, width: int, keep: tuple[Column, ...] = ()) -> DataFrame:
    """doc_id, ``keep``, a key of id and text, n_shingles, digest of the set, band keys and a byte for each slot."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_data", BATCH_BYTES):
            sizes, digests, bands, sketches = [], [], [], []
            for items in sets_of(batch.column("_data").to_pylist(), width):
                sizes.append(len(items))
                if len(items):
                    sig = signature(items)
                    digests.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(sig))
                    with np.errstate(over="ignore"):
                        sketches.append((mixed(sig) >> np.uint64(56)).astype(np.uint8).tobytes())
                else:
                    digests.append(None)
                    bands.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in names), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary()),
                ],
                names=[*names, "n_shingles", "digest", "bands", "sketch"],
            )

    source = common.in_bytes(docs, text, "doc_id", *keep, text_key(text))
    names = source.columns[:-1]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(work, f"{kept}, n_shingles long, digest binary, bands array<long>, sketch binary")


def promising(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose sizes allow the threshold and whose sketches come within SLACK of it."""
    facts = nodes.select("node", "n_shingles", "sketch")
    a = facts.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("ka"))
    b = facts.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("kb"))
    least, most = F.least("na", "nb"), F.greatest("na", "nb")
    rows = pairs.join(a, "a").join(b, "b").filter(100 * least >= round(100 * threshold) * most)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in ("ka", "kb"))
                keep = (x == y).mean(1) >= threshold - SLACK
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return rows.select("a", "b", "ka", "kb").mapInArrow(near, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float, width: int) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold: 100 * common >= 100 * threshold * union."""
    b = texts.select(F.col("node").alias("b"), F.col("_data").alias("tb"))
    a = texts.select(F.col("node").alias("a"), F.col("_data").alias("ta"))
    rows = pairs.join(b, "b").join(a, "a").select("a", "b", "ta", "tb")
    percent = round(100 * threshold)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in slices(batches, "tb", BATCH_BYTES):
            for batch in slices(iter([whole]), "ta", BATCH_BYTES):
                lefts = batch.column("ta").to_pylist()
                names = {t: i for i, t in enumerate(dict.fromkeys(lefts))}
                sets = sets_of([*names, *batch.column("tb").to_pylist()], width)
                keep = []
                for i, t in enumerate(lefts):
                    x, y = sets[names[t]], sets[len(names) + i]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(confirm, "a long, b long")


def crossing(nodes: DataFrame, texts: DataFrame, threshold: float, width: int) -> DataFrame:
    """Pairs (a, b) of nodes of different components whose sets can reach the threshold.

    Only shingles held in several components count. Of sets ordered by one rule, rarest first,
    two that reach the threshold share one among the first few of each (the prefix filter). At the
    first they share, what comes behind it in either set bounds what they have in common, so a
    pair is met where that suffices: at its first shared shingle, and at few later ones. Nodes whose
    own shingles alone fill the first few meet nothing. No pair that reaches the threshold is left out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_data", BATCH_BYTES):
            sets = sets_of(batch.column("_data").to_pylist(), width)
            sizes = np.array([len(x) for x in sets], np.int64)
            held = [pa.array(np.repeat(np.asarray(batch.column(k)), sizes)) for k in ("node", "component")]
            items = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([*held, pa.array(np.repeat(sizes, sizes)), pa.array(items)], names=["node", "component", "n", "item"])

    percent = round(100 * threshold)
    items = texts.join(nodes, "node").select("node", "component", "_data").mapInArrow(work, "node long, component long, n long, item long")
    items = common.staged(items, "items")
    # Places are counted among shingles that several components hold: all that nodes of different ones can share.
    counts = F.count("*").alias("holders"), F.min("component").alias("c0"), F.max("component").alias("c1")
    several = items.groupBy("item").agg(*counts).filter("c0 < c1").select("item", "holders")
    one = Window.partitionBy("node")
    rows = items.join(several, "item").withColumn("place", F.row_number().over(one.orderBy("holders", "item"))).withColumn("held", F.count("*").over(one))
    # Shingles of its own component only come first; of n, all but the least overlap and one more are looked at.
    first = F.expr(f"n - ({percent} * n + 99) div 100 + 1")
    rows = common.staged(rows.filter(F.col("n") - F.col("held") + F.col("place") <= first), "prefixes")
    common.dropped(items)
    x, y = (rows.select("item", *(F.col(c).alias(f"{c}_{k}") for c in ("node", "component", "n", "place", "held"))) for k in "xy")
    most = 1 + F.least(F.col("held_x") - F.col("place_x"), F.col("held_y") - F.col("place_y"))
    can = (100 + percent) * most >= percent * (F.col("n_x") + F.col("n_y"))
    met = x.join(y, (x["item"] == y["item"]) & (F.col("node_x") < F.col("node_y")) & (F.col("component_x") != F.col("component_y")) & can)
    pairs = common.staged(met.select(F.col("node_x").alias("a"), F.col("node_y").alias("b")).distinct(), "crossing")
    common.dropped(rows)
    return pairs


def components(links: DataFrame) -> DataFrame:
    """node and its component's least node, for nodes of ``links`` (a, b).

    Alternating large and small stars: links move to the least neighbour until all point at
    their component's least node. Each round is a table in the scratch folder.
    """

    def least_neighbour(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("m", "u").alias("m"))
        return edges.join(least, F.col("u") == F.col("k")).drop("k")

    def both(edges: DataFrame) -> DataFrame:
        return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def mark(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges = common.staged(edges, "links")
    before = mark(edges)
    while True:
        large = least_neighbour(both(edges)).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = least_neighbour(large.filter("u <> v").distinct())
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        last, edges = edges, common.staged(small.filter("u <> v").distinct(), "links")
        common.dropped(last)
        now = mark(edges)
        if now == before:
            break
        before = now
    low = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    found = low.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    found = common.staged(found, "components")
    common.dropped(edges)
    return found


def near_duplicates(docs: DataFrame, text: str = "text", width: int = 5, threshold: float = 0.8, keep: tuple[Column, ...] = ()) -> DataFrame:
    """doc_id, ``keep``, n_shingles, component_id (least doc_id of the group), kept and stays, one row per row.

    Rows with equal shingle sets are one node, however many; nodes are linked when their sets
    reach ``threshold`` (in hundredths). Null and empty texts have no shingles and are linked
    with nothing. Rows with a null doc_id take part; their group's id is the least known one, null
    where none is. ``kept`` says that the row has its group's id. ``stays`` is true for exactly one row
    of each group, one with its id if any has one, and for each row without shingles.

    In each band bucket all nodes are compared with its first and its last. While that leaves
    a bucket in several components, one more of its nodes is compared with those of the other
    components, as long as rounds find links; at last ``crossing`` gives all pairs of such
    buckets that can still link components. So no link that could join groups is lost to
    a bucket's size, and a large group of copies costs a few times its number of rows.
    """
    rows = common.staged(signed(docs, text, width, keep).withColumn("_row", F.monotonically_increasing_id()), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row", "_key")).alias("first")
    nodes = rows.filter("n_shingles > 0").groupBy("digest").agg(
        first, F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    nodes = common.staged(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    member = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = member.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    members = common.staged(member.join(buckets, "bucket"), "members")

    def pairs(x, y) -> DataFrame:
        return members.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))

    stars = pairs("low", "node").unionByName(pairs("high", "node")).filter("a < b").distinct()
    stars = common.staged(promising(stars, nodes, threshold), "stars")
    involved = members.select("node").distinct().join(nodes.select("node", "digest", "first._key"), "node")
    texts = _texts(docs, text, involved, width)
    links = common.staged(verified(stars, texts, threshold, width), "verified")
    scratch = [members, stars, texts, links]  # what goes when the groups stand

    def still_open(found: DataFrame) -> DataFrame:
        """Members of the buckets that still hold several components."""
        placed = members.select("bucket", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        placed = common.staged(placed, "placed")
        several = placed.groupBy("bucket").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 < c1")
        out = common.staged(placed.join(several.select("bucket"), "bucket"), "open")
        common.dropped(placed)
        return out

    done, groups = stars, components(links)
    rest = still_open(groups)
    for turn in range(ROUNDS):
        # Another node of each open bucket, in no order of its own, meets the other components.
        draw = F.min(F.struct(F.xxhash64("node", F.lit(turn)), F.col("node").alias("x"), F.col("component").alias("cx"))).alias("one")
        one = rest.groupBy("bucket").agg(draw).select("bucket", "one.x", "one.cx")
        met = rest.join(one, "bucket").filter("component <> cx").select(F.least("node", "x").alias("a"), F.greatest("node", "x").alias("b"))
        met = common.staged(promising(met.distinct().join(done, ["a", "b"], "left_anti"), nodes, threshold), "met")
        more = common.staged(verified(met, texts, threshold, width), "verified")
        done = done.unionByName(met)
        scratch += [met, more]
        if more.isEmpty():
            break
        groups = merged(groups, more)
        common.dropped(rest)
        rest = still_open(groups)
    met = crossing(rest.select("node", "component").distinct(), texts, threshold, width)
    across = common.staged(met.join(done, ["a", "b"], "left_anti"), "across")
    common.dropped(rest, met)
    more = common.staged(verified(across, texts, threshold, width), "verified")
    if not more.isEmpty():
        groups = merged(groups, more)
    common.dropped(*scratch, across, more)
    named = nodes.select("node", "digest", "first").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    of_digest = named.join(least, "component").select("digest", F.col("least.doc_id").alias("component_id"), F.col("least._row").alias("_least"))
    of_digest = common.staged(of_digest, "groups")
    common.dropped(groups, nodes)
    own_columns = [c for c in rows.columns if c not in ("digest", "bands", "sketch", "_key", "_row")]
    out = rows.select(*own_columns, "digest", "_row").join(of_digest, "digest", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", own)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select(*own_columns, "component_id", kept.alias("kept"), F.coalesce(F.col("_row") == F.col("_least"), F.lit(True)).alias("stays"))


def _texts(docs: DataFrame, text: str, involved: DataFrame, width: int) -> DataFrame:
    """node and text of the rows whose key is a node's, checked by digest."""
    some = common.in_bytes(docs, text, text_key(text)).join(involved, "_key").select("node", "digest", "_data")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_data", BATCH_BYTES):
            sets = sets_of(batch.column("_data").to_pylist(), width)
            keep = [len(s) > 0 and hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d for s, d in zip(sets, batch.column("digest").to_pylist())]
            yield batch.select(["node", "_data"]).filter(pa.array(keep, pa.bool_()))

    # Repeated rows have one key: one of each is enough.
    return common.staged(some.mapInArrow(check, "node long, _data binary").dropDuplicates(["node"]), "texts")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.read(spark, sf_dir, "documents"), width=3, threshold=0.85).drop("stays")
