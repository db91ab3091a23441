"""A training corpus from raw documents: reject, deduplicate, redact, mix, pack.

Each stage takes all documents its predecessor kept and is written as Parquet before the
next one reads it; ``run`` does so in the shared scratch folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagefacts.llm import common, mixing, packing, pii, superminhash, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def row_key():
    """A number for a row's id and text, never null; equal for repeated rows."""
    return F.xxhash64("doc_id", "text").alias("row_key")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold, learnt from all labels; columns of documents.

    Null and empty texts stay.
    """
    docs = docs.select(*COLUMNS)
    model = toxicity.fit(docs, common.read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    rows = toxicity.score_toxicity(docs, model, keep=COLUMNS)
    return rows.filter(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8), whatever ids its rows have.

    Documents without words are in no group; of repeated rows one stays.
    """
    docs = docs.select(*COLUMNS)
    groups = superminhash.near_duplicates(docs, keep=(row_key(),))
    kept = groups.filter("stays").select("row_key").distinct()
    return docs.select("*", row_key()).join(kept, "row_key").dropDuplicates(["row_key"]).select(*COLUMNS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind; n_chars follows changed texts."""
    docs = docs.select(*COLUMNS)
    rows = pii.find_pii(docs, pii.fit(docs), keep=COLUMNS, redact=True)
    n_chars = F.when(F.col("redacted").isNotNull(), F.length("redacted")).otherwise(F.col("n_chars")).cast("long")
    return rows.select(*(c.alias(name) for name, c in {
        "doc_id": F.col("doc_id"), "text": F.coalesce("redacted", "text"), "lang": F.col("lang"), "source": F.col("source"), "n_chars": n_chars,
    }.items()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (0 to 3 times); those without words stay once."""
    docs = docs.select(*COLUMNS)
    mixed = mixing.mix(docs.select("*", row_key()), key="row_key")
    copies = mixed.filter("copies > 0").select("row_key", "copies").distinct()
    rows = docs.select("*", row_key()).join(copies, "row_key")
    return rows.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences, as ``packing.pack_documents`` gives them."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", redact_pii),
    ("mixing", mix_sources),
    ("packing", pack),
]

ORACLE_SQL = None  # trained models and signatures: tested against brute force and held-out labels


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = common.read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last is not None:
            common.dropped(last)
        last = docs
    return docs
