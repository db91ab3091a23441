"""The crawl as a stream: pages arrive as files, verdicts and links leave as tables.

Batches are written with overwrite under their own batch id, so a batch that runs again
after a lost executor or driver replaces its first try and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import urls
from ..operators import gate, links
from ..session import scratch_path
from ..sources.seen import SeenTable


def _start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()


def append_batches(stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Write each batch to ``path/batch_id=n`` and replace it on a second run."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")

    return _start(stream, write, checkpoint, "append")


def gate_stream(pages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Verdict per page; good pages and quarantine leave in one write, split by verdict."""
    verdict = F.coalesce("error_type", F.lit(gate.PASS))
    gated = gate.page_gate(pages).withColumn("verdict", verdict)
    return append_batches(gated, path, checkpoint, ("verdict",))


def read_gate(spark: SparkSession, path: str, good: bool) -> DataFrame:
    rows = spark.read.parquet(path).drop("batch_id")
    passed = F.col("verdict") == gate.PASS
    return rows.filter(passed if good else ~passed)


def links_stream(pages: DataFrame, path: str, checkpoint: str, extract=links.pagination_links) -> StreamingQuery:
    """Links of each page; no state."""
    return append_batches(extract(pages), path, checkpoint)


def first_seen_stream(
    found: DataFrame, path: str, checkpoint: str, arrival: str | None = None, delay: str = "1 day"
) -> StreamingQuery:
    """Each URL once over the whole run.

    Keys are remembered for ever, in RocksDB on disk; with an arrival time they are
    forgotten once no copy can still be within ``delay``.
    """
    keyed = found.withColumn("url_key", urls.url_unique_key(F.col("url")))
    if arrival is None:
        fresh = keyed.dropDuplicates(["url_key"])
    else:
        fresh = keyed.withWatermark(arrival, delay).dropDuplicatesWithinWatermark(["url_key"])
    return append_batches(fresh, path, checkpoint)


def first_seen_table_stream(found: DataFrame, path: str, checkpoint: str, seen: SeenTable, first_round: int = 1) -> StreamingQuery:
    """Each URL once, checked against a table of seen URLs instead of keys held as state.

    A batch is a round of the table: its new links are written first, then added to the seen keys
    from what was written. A batch that runs again after either step finds the same links, as
    it does not look at its own round, and replaces them; keys added twice change nothing. Rounds
    begin at ``first_round``, to be set after the last round of the table for a new checkpoint.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out, turn = f"{path}/batch_id={batch_id}", first_round + batch_id
        seen.new_links(batch, turn, keep=tuple(batch.columns)).write.mode("overwrite").parquet(out)
        seen.add(seen.spark.read.parquet(out), turn)

    return _start(found, write, checkpoint, "append")


def status_counts_stream(pages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Running counts by site and verdict; the table always holds the latest totals.

    Totals of a batch go to their own folder; the reader takes the newest row of each key.
    """
    site = urls.site_key(F.col("url"), invalid="unknown").alias("site")
    # Selected first, so that the state knows its keys by these names.
    verdicts = gate.page_gate(pages).select(site, F.coalesce("error_type", F.lit(gate.PASS)).alias("verdict"))
    counts = verdicts.groupBy("site", "verdict").agg(F.count("*").alias("n"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return _start(counts, write, checkpoint, "update")


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.parquet(path)
        .groupBy("site", "verdict")
        .agg(F.max_by("n", "batch_id").alias("n"))
    )


def current_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The latest totals from the stream's own state: what is read follows the number of keys, not of batches."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.site", "key.verdict", F.col("value.count").alias("n"))


def run(spark: SparkSession, start: Callable[..., StreamingQuery], source: DataFrame, **options) -> str:
    """Drain a source into a fresh folder and return the folder; the checkpoint lies beside it."""
    base = scratch_path(spark, start.__name__)
    run_to_end(start(source, f"{base}/out", f"{base}/checkpoint", **options))
    return f"{base}/out"


def checkpoint_of(path: str) -> str:
    """Where ``run`` keeps the checkpoint of the folder it returned."""
    return path.removesuffix("out") + "checkpoint"
