"""URLs a crawl has seen, laid out by key, so that a round shuffles its new links only.

The table is a folder of Parquet files in buckets of the URL key. Each round appends its keys
to the buckets; compaction brings a bucket's files together again. Rows carry the round that
wrote them, so a round that runs again does not find its own keys.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import links

SCHEMA = "url_key STRING, round BIGINT"


class SeenTable:
    """Keys of all URLs seen so far, under ``path``, in ``buckets`` of ``url_key``.

    ``path`` holds a folder for each generation; the newest whole one counts. The number of buckets
    stays that of the first use: choose it so that a bucket of all keys to come fits a task.
    A session knows the folder as a table of its own catalog, which is only a name for the files.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.generation = max(self._generations(), default=0)
        self.name = self._register(self.generation)

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _generations(self) -> list[int]:
        """Numbers of the generations that are whole: the first, and those a compaction has finished."""
        files, path = self._files()
        if not files.exists(path):
            return []
        names = [(f.getPath().getName(), f.getPath()) for f in files.listStatus(path)]
        numbers = [(int(m.group(1)), p) for n, p in names if (m := re.fullmatch(r"generation=(\d+)", n))]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return [n for n, p in numbers if n == 0 or files.exists(done(p, "_COMPACTED"))]

    def _folder(self, generation: int) -> str:
        return f"{self.path}/generation={generation}"

    def _register(self, generation: int) -> str:
        """A table over a generation's files; their names tell their buckets."""
        name = f"seen_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({SCHEMA}) USING parquet CLUSTERED BY (url_key) SORTED BY (url_key) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self._folder(generation)}'"
        )
        return name

    def keys(self, before: int | None = None) -> DataFrame:
        """Seen keys, of rounds before the given one."""
        rows = self.spark.table(self.name)
        return rows if before is None else rows.filter(F.col("round") < before)

    def new_links(self, found: DataFrame, turn: int, url: str = "url", keep=("url",)) -> DataFrame:
        """url_key and ``keep`` of links no round before ``turn`` has seen, each key once, the smallest link of it."""
        return links.unseen_links(found, self.keys(turn), self.buckets, url, keep)

    def add(self, rows: DataFrame, turn: int, url: str | None = None) -> None:
        """Append keys (those of a ``url`` column, or ``url_key`` as it is) as seen in round ``turn``."""
        key = F.col("url_key") if url is None else urls.url_unique_key(F.col(url))
        fresh = rows.select(key.alias("url_key")).distinct().withColumn("round", F.lit(turn).cast("bigint"))
        # One file per bucket and round.
        self._write(fresh.repartition(self.buckets, "url_key"), self.name)

    def _write(self, rows: DataFrame, name: str) -> None:
        writer = rows.select("url_key", "round").write.mode("append").format("parquet")
        writer.bucketBy(self.buckets, "url_key").sortBy("url_key").saveAsTable(name)
        self.spark.catalog.refreshTable(name)

    def compact(self) -> None:
        """Write the next generation, one file a bucket and each key once with its first round; then let the old one go.

        Buckets are read and written where they lie: nothing is shuffled. Until the mark of the
        new generation is written the old one counts, so a failed compaction changes nothing.
        """
        following = self.generation + 1
        files, _ = self._files()
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        files.delete(path(self._folder(following)), True)
        name = self._register(following)
        self._write(self.keys().groupBy("url_key").agg(F.min("round").alias("round")), name)
        files.create(path(f"{self._folder(following)}/_COMPACTED")).close()
        old, self.name = self.name, name
        self.spark.sql(f"DROP TABLE {old}")
        files.delete(path(self._folder(self.generation)), True)
        self.generation = following
