"""Tables, scratch tables, Arrow batches and word rules shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run without these characters: blank, tab, line feed, and the three after it.
SPACES = " \t\n\x0b\x0c\r"
WORD_SQL = r"[^\x20\x09-\x0D]+"
GAP_SQL = r"[\x20\x09-\x0D]+"
BATCH_ROWS = 5000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later jobs start from the
    files, and a lost executor costs no recomputation."""
    from ..session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by ``staged`` once no result that is still to be computed reads them."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def task_partitions(spark: SparkSession) -> int:
    """Shuffle partitions the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_bytes(df: DataFrame, text: str, *keep: str | Column) -> DataFrame:
    """``keep`` columns and the text as UTF-8 bytes, null as empty: what tasks take."""
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_data")
    return df.select(*keep, data)


def slices(batches: Iterator[pa.RecordBatch], column: str, budget: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most BATCH_ROWS rows whose ``column`` holds about ``budget``
    bytes at most (or one row): large batches are cut, small ones joined, whatever the session sends."""
    pieces, rows, held = [], 0, 0

    def joined() -> pa.RecordBatch:
        if len(pieces) == 1:
            return pieces[0]
        return pa.Table.from_batches(pieces).combine_chunks().to_batches()[0]

    for batch in batches:
        start = 0
        for i, size in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            size = size or 0
            if rows and (held + size > budget or rows == BATCH_ROWS):
                if i > start:
                    pieces.append(batch.slice(start, i - start))
                yield joined()
                pieces, rows, held, start = [], 0, 0, i
            rows, held = rows + 1, held + size
        if start < batch.num_rows:
            pieces.append(batch.slice(start))
    if pieces:
        yield joined()
    pieces.clear()
    pa.default_memory_pool().release_unused()


class Remembered:
    """Values of words, kept for as long as a task runs; the words of a generation hold at most ``most`` bytes.

    Two generations: words met since the younger one began move into it, and when it is full
    it becomes the older. With the task both go, so a worker that is used again holds nothing.
    """

    OVERHEAD = 200  # bytes a word costs besides its characters: key, value and their places

    def __init__(self, most: int):
        self.new, self.old, self.held, self.most = {}, {}, 0, most

    def peek(self, word):
        value = self.new.get(word)
        return self.old.get(word) if value is None else value

    def keep(self, word, value) -> None:
        self.new[word] = value
        self.held += len(word) + self.OVERHEAD

    def values(self, words: list, learn) -> list:
        """The value of each word; ``learn`` makes those of a list of words not remembered."""
        old = self.old
        out = list(map(self.new.get, words))
        missing = []
        for i in [i for i, v in enumerate(out) if v is None]:
            value = old.get(words[i])
            if value is None:
                missing.append(i)
            else:
                out[i] = value
                self.keep(words[i], value)
        if missing:
            for i, value in zip(missing, learn([words[i] for i in missing])):
                out[i] = value
                if len(words[i]) <= 48:
                    self.keep(words[i], value)
        if self.held > self.most:
            self.old, self.new, self.held = self.new, {}, 0
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def no_clash(keep: Iterable[str], results: Iterable[str]) -> None:
    """Columns passed through may not have the name of a result."""
    both = {k.lower() for k in keep} & {r.lower() for r in results}
    if both:
        raise ValueError(f"rename these columns first: {sorted(both)}")


def words_of(data: bytes) -> list[bytes]:
    """Words of UTF-8 text with A-Z lower-cased; both steps only touch ASCII bytes."""
    return data.lower().split()


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids count as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def n_words(text: Column) -> Column:
    """Words of a text, null as 0."""
    marks = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.when(F.trim(marks) == "", 0).otherwise(
        F.size(F.split(F.trim(marks), " +"))
    ).cast("long")
