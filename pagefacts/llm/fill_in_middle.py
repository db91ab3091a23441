"""Fill-in-middle: documents cut at line ends into prefix, middle and suffix, the middle moved last.

A rolling hash cuts each text into chunks where its last bytes say so, so passages that many
texts share give the same chunks. What a cut needs to know of a chunk (lines, code points,
the bytes at its two ends) is kept by the chunk's whole content; the summaries of a text's
chunks, combined, tell how many lines it has and in which chunk a cut lies, and only that
chunk is looked into.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import mixed, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode())
EDGE = 2  # bytes kept of a chunk's ends: one less than a mark has
WINDOW = 32  # bytes the rolling hash looks back on
CUT = np.uint32(0x3FF << 22)  # a chunk ends where these ten bits are 0: every 1,024 bytes on average
LONGEST = 1 << 16  # bytes of a chunk at most; a longer one is cut from its start on
KEPT_BYTES = 16_000_000  # chunks a task remembers, in each of two generations
BATCH_BYTES = 8_000_000


class Summary(NamedTuple):
    """What counts of a run of bytes: summaries of neighbours combine to that of both."""

    lines: int
    chars: int
    marked: bool
    head: bytes
    tail: bytes


NOTHING = Summary(0, 0, False, b"", b"")


def summary_of(chunk: bytes) -> Summary:
    """Line feeds, code points (bytes that begin one, so a cut inside a character counts right), marks, ends."""
    chars = len(chunk) if chunk.isascii() else int(((np.frombuffer(chunk, np.uint8) & 0xC0) != 0x80).sum())
    return Summary(chunk.count(b"\n"), chars, any(m in chunk for m in MARKS), chunk[:EDGE], chunk[-EDGE:])


def combined(a: Summary, b: Summary) -> Summary:
    """Summary of two neighbouring runs; a mark may lie across their border."""
    border = a.tail + b.head
    marked = a.marked or b.marked or any(m in border for m in MARKS)
    head = a.head if len(a.head) == EDGE else (a.head + b.head)[:EDGE]
    tail = b.tail if len(b.tail) == EDGE else (a.tail + b.tail)[-EDGE:]
    return Summary(a.lines + b.lines, a.chars + b.chars, marked, head, tail)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte a 32-bit hash of the WINDOW bytes up to it: sums of shifted table entries, doubled in length."""
    table = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
    out = table[data]
    reach = 1
    while reach < WINDOW:
        out[reach:] += out[:-reach] << np.uint32(reach)
        reach *= 2
    return out


def chunk_ends(texts: list[bytes]) -> list[list[int]]:
    """Ends of each text's chunks; they follow from the text alone."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    found = np.flatnonzero((rolling_hash(data) & CUT) == 0) + 1 if len(data) else np.empty(0, np.int64)
    out, start = [], 0
    for text in texts:
        low, high = np.searchsorted(found, [start + WINDOW, start + len(text)])
        ends, last = [], 0
        for end in [*(found[low:high] - start).tolist(), len(text)]:
            ends += range(last + LONGEST, end, LONGEST)
            if end > last:
                ends.append(end)
            last = end
        out.append(ends)
        start += len(text)
    return out


class Chunks:
    """Summaries of chunks by their content, for as long as a task runs.

    A dictionary finds an entry only where the whole content is equal, so a shared hash is
    never taken for a shared chunk. Two generations of KEPT_BYTES bound what is held.
    """

    def __init__(self, most: int = KEPT_BYTES):
        self.new, self.old, self.held, self.most = {}, {}, 0, most
        self.hits = 0

    def summary(self, chunk: bytes) -> Summary:
        found = self.new.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        found = self.old.get(chunk)
        if found is None:
            found = summary_of(chunk)
        else:
            self.hits += 1
        self.held += len(chunk) + 200
        if self.held > self.most:
            self.old, self.new, self.held = self.new, {}, len(chunk) + 200
        self.new[chunk] = found
        return found


class Text:
    """One text as its chunks' summaries: counts, and the place of any line's end."""

    def __init__(self, data: bytes, ends: list[int], chunks: Chunks):
        self.data, self.ends = data, ends
        parts = [chunks.summary(data[a:b]) for a, b in zip([0, *ends], ends)]
        total = NOTHING
        for part in parts:
            total = combined(total, part)
        self.total = total
        self.lines = list(accumulate(p.lines for p in parts))
        self.chars = list(accumulate((p.chars for p in parts), initial=0))
        # The last line may have no line feed.
        self.n = total.lines + (1 if data and total.tail[-1:] != b"\n" else 0)

    def after(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` lines."""
        if units == 0:
            return 0, 0
        if units > self.total.lines:
            return len(self.data), self.total.chars
        i = bisect_left(self.lines, units)
        start = self.ends[i - 1] if i else 0
        chunk = self.data[start : self.ends[i]]
        at = -1
        for _ in range(units - (self.lines[i - 1] if i else 0)):
            at = chunk.index(b"\n", at + 1)
        return start + at + 1, self.chars[i] + summary_of(chunk[: at + 1]).chars


def draws(key: str, seed: int) -> list[int]:
    """Four numbers of 32 bits from a row's key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def arranged(text: Text, key: str, seed: int, rate: int, spm_rate: int) -> tuple[int, str, int | None, int | None, bytes]:
    """Lines, form, code points of prefix and middle, and the output of one text."""
    h1, h2, h3, h4 = draws(key, seed)
    data = text.data
    if not data or text.total.marked or h3 % 100 >= rate:
        return text.n, "plain", None, None, data
    cuts = sorted((h1 % (text.n + 1), h2 % (text.n + 1)))
    (first, first_chars), (second, second_chars) = map(text.after, cuts)
    prefix, middle, suffix = data[:first], data[first:second], data[second:]
    p, s, m = MARKS
    if h4 % 100 < spm_rate:
        return text.n, "spm", first_chars, second_chars - first_chars, b"".join((s, suffix, p, prefix, m, middle))
    return text.n, "psm", first_chars, second_chars - first_chars, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(
    docs: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), seed: int = 7, rate: int = 100, spm_rate: int = 50
) -> DataFrame:
    """``keep``, n (lines), form (plain, psm or spm), prefix_chars, middle_chars and output, one row per row.

    The prefix ends after one of two line ends drawn from sha256 of ``seed:key``, the middle after
    the other. ``rate`` in a hundred texts are rearranged, of those ``spm_rate`` in a hundred with the
    suffix first. Null and empty texts, and texts that hold one of the three marks, stay plain;
    their lengths are null. A null key counts as an empty one. Repeated rows stay rows and
    give equal output; no other column is read, so any may be there. A ``keep`` column may
    not have the name of a result.
    """
    results = ("n", "form", "prefix_chars", "middle_chars", "output")
    common.no_clash(keep, results)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks()
        for batch in slices(batches, "_data", BATCH_BYTES):
            texts = batch.column("_data").to_pylist()
            keys = batch.column("_key").to_pylist()
            rows = [arranged(Text(t, ends, chunks), k, seed, rate, spm_rate) for t, ends, k in zip(texts, chunk_ends(texts), keys)]
            n, form, first, middle, output = map(list, zip(*rows)) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in keep), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                    pa.array(first, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()),
                ],
                names=[*keep, *results],
            )

    source = common.in_bytes(docs, text, *keep, F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.select(*keep).schema)
    out = source.mapInArrow(work, f"{kept}n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from, from output and form alone; null gives null."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(common.read(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


SQL = {
    "op11_fill_in_middle": r"""
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
        ),
        lines AS (
            SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS l,
                   CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                   CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
            FROM texts
        ),
        cuts AS (
            SELECT *, CAST(len(l) AS BIGINT) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b
            FROM lines
        ),
        parts AS (
            SELECT *, array_to_string(l[1:a], '') AS p, array_to_string(l[a + 1:b], '') AS m, array_to_string(l[b + 1:], '') AS s,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
            FROM cuts
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts
    """
}
