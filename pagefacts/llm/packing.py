"""Hierarchical multi-length packing: tiers of windows, gaps filled from shorter tiers.

Each task packs the documents it reads. Full windows are cut off a document first; the
rest goes to the smallest tier that holds it. A tier is packed when its pool is full:
longest rest first, then the gap of each window is filled with the largest rests of
shorter tiers that fit, and at last with a cut from the shortest one. When all is packed,
the sequences of a tier are numbered over all tasks and form step groups of the same number
of tokens: only the last group of a tier may hold fewer.
"""

from __future__ import annotations

import bisect
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .common import Remembered, slices

TIERS = (512, 1024, 2048, 4096)
END = 2
POOL = 256  # rests a tier holds before it is packed
STEP_TOKENS = 1 << 18
TASK_BITS = 40  # of a sequence id are its number within the task
KNOWN_MAX = 48_000_000  # bytes of words a task remembers, in each of two generations
KNOWN_BYTES = 48
BATCH_BYTES = 12_000_000
SIGNS = frozenset(".,;:!?*$%&#|")  # one of them after letters is a pre-token of its own
PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ("tier", pa.int64()), ("place", pa.int64()),
    ]
)
PIECES_SQL = ", ".join(f"{f.name} long" for f in PIECES)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    White space is dropped by this tokenizer and ends every pre-token, so the ids of a text
    are those of its words in a row. Words are cut at blanks, tabs and line feeds; other
    white space stays inside a word and is left to the library. Words of letters alone are
    one pre-token, whose last id is marked in the vocabulary: many are encoded as one string
    and told apart by the marks.
    """

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        suffix = json.loads(content)["model"].get("end_of_word_suffix") or "</w>"
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
        self.known = Remembered(KNOWN_MAX)
        self.signs: dict[str, bytes] = {}
        self.special = [x["content"].encode() for x in json.loads(content)["added_tokens"]]

    def encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters alone."""
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):  # a letter that lower case turns into several signs
            return [self.encoded(w) for w in words]
        data = ids.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def learn(self, fresh: list[bytes]) -> list[bytes]:
        """Ids of each of some different words."""
        out: list[bytes] = [b""] * len(fresh)
        stems: dict[str, int] = {}
        parts: list[tuple[int, int, str]] = []
        for i, word in enumerate(fresh):
            string = word.decode("utf-8", "replace")
            stem, sign = string, ""
            if not string.isalpha() and string[-1:] in SIGNS:
                stem, sign = string[:-1], string[-1]
            if stem.isalpha() and len(word) <= KNOWN_BYTES and (not sign or stem.lower().isalpha()):
                parts.append((i, stems.setdefault(stem, len(stems)), sign))
            elif word:
                out[i] = self.encoded(string)
        found: list[bytes | None] = [self.known.peek(stem.encode()) for stem in stems]
        new = [(k, stem) for stem, k in stems.items() if found[k] is None]
        for at in range(0, len(new), 1000):
            some = new[at : at + 1000]
            for (k, _), data in zip(some, self.of_letters([stem for _, stem in some])):
                found[k] = data
        for sign in {sign for _, _, sign in parts if sign and sign not in self.signs}:
            self.signs[sign] = self.encoded(sign)
        for i, k, sign in parts:
            out[i] = found[k] + self.signs[sign] if sign else found[k]
        return out

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text: different words are looked up once, ids gathered by position."""
        if not texts:
            return []
        # The tokenizer lower-cases all but its special strings.
        lower = [t if any(s in t.lower() for s in self.special) else t.lower() for t in texts]
        words = pc.split_pattern(pa.array([t.replace(b"\n", b" ").replace(b"\t", b" ") for t in lower], pa.binary()), b" ")
        coded = words.flatten().dictionary_encode()
        found = self.known.values(coded.dictionary.to_pylist(), self.learn)
        place = coded.indices.to_numpy()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        values = np.frombuffer(b"".join(found), "<u4")
        starts = np.cumsum(sizes) - sizes
        out, offsets = [], words.offsets.to_numpy()
        for a, b in zip(offsets[:-1], offsets[1:]):
            of = place[a:b]
            n = sizes[of]
            ends = np.cumsum(n)
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[of] - ends + n, n)
            out.append(values[at].tobytes())
        return out


class Packer:
    """Packs the documents of one task; memory is a few pools of rests."""

    def __init__(self, tiers: tuple[int, ...], base: int, pool: int = POOL):
        self.tiers, self.base, self.pool = sorted(tiers), base, pool
        self.rests: dict[int, list] = {t: [] for t in self.tiers}  # (length, order, doc, start, ids)
        self.sequences, self.order = 0, 0
        self.of_tier: dict[int, int] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        n, top = len(ids) // 4, self.tiers[-1]
        doc, start = (doc_id, n), 0
        while n - start >= top:
            self.close(top, [(top, doc, start, ids[4 * start : 4 * (start + top)])])
            start += top
        if start < n:
            self.push(doc, start, ids[4 * start :])
        while full := next((t for t in reversed(self.tiers) if len(self.rests[t]) >= self.pool), None):
            self.pack(full)

    def push(self, doc, start: int, ids: bytes) -> None:
        n = len(ids) // 4
        tier = self.tiers[bisect.bisect_left(self.tiers, n)]
        self.order += 1
        bisect.insort(self.rests[tier], (n, self.order, doc, start, ids))

    def close(self, tier: int, pieces: list[tuple]) -> None:
        """One finished sequence; its place is that among the task's sequences of this size."""
        place = self.of_tier.get(tier, 0)
        self.of_tier[tier] = place + 1
        at = 0
        for n, doc, start, ids in pieces:
            self.rows.append((doc[0], start, n, zlib.crc32(ids), doc[1], self.base + self.sequences, at, tier, place))
            at += n
        self.sequences += 1

    def largest(self, room: int, below: int):
        """Take the longest rest of at most ``room`` tokens from tiers up to ``below``."""
        for tier in reversed([t for t in self.tiers if t <= below]):
            rests = self.rests[tier]
            i = bisect.bisect_right(rests, room, key=lambda r: r[0])
            if i:
                return rests.pop(i - 1)
        return None

    def window(self, tier: int) -> None:
        """Fill one window of ``tier`` as far as there are rests; the last one is cut to fit."""
        pieces, room = [], tier
        while room:
            rest = self.largest(room, tier)
            if rest is None:
                shortest = next((t for t in self.tiers if self.rests[t]), None)
                if shortest is None:
                    break
                n, _, doc, start, ids = self.rests[shortest].pop(0)
                pieces.append((room, doc, start, ids[: 4 * room]))
                self.push(doc, start + room, ids[4 * room :])
                room = 0
            else:
                n, _, doc, start, ids = rest
                pieces.append((n, doc, start, ids))
                room -= n
        self.close(tier, pieces)

    def pack(self, tier: int) -> None:
        while len(self.rests[tier]) > self.pool // 2:
            self.window(tier)

    def finish(self) -> None:
        """Pack what is left; the last tokens go to windows of falling powers of two."""
        left = sum(r[0] for rests in self.rests.values() for r in rests)
        while left >= self.tiers[-1]:
            self.window(self.tiers[-1])
            left -= self.tiers[-1]
        pieces = [r for t in self.tiers for r in self.rests[t]]
        self.rests = {t: [] for t in self.tiers}
        size = 1 << max(0, left.bit_length() - 1)
        while left:
            room, taken = size, []
            while room:
                n, order, doc, start, ids = pieces.pop()
                if n > room:
                    pieces.append((n - room, order, doc, start + room, ids[4 * room :]))
                    n, ids = room, ids[: 4 * room]
                taken.append((n, doc, start, ids))
                room -= n
            self.close(size, taken)
            left -= size
            size = 1 << max(0, left.bit_length() - 1)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) if self.rows else [[] for _ in PIECES]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, text: str = "text",
    end: int = END, step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group.

    A null or empty text is the end id alone. Repeated rows are packed each on their own;
    a null doc_id stays null. ``tiers`` are powers of two. Sequences have no padding: windows
    are filled to the last token, and a task's last tokens go to sequences of smaller powers of
    two. Tasks share nothing while they pack, no text is shuffled, and an empty table gives no rows.
    Ids of sequences hold the task's number, so they follow the input's splits. A step group is
    ``step_tokens`` of sequences of one size, over all tasks; only a size's last group may hold fewer.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        content = file.read()
    last = end.to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(content)
        packer = Packer(tiers, TaskContext.get().partitionId() << TASK_BITS)
        for batch in slices(batches, "_data", BATCH_BYTES):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.ids(batch.column("_data").to_pylist())):
                packer.add(doc_id, ids + last)
            yield packer.batch()
        packer.finish()
        yield packer.batch()

    pieces = common.staged(common.in_bytes(docs, text, "doc_id").mapInArrow(packed, PIECES_SQL), "pieces")
    return grouped(pieces, step_tokens)


def grouped(pieces: DataFrame, step_tokens: int) -> DataFrame:
    """Pieces with ``step_group`` in place of ``place``: sequences are numbered by counts of each task and size."""
    task = F.shiftright("sequence_id", TASK_BITS).alias("_task")
    counts = pieces.filter("offset = 0").groupBy(task, "tier").agg(F.count("*").alias("_n"))
    # A row for each task and size.
    earlier = Window.partitionBy("tier").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_task", "tier", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    rows = pieces.withColumn("_task", task).join(before, ["_task", "tier"])
    number = F.floor((F.col("_before") + F.col("place")) / F.greatest(F.lit(1), F.floor(F.lit(step_tokens) / F.col("tier"))))
    # Groups of one size follow each other; the size is in the number's high part.
    size = F.floor(F.log2("tier") + 0.5).cast("long")
    group = (F.shiftleft(size, TASK_BITS) + number).alias("step_group")
    return rows.select(*(f.name for f in PIECES if f.name != "place"), group)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
