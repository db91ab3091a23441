"""Token counts: pieces counted once per distinct pre-token, joined to each text's frequencies.

A pre-token here is a word with the blank before it, or a run of white space: the
library's own pre-tokens never reach over such a border, so the pieces of a text are the
sum over its pre-tokens. Ids of a text are never built.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from . import common
from .common import Remembered, slices

# Unicode White_Space, as the tokenizer's own pattern has it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
KNOWN_MAX = 48_000_000  # bytes of words a task remembers, in each of two generations
KNOWN_CHARS = 48  # longer pre-tokens are rare and are counted each time
BATCH_BYTES = 12_000_000


class PieceCounter:
    """Pieces of pre-tokens, each counted once while the task remembers it.

    Words with a blank before them are joined, some hundred to a string, and counted in one
    call: none reaches over a blank. The lengths of the pieces in bytes tell which word each
    is of. Words without a blank are joined by line feeds, of which each is one piece.
    """

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = special_strings(content)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # In a byte-level vocabulary each character of a piece stands for one byte.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for piece, i in vocabulary.items():
            self.bytes_of[i] = len(piece)
        self.plain = re.compile(f"[^{WHITE}]+")
        self.known = Remembered(KNOWN_MAX)
        self.special_bytes = [s.encode() for s in self.special]
        self.find = re.compile(PRE_TOKEN).findall
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else (lambda t: [t])

    def encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)

    def joined(self, words: list[str], sizes: list[int], before: str) -> list[int] | None:
        """Pieces of each word; None if a border between words lies inside a piece."""
        ends = np.cumsum(self.bytes_of[self.encoded(before.join(["", *words]) if before else "".join(words))])
        borders = np.cumsum(np.array(sizes) + len(before))
        at = np.searchsorted(ends, borders)
        if len(ends) == 0 or ends[-1] != borders[-1] or (ends[at] != borders).any():
            return None
        return (np.diff(np.concatenate([[-1], at])) - len(before)).tolist()

    def learn(self, new: list[str | bytes]) -> list[int]:
        """Pieces of each of some different pre-tokens (bytes stand for a word after a blank)."""
        out = [0] * len(new)
        blank, bare, other = [], [], []
        for i, w in enumerate(new):
            string = " " + w.decode("utf-8", "replace") if isinstance(w, bytes) else w
            if len(string) > KNOWN_CHARS or any(s in string for s in self.special):
                other.append((i, string))
            elif string[0] == " " and self.plain.fullmatch(string, 1):
                blank.append((i, string))
            elif self.plain.fullmatch(string):
                bare.append((i, string))
            else:
                other.append((i, string))
        for words, before in ((blank, ""), (bare, "\n")):
            for at in range(0, len(words), 500):
                some = words[at : at + 500]
                counts = self.joined([w for _, w in some], [len(w.encode("utf-8")) for _, w in some], before)
                for k, (i, w) in enumerate(some):
                    if counts is None:
                        other.append((i, w))
                    else:
                        out[i] = counts[k]
        for at in range(0, len(other), 2000):
            some = other[at : at + 2000]
            for (i, _), e in zip(some, self.tokenizer.encode_batch_fast([w for _, w in some], add_special_tokens=False)):
                out[i] = len(e)
        return out

    def frequencies(self, data: bytes) -> Counter:
        """Pre-tokens of any text, around special strings, by the whole pattern."""
        found = Counter()
        for i, part in enumerate(self.parts(data.decode("utf-8", "replace"))):
            found.update([part] if i % 2 else self.find(part))
        return found

    def totals(self, texts: list[bytes]) -> list[int]:
        """Pieces of each text.

        Where a text has no two blanks in a row and no special string, each blank begins a
        pre-token (what follows it up to the next blank, other white space included), so a
        split at blanks gives them; other texts take the whole pattern.
        """
        out = [0] * len(texts)
        odd = [i for i, t in enumerate(texts) if b"  " in t or any(s in t for s in self.special_bytes)]
        if odd:
            per_text = [self.frequencies(texts[i]) for i in odd]
            names = list(set().union(*per_text))
            pieces = dict(zip(names, self.known.values(names, self.learn)))
            for i, frequency in zip(odd, per_text):
                out[i] = sum(n * pieces[token] for token, n in frequency.items())
        skip = set(odd)
        even = [i for i in range(len(texts)) if i not in skip]
        if even:
            first, rest = zip(*(texts[i].partition(b" ")[::2] for i in even))
            has_rest = [b" " in texts[i] for i in even]
            words = pc.split_pattern(pa.array([r if h else None for r, h in zip(rest, has_rest)], pa.binary()), b" ")
            coded = words.flatten().dictionary_encode()
            counts = np.array(self.known.values(coded.dictionary.to_pylist(), self.learn), np.int64)
            upto = np.concatenate([[0], np.cumsum(counts[coded.indices.to_numpy()])])
            offsets = words.offsets.to_numpy()
            sums = upto[offsets[1:]] - upto[offsets[:-1]]
            names = list({f.decode("utf-8", "replace") for f in first if f})
            bare = dict(zip(names, self.known.values(names, self.learn)))
            for i, f, s in zip(even, first, sums.tolist()):
                out[i] = s + (bare[f.decode("utf-8", "replace")] if f else 0)
        return out


def special_strings(tokenizer_json: str) -> list[str]:
    return [x["content"] for x in json.loads(tokenizer_json)["added_tokens"]]


def count_tokens(
    docs: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 512, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) per row.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows stay rows; other columns
    are not read. ``tokenizer_path`` is read on the driver, tasks get its content. Each task
    keeps a bounded table of pre-tokens, so memory does not grow with the corpus, and
    nothing is shuffled.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        content = file.read()
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(content)
        for batch in slices(batches, "_data", BATCH_BYTES):
            texts = batch.column("_data").to_pylist()
            totals = counter.totals(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(k) for k in keep),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([t > limit for t in totals], pa.bool_()),
                ],
                names=[*keep, "n_bytes", "n_tokens", "over_limit"],
            )

    source = common.in_bytes(docs, text, *keep)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)
    return source.mapInArrow(counted, f"{kept}, n_bytes long, n_tokens long, over_limit boolean")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
