"""Toxicity by noisy-channel deobfuscation: restore words first, score the restored text.

Channel: a hidden letter shows as itself, as a look-alike digit or sign, repeated, or with
separators between letters. Each written word, and each run of single letters with blanks
between, is a lattice of letters in which a separator is nothing or a word border; Viterbi
decoding finds the most likely hidden words under a character trigram model times the
channel. Letters joined across single blanks are then parted into the likeliest words by
the counts of words. A word whose lattice has one path is its own restoration and needs no search.

The scorer knows words and word beginnings that are significantly more frequent in texts
labelled toxic (likelihood-ratio test), and a logistic curve on their evidence in a text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import slices

# Signs that stand for letters.
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = "*._-~'’^=,:;#/\\"
SAME, SWAPPED, EXTRA, LITERAL = (math.log(p) for p in (0.9, 0.05, 0.2, 0.05))
# Separators as nothing and as a word border: one blank, more or other blanks, other signs.
BLANK, GAP, SIGN = ((math.log(a), math.log(b)) for a, b in ((0.97, 0.03), (0.2, 0.8), (0.1, 0.05)))
MAX_WORD = 40  # restorations of longer runs without blanks are not remembered
SPACED = re.compile(r"(?<![\w@$!|+.\-*'’])(?:[^\W_]|[@$!|+(])(?:[\s._\-*]{1,3}(?:[^\W_]|[@$!|+(])){2,}(?![\w@$|+(])")
GAPS = re.compile(r"[\s._\-*]+")
HARD = re.compile(r"[0-9@$!|+(€£*._\-~'’^=,:;#/\\]|(.)\1\1")
EDGES = re.compile(r"^[^\w@$!|+(€£]+|[^\w@$|+]+$")
KNOWN_MAX = 400_000
BATCH_BYTES = 8_000_000
WORD_SHARE = 2e-7  # least share of all words of one that parts spaced-out ones: five million at most, some 100,000 in prose
UNKNOWN = math.log(1e-3)  # of a word that is not among them, besides its letters
TRIGRAM_SHARE = 1e-7  # least share of all trigrams of one that the character model knows; rarer ones share its floor
SHORT = 24  # letters of words looked up at every border; of longer ones only the lengths that occur are
LABELLED_MAX = 10_000  # rows of each label learnt from, chosen by a hash of the id
WHOLE, BEGINNING = math.log(6), math.log(20)  # least odds of a word, of a beginning
MIN_TOXIC = 4  # texts labelled toxic that hold a key, at least
PREFIXES = (4, 5, 6)


class CharModel:
    """Interpolated character trigrams; contexts and letters never seen share a floor. Counts of words."""

    def __init__(self, counts: dict[str, int], words: dict[str, int] | None = None):
        self.words = words or {}
        self.all_words = sum(self.words.values())
        self.long = sorted({len(w) for w in self.words if len(w) > SHORT})
        tri, bi, uni = Counter(), Counter(), Counter()
        context2, context1 = Counter(), Counter()
        for gram, n in counts.items():
            tri[gram] += n
            bi[gram[1:]] += n
            uni[gram[2]] += n
            context2[gram[:2]] += n
            context1[gram[1]] += n
        self.tri, self.bi, self.uni, self.c2, self.c1 = map(dict, (tri, bi, uni, context2, context1))
        self.total, self.memo = sum(uni.values()), {}

    def log(self, gram: str) -> float:
        """log P(third character | two before it)."""
        found = self.memo.get(gram)
        if found is None:
            p = 1e-4 / 100 + 0.05 * self.uni.get(gram[2], 0) / max(1, self.total)
            p += 0.25 * self.bi.get(gram[1:], 0) / max(1, self.c1.get(gram[1], 0))
            p += 0.7 * self.tri.get(gram, 0) / max(1, self.c2.get(gram[:2], 0))
            found = self.memo[gram] = math.log(p)
        return found


def trigrams(word: str) -> Iterator[str]:
    padded = "^^" + word + "$"
    return (padded[i : i + 3] for i in range(len(padded) - 2))


def lattice(written: str) -> list[list[tuple[str, float]]]:
    """Per run of one sign its hidden strings with log channel probability; a separator is '' or ' ', a word border."""
    steps = []
    for sign, run in groupby(written):
        n = len(list(run))
        if sign.isalpha():
            ways = [(sign, SAME + EXTRA * (1 if n > 1 else 0) * 0.5)]
            if n > 1:
                ways.append((sign * 2, SAME * 2))
        elif sign.isspace():
            join, border = BLANK if sign == " " and n == 1 else GAP
            ways = [("", join), (" ", border)]
        else:
            ways = [(letter * k, (SWAPPED + SAME * (n > 1)) * k) for letter in LOOK_ALIKES.get(sign, "") for k in (1, 2)[: n]]
            if sign in SEPARATORS:
                ways += [("", SIGN[0]), (" ", SIGN[1])]
            ways.append((sign * min(n, 3), LITERAL * min(n, 3)))
        steps.append(ways)
    return steps


def decode(written: str, model: CharModel) -> str:
    """The most likely hidden words, joined by blanks (Viterbi; states are the last two characters)."""
    best: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    log = model.log
    for ways in lattice(written):
        following: dict[str, tuple[float, tuple | None]] = {}
        for state, (score, path) in best.items():
            for hidden, cost in ways:
                total, last = score + cost, state
                if hidden == " ":
                    if last != "^^":
                        total += log(last + "$")
                        last = "^^"
                else:
                    for c in hidden:
                        total += log(last + c)
                        last = last[1] + c
                if last not in following or total > following[last][0]:
                    following[last] = (total, (path, hidden) if hidden else path)
        best = following
    ends = ((score + (log(state + "$") if state != "^^" else 0.0), state) for state, (score, _) in best.items())
    path, parts = best[max(ends)[1]][1], []
    while path:
        path, hidden = path
        parts.append(hidden)
    return " ".join("".join(reversed(parts)).split())


def parted(word: str, model: CharModel) -> list[str]:
    """The likeliest words whose letters follow each other in ``word``.

    A known word costs its share of all words, another one its letters' probability.
    """
    best: list[tuple[float, int]] = [(0.0, 0)]
    known = model.words.get
    other = [0.0]  # of letters since the last border, were all in one unknown word
    starts = [0]
    for end in range(1, len(word) + 1):
        # An unknown word may begin anywhere; of those the best so far is carried on.
        begun = end - 1
        fresh = best[begun][0] + UNKNOWN + model.log("^^" + word[begun])
        more = -math.inf
        if end > 1:
            before = ("^" + word[end - 2]) if starts[begun] == begun - 1 else word[end - 3 : end - 1]
            more = other[begun] + model.log(before + word[begun])
        other.append(max(fresh, more))
        starts.append(begun if fresh >= more else starts[begun])
        tail = ("^" + word[begun]) if starts[end] == begun else word[end - 2 : end]
        found = (other[end] + model.log(tail + "$"), starts[end])
        for start in range(max(0, end - SHORT), end):
            n = known(word[start:end])
            if n:
                found = max(found, (best[start][0] + math.log(n / model.all_words), start))
        for size in model.long:
            if size > end:
                break
            n = known(word[end - size : end])
            if n:
                found = max(found, (best[end - size][0] + math.log(n / model.all_words), end - size))
        best.append(found)
    out, end = [], len(word)
    while end:
        out.append(word[best[end][1] : end])
        end = best[end][1]
    return out[::-1]


def spaced_words(run: str, model: CharModel) -> str:
    """The words of a run of single letters with separators; all of them wide count as narrow."""
    least = min(map(len, GAPS.findall(run)))
    hidden = decode(GAPS.sub(lambda m: m.group()[least - 1 :], run), model)
    return " ".join(part for word in hidden.split() for part in parted(word, model)) if model.words else hidden


def restored_word(written: str, model: CharModel) -> str:
    """Restoration of one lower-case word, several where it hides borders; punctuation around it is dropped."""
    if not HARD.search(written):
        return written
    inner = EDGES.sub("", written)
    return decode(inner, model) if HARD.search(inner) else inner


def key_of(word: str) -> str:
    """A word with runs of one letter as one letter: doubled letters do not matter."""
    return "".join(c for c, _ in groupby(word))


class Words:
    """Restored words of texts, remembering the written ones it has met."""

    def __init__(self, model: CharModel, of_word):
        self.model, self.of_word, self.known = model, of_word, {}

    def values(self, text: str) -> set:
        """``of_word`` of each different restored word of a text, spaced-out words included."""
        text = text.lower()
        written = set(text.split())
        if len(self.known) > KNOWN_MAX:
            self.known = {}
        known, out = self.known, set()
        for word in written:
            try:
                out.update(known[word])
            except KeyError:
                values = self.of_words(restored_word(word, self.model))
                if len(word) <= MAX_WORD:
                    known[word] = values
                out.update(values)
        for match in SPACED.finditer(text):
            out.update(self.of_words(spaced_words(match.group(), self.model)))
        return out

    def of_words(self, restored: str) -> tuple:
        return tuple(v for v in map(self.of_word, restored.split()) if v is not None)


def restore_text(text: str | None, model: CharModel) -> str:
    """The whole restored text in lower case, words joined by blanks; null gives ''."""
    text = (text or "").lower()
    spaced = SPACED.sub(lambda m: spaced_words(m.group(), model), text)
    return " ".join(restored_word(w, model) for w in spaced.split())


class Lexicon:
    """Evidence of keys: log odds of a significantly toxic word or word beginning."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def of_word(self, word: str):
        """(evidence key, weight) of a restored word, or None."""
        key = key_of(word.strip(SEPARATORS + "!?()\"«»"))
        best = None
        for k in (key, *(key[:n] + "*" for n in PREFIXES if len(key) > n)):
            w = self.weights.get(k)
            if w is not None and (best is None or w > best[1]):
                best = (k, w)
        return best


def keys_of_word(word: str) -> tuple[str, ...]:
    key = key_of(word.strip(SEPARATORS + "!?()\"«»"))
    return (key, *(key[:n] + "*" for n in PREFIXES if len(key) > n)) if len(key) > 1 else ()


def evidence(hits: set) -> tuple[float, float]:
    """Features of a text: the strongest evidence, and the whole (saturating)."""
    if not hits:
        return 0.0, 0.0
    return max(w for _, w in hits), math.log1p(sum(w for _, w in hits))


def _lines(frame: DataFrame, model: CharModel, lexicon: Lexicon, keep: tuple[str, ...], curve) -> DataFrame:
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model, lexicon.of_word)
        for batch in slices(batches, "_data", BATCH_BYTES):
            rows = [evidence(words.values(d.decode("utf-8", "replace"))) for d in batch.column("_data").to_pylist()]
            if curve is not None:
                a, b, c = curve
                rows = [(m, t, 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * m + c * t))))) for m, t in rows]
            else:
                rows = [(m, t, 0.0) for m, t in rows]
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), *(pa.array(c, pa.float64()) for c in columns)],
                names=[*keep, "strongest", "evidence", "score"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.select(*keep).schema)
    return frame.mapInArrow(scored, f"{kept}, strongest double, evidence double, score double")


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge; y may hold one class only."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(3)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) + 0.05 * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(3)
        w = w - np.linalg.solve(hessian, gradient)
    return tuple(float(v) for v in w)


class Model:
    """A fitted character model, lexicon and curve; a few MB at most."""

    def __init__(self, chars: CharModel, lexicon: Lexicon, curve: tuple[float, float, float]):
        self.chars, self.lexicon, self.curve = chars, lexicon, curve


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", max_rows: int = LABELLED_MAX) -> Model:
    """Learn characters from all documents and the rest from labelled rows: of each label at most ``max_rows``, those of smallest id hash.

    Rows without a label or an id, and labels without a document, are not used. An id with
    several labels counts with the largest. Documents without a label count for the characters. Without any usable row the score is a constant.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max((F.col(label) > 0).cast("int")).alias("_y"))
    order = F.xxhash64("doc_id")
    chosen = None
    for y in (0, 1):
        some = known.filter(F.col("_y") == y).orderBy(order, "doc_id").limit(max_rows)
        chosen = some if chosen is None else chosen.unionByName(some)
    # Bounded: 2 * max_rows pairs of numbers.
    rows = common.in_bytes(docs, text, "doc_id").join(F.broadcast(chosen), "doc_id")
    sample = common.staged(rows.select("_y", "_data").repartition(common.task_partitions(spark)), "toxic-sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Counter()

        def flushed() -> pa.RecordBatch:
            total = Counter()
            for word, n in words.items():
                inner = EDGES.sub("", word)
                if inner and not HARD.search(inner):
                    total["w" + inner] += n
                    for gram in trigrams(inner):
                        total["g" + gram] += n
            words.clear()
            return pa.RecordBatch.from_pydict({"item": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})

        for batch in slices(batches, "_data", BATCH_BYTES):
            for data in batch.column("_data").to_pylist():
                words.update(data.decode("utf-8", "replace").lower().split())
            if len(words) > KNOWN_MAX:
                yield flushed()
        yield flushed()

    items = common.in_bytes(docs, text).mapInArrow(counted, "item string, n long").groupBy("item").agg(F.sum("n").alias("n"))
    items = common.staged(items, "toxic-characters")

    def frequent(kind: str, share: float) -> dict[str, int]:
        some = items.filter(F.col("item").startswith(kind))
        total = some.agg(F.sum("n")).first()[0] or 0
        return {r.item[1:]: r.n for r in some.filter(F.col("n") >= share * total).collect()}

    # Bounded: at most 1 / share short texts with a number, whatever the corpus.
    chars = CharModel({g: n for g, n in frequent("g", TRIGRAM_SHARE).items() if len(g) == 3}, frequent("w", WORD_SHARE))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(chars, keys_of_word)
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for y, data in zip(batch.column("_y").to_pylist(), batch.column("_data").to_pylist()):
                found = words.values(data.decode("utf-8", "replace"))
                counts[y].update({k for keys in found for k in keys})
            if sum(map(len, counts)) > 1_000_000:
                yield from _pairs(counts)
                counts = (Counter(), Counter())
        yield from _pairs(counts)

    totals = {r._y: r["count"] for r in sample.groupBy("_y").count().collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    weights: dict[str, float] = {}
    if clean and toxic:
        keys = sample.mapInArrow(keyed, "key string, t long, c long").groupBy("key").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
        share = toxic / (toxic + clean)
        t, c = F.col("t").cast("double"), F.col("c").cast("double")
        n = t + c
        zero_log = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
        g2 = 2 * (zero_log(t, n * share) + zero_log(c, n * (1 - share)))
        odds = F.log(((t + 0.5) / (toxic + 1)) / ((c + 0.5) / (clean + 1)))
        tested = common.staged(keys.filter(t >= MIN_TOXIC), "toxic-keys")
        least = 2 * math.log(2 * tested.count() + 1)  # less than one chance hit among all keys tested
        strong = tested.withColumn("g2", g2).withColumn("w", odds).filter((F.col("g2") >= least) & (F.col("w") >= F.when(F.col("key").endswith("*"), BEGINNING).otherwise(WHOLE)))
        # Bounded by the labelled rows: each key is in MIN_TOXIC of them at least.
        weights = {r.key: float(r.w) for r in strong.collect()}
    lexicon = Lexicon(weights)
    # Bounded: two numbers for each sampled row.
    seen = _lines(sample, chars, lexicon, ("_y",), None).select("_y", "strongest", "evidence").toPandas()
    if len(seen):
        curve = fit_curve(seen[["strongest", "evidence"]].to_numpy(), seen["_y"].to_numpy(float))
    else:
        curve = (-2.0, 0.0, 0.0)
    return Model(chars, lexicon, curve)


def _pairs(counts: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
    names = list(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_pydict(
        {
            "key": pa.array(names, pa.string()),
            "t": pa.array([counts[1][k] for k in names], pa.int64()),
            "c": pa.array([counts[0][k] for k in names], pa.int64()),
        }
    )


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, strongest, evidence and score (0 to 1, higher is likelier toxic) per row.

    Whole texts are read; null and empty ones get the curve's score without evidence. Rows
    stay as they are, repeated ones too; nothing is shuffled.
    """
    return _lines(common.in_bytes(docs, text, *keep), model.chars, model.lexicon, keep, model.curve)


def trained(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """Model from the rows with crc32 of the id not 2 modulo 4."""
    labels = common.read(spark, sf_dir, "labels").select("doc_id", "toxic")
    return fit(docs, labels.filter(common.crc_mod(F.col("doc_id"), 4) != 2))


THRESHOLD = 0.3


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    rows = score_toxicity(docs, trained(spark, docs, sf_dir))
    return rows.select(
        "doc_id",
        (common.crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "strongest",
        "evidence",
    )
