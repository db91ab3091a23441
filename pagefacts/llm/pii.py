"""Personal data: base patterns, and a character BiLSTM with CRF transitions beside them.

The network is trained in numpy on labelled character spans. A text is cut into overlapping
windows; each is decoded (Viterbi over the CRF), and each character takes its tag from the
window in which it is most central, so that spans are those of the whole text. A personal
span holds a digit or an at sign: windows without one can only be empty and are not built.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import slices

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # O, then begin and inside of each kind
WINDOW, STRIDE, REACH = 96, 48, 40
HIDDEN, SEED, STEPS, BATCH = 16, 7, 350, 64
WINDOWS_MAX = 3000  # windows the network learns from
SURE = 0.9  # least mean probability of an added span
BATCH_BYTES = 4_000_000
TRIGGER = "[0-9@]"

AT = re.compile(r"@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(TRIGGER)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns by kind, then start; code points, end exclusive.

    Each pattern is leftmost and does not overlap itself; a match that fails its check is
    dropped. Mail names are taken leftwards from the at sign, so a text costs its length.
    """
    if not ANY.search(text):
        return []
    spans, free = [], 0
    for m in AT.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            spans.append(("email", start, m.end()))
            free = m.end()
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return spans


# --- characters ---------------------------------------------------------------------------

_SIGNS = "@.-+() _%\n\t:/=,;'\"#&|<>[]{}!?*$"
CLASSES = 3 + 26 + 10 + len(_SIGNS)  # padding, other letter, other sign, then each known one


def _class_table() -> np.ndarray:
    first = np.full(128, 2, np.int64)
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz"):
        first[ord(c)] = first[ord(c.upper())] = 3 + i
    for i in range(10):
        first[48 + i] = 29 + i
    for i, c in enumerate(_SIGNS):
        first[ord(c)] = 39 + i
    return first


def char_classes(text: str) -> np.ndarray:
    """Class of each code point: ASCII by itself, any other character as a letter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _class_table()[np.minimum(points, 127)], 1)


# --- network ------------------------------------------------------------------------------


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logsumexp(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def new_parameters(hidden: int = HIDDEN, seed: int = SEED) -> dict[str, np.ndarray]:
    """The input weights are looked up by character class: an embedding times a matrix."""
    rng = np.random.default_rng(seed)
    p = {}
    for way in "fb":
        p["x" + way] = rng.normal(0, 0.1, (CLASSES, 4 * hidden))
        p["h" + way] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
        p["b" + way] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
    p["out"] = rng.normal(0, 0.1, (2 * hidden, TAGS))
    p["out_b"] = np.zeros(TAGS)
    p["move"] = np.zeros((TAGS, TAGS))
    return p


def legal() -> np.ndarray:
    """0 where a tag may follow another, very low else: inside follows begin or inside of its kind."""
    out = np.zeros((TAGS, TAGS))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        out[:, inside] = -1e4
        out[inside - 1, inside] = out[inside, inside] = 0
    return out


def lstm(x, p, way):
    """Hidden states (time, batch, hidden) of one direction, and what its gradient needs."""
    steps, n = x.shape
    hidden = p["h" + way].shape[0]
    h, c = np.zeros((n, hidden)), np.zeros((n, hidden))
    states, saved = np.empty((steps, n, hidden)), []
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        z = p["x" + way][x[t]] + h @ p["h" + way] + p["b" + way]
        i, f, o = (sigmoid(z[:, k * hidden : (k + 1) * hidden]) for k in range(3))
        g = np.tanh(z[:, 3 * hidden :])
        before_h, before_c = h, c
        c = f * c + i * g
        s = np.tanh(c)
        h = o * s
        states[t] = h
        saved.append((t, i, f, o, g, s, before_h, before_c))
    return states, saved


def lstm_gradient(x, p, way, saved, d_states, grads):
    hidden = p["h" + way].shape[0]
    n = x.shape[1]
    d_h, d_c = np.zeros((n, hidden)), np.zeros((n, hidden))
    for t, i, f, o, g, s, before_h, before_c in reversed(saved):
        d_h = d_h + d_states[t]
        d_c = d_c + d_h * o * (1 - s * s)
        z = np.concatenate([d_c * g * i * (1 - i), d_c * before_c * f * (1 - f), d_h * s * o * (1 - o), d_c * i * (1 - g * g)], 1)
        np.add.at(grads["x" + way], x[t], z)
        grads["h" + way] += before_h.T @ z
        grads["b" + way] += z.sum(0)
        d_h, d_c = z @ p["h" + way].T, d_c * f


def scores(x, p):
    forward, keep_f = lstm(x, p, "f")
    backward, keep_b = lstm(x, p, "b")
    both = np.concatenate([forward, backward], 2)
    return both @ p["out"] + p["out_b"], both, keep_f, keep_b


def marginals(emit, move):
    """Tag probabilities per time and batch row, pair sums over time, and log of the total."""
    steps, n, _ = emit.shape
    alpha, beta = np.empty_like(emit), np.zeros_like(emit)
    alpha[0] = emit[0]
    for t in range(1, steps):
        alpha[t] = emit[t] + logsumexp(alpha[t - 1][:, :, None] + move[None], 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = logsumexp(move[None] + (emit[t + 1] + beta[t + 1])[:, None, :], 2)
    total = logsumexp(alpha[-1], 1)
    single = np.exp(alpha + beta - total[None, :, None])
    pairs = np.zeros_like(move)
    for t in range(1, steps):
        pairs += np.exp(alpha[t - 1][:, :, None] + move[None] + (emit[t] + beta[t])[:, None, :] - total[:, None, None]).sum(0)
    return single, pairs, total


def viterbi(emit, move):
    steps, n, _ = emit.shape
    best, back = emit[0], []
    for t in range(1, steps):
        options = best[:, :, None] + move[None]
        back.append(options.argmax(1))
        best = options.max(1) + emit[t]
    tags = np.empty((steps, n), np.int64)
    tags[-1] = best.argmax(1)
    for t in range(steps - 2, -1, -1):
        tags[t] = back[t][np.arange(n), tags[t + 1]]
    return tags


def train(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, steps: int = STEPS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Adam on the CRF's log loss; ``x`` classes and ``y`` tags of shape (windows, time)."""
    p = new_parameters(hidden, seed)
    fixed = legal()
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    rng, step = np.random.default_rng(seed), 0
    while step < steps:
        order = rng.permutation(len(x))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            xs, ys = x[some].T, y[some].T
            move = p["move"] + fixed
            emit, both, keep_f, keep_b = scores(xs, p)
            single, pairs, _ = marginals(emit, move)
            grads = {k: np.zeros_like(v) for k, v in p.items()}
            d_emit = single.copy()
            np.put_along_axis(d_emit, ys[:, :, None], np.take_along_axis(d_emit, ys[:, :, None], 2) - 1, 2)
            d_emit /= len(some)
            seen = np.zeros_like(pairs)
            np.add.at(seen, (ys[:-1].ravel(), ys[1:].ravel()), 1)
            grads["move"] = (pairs - seen) / len(some)
            flat = both.reshape(-1, both.shape[2])
            grads["out"] = flat.T @ d_emit.reshape(-1, TAGS)
            grads["out_b"] = d_emit.sum((0, 1))
            d_both = d_emit @ p["out"].T
            lstm_gradient(xs, p, "f", keep_f, d_both[:, :, :hidden], grads)
            lstm_gradient(xs, p, "b", keep_b, d_both[:, :, hidden:], grads)
            step += 1
            for k, g in grads.items():
                norm = np.sqrt((g * g).sum())
                g = g * min(1.0, 5.0 / (norm + 1e-12))
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                p[k] = p[k] - 0.02 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return p


# --- texts and windows --------------------------------------------------------------------


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches within REACH characters of a digit or an at sign."""
    out: list[list[int]] = []
    for m in ANY.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def window_starts(a: int, b: int) -> list[int]:
    return [a, *range(a + STRIDE, max(a + 1, b - WINDOW + STRIDE), STRIDE)] if b - a > WINDOW else [a]


def tags_of(spans: list[Span], start: int, size: int = WINDOW) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for kind, a, b in spans:
        a, b = a - start, b - start
        if a < size and b > 0:
            tag = 1 + 2 * KINDS.index(kind)
            out[max(a, 0) : min(b, size)] = tag + 1
            if a >= 0:
                out[a] = tag
            else:
                out[0] = tag
    return out


def window_rows(classes: np.ndarray, starts: list[int]) -> np.ndarray:
    rows = np.zeros((len(starts), WINDOW), np.int64)
    for row, s in zip(rows, starts):
        part = classes[s : s + WINDOW]
        row[: len(part)] = part
    return rows


def network_spans(texts: list[str], p: dict[str, np.ndarray], batch: int = 512) -> list[list[tuple[str, int, int, float]]]:
    """Spans the network finds in each text, with their mean tag probability."""
    plan, classes = [], {}
    for i, text in enumerate(texts):
        for a, b in regions(text):
            for s in window_starts(a, b):
                plan.append((i, a, b, s))
    move = p["move"] + legal()
    best: dict[tuple[int, int, int], list[np.ndarray]] = {}
    for at in range(0, len(plan), batch):
        some = plan[at : at + batch]
        for i in {w[0] for w in some}:
            if i not in classes:
                classes = {k: v for k, v in classes.items() if k >= some[0][0]}
                classes[i] = char_classes(texts[i])
        x = np.concatenate([window_rows(classes[i], [s]) for i, _, _, s in some]).T
        emit = scores(x, p)[0]
        tags = viterbi(emit, move)
        sure = np.take_along_axis(marginals(emit, move)[0], tags[:, :, None], 2)[:, :, 0]
        for n, (i, a, b, s) in enumerate(some):
            size = min(WINDOW, b - s)
            central, tag, prob = best.setdefault((i, a, b), [np.full(b - a, -1), np.zeros(b - a, np.int64), np.zeros(b - a)])
            depth = np.minimum(np.arange(size), np.arange(size)[::-1])
            to = slice(s - a, s - a + size)
            better = depth > central[to]
            central[to] = np.where(better, depth, central[to])
            tag[to] = np.where(better, tags[:size, n], tag[to])
            prob[to] = np.where(better, sure[:size, n], prob[to])
    out: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    for (i, a, b), (_, tag, prob) in sorted(best.items()):
        at = 0
        while at < b - a:
            if tag[at] == 0:
                at += 1
                continue
            kind, end = (tag[at] - 1) // 2, at + 1
            while end < b - a and tag[end] == 2 + 2 * kind:
                end += 1
            out[i].append((KINDS[kind], a + at, a + end, float(prob[at:end].mean())))
            at = end
    return out


def all_spans(text: str, base: list[Span], found: list[tuple[str, int, int, float]]) -> list[Span]:
    """Base spans, and the network's sure ones that touch none and hold a digit or an at sign."""
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for kind, a, b, sure in found:
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if sure >= SURE and b - a >= 6 and ANY.search(text, a, b) and not any(x < b and a < y for x, y in taken):
            added.append((kind, a, b))
    return sorted([*base, *added], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def fit(docs: DataFrame, text: str = "text", max_windows: int = WINDOWS_MAX) -> dict[str, np.ndarray]:
    """Train on windows of texts labelled by the base spans; at most ``max_windows``, by id hash.

    Without any window the network is left untrained and finds nothing (see ``empty``).
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_data", BATCH_BYTES):
            rows = []
            for data in batch.column("_data").to_pylist():
                string = data.decode("utf-8", "replace")
                spans = base_spans(string)
                for a, b in regions(string):
                    for s in window_starts(a, b):
                        key = hashlib.blake2b(string[s : s + WINDOW].encode("utf-8", "replace"), digest_size=8).digest()
                        near = [x for x in spans if x[1] < s + WINDOW and x[2] > s]
                        part = np.zeros(WINDOW, np.uint8)
                        piece = char_classes(string[s : s + WINDOW])
                        part[: len(piece)] = piece
                        rows.append((int.from_bytes(key, "big") >> 1, bool(near), part.tobytes(), tags_of(near, s).astype(np.uint8).tobytes()))
            # Of these rows no more than the bound can be among the smallest of all.
            rows.sort()
            kept = [r for r in rows if r[1]][:max_windows] + [r for r in rows if not r[1]][: max_windows // 2]
            columns = list(zip(*kept)) if kept else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())],
                names=["k", "near", "x", "y"],
            )

    marked = common.in_bytes(docs.filter(F.col(text).rlike(TRIGGER)), text)
    rows = common.staged(marked.mapInArrow(windows, "k long, near boolean, x binary, y binary").distinct(), "pii-windows")
    some = [
        *rows.filter("near").orderBy("k", "x").limit(max_windows).collect(),
        *rows.filter("not near").orderBy("k", "x").limit(max_windows // 2).collect(),
    ]
    if not some:
        return empty()
    x = np.stack([np.frombuffer(r.x, np.uint8) for r in some]).astype(np.int64)
    y = np.stack([np.frombuffer(r.y, np.uint8) for r in some]).astype(np.int64)
    return train(x, y)


def empty() -> dict[str, np.ndarray]:
    p = new_parameters()
    p["out"][:] = 0
    p["out_b"] = np.concatenate([[50.0], np.zeros(TAGS - 1)])
    return p


def find_pii(docs: DataFrame, p: dict[str, np.ndarray], text: str = "text", keep: tuple[str, ...] = ("doc_id",), redact: bool = False) -> DataFrame:
    """``keep``, n_email, n_ip, n_card, n_phone and base_sha256 of base spans, and ``spans`` (all).

    Null and empty texts have no spans. ``redact`` adds ``redacted``, the text with each span
    replaced by its kind in brackets (null for a text without spans). Rows stay as they are;
    texts without a digit or an at sign are not sent to Python; nothing is shuffled.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_data", BATCH_BYTES):
            texts = [d.decode("utf-8", "replace") for d in batch.column("_data").to_pylist()]
            bases = [base_spans(t) for t in texts]
            spans = [all_spans(t, b, f) for t, b, f in zip(texts, bases, network_spans(texts, p))]
            columns = [pa.array([sum(s[0] == k for s in b) for b in bases], pa.int64()) for k in KINDS]
            columns.append(pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in bases], pa.string()))
            columns.append(pa.array([joined(s) for s in spans], pa.string()))
            if redact:
                columns.append(pa.array([redacted(t, s) if s else None for t, s in zip(texts, spans)], pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), *columns], names=[*keep, *names])

    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", *(["redacted"] if redact else [])]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    types = ", ".join(f"{n} {'long' if n.startswith('n_') else 'string'}" for n in names)
    marked = docs.withColumn("_text", F.when(F.col(text).rlike(TRIGGER), F.col(text)))
    return common.in_bytes(marked, "_text", *keep).mapInArrow(found, f"{kept}, {types}")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with spans replaced by ``[KIND]``; of overlapping spans the first in the text counts."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    return find_pii(docs, fit(docs))
