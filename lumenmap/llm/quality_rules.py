"""Quality rules: countable limits and a hashed n-gram classifier.

The countable part takes words, lines and 3-word windows of the whole text. The classifier is a logistic
regression over hashed words, word pairs and 4-byte windows, each kind as shares of its own total, so that
the score of a text is a mean of weights and long texts are scored in one pass without a feature vector.
Both are computed over the bytes of a batch with array operations. Windows that may be equal are found by hashes
of their words and then compared by their bytes, so the counts are exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, fit_logistic, in_chunks, labelled_sample, settle, sigmoid

BITS = 16
SIZE = 1 << BITS
CHUNK = 1 << 19
MIN_WORDS = 50
MAX_REPEAT_SHARE = 50  # per cent of the words
THRESHOLD = 0.5
KINDS = 3  # words, word pairs, windows of 4 bytes

_rng = np.random.Generator(np.random.PCG64(20240611))
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MIX = np.uint64(0xFF51AFD7ED558CCD)
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
CONTINUES = np.zeros(256, dtype=bool)
CONTINUES[0x80:0xC0] = True

_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse for i below n, modulo 2 ** 64."""
    if len(_powers.get("up", ())) < n:
        m = max(n, CHUNK + (1 << 16))
        for k, b in (("up", BASE), ("down", BASE_INVERSE)):
            v = np.full(m, b, dtype=np.uint64)
            v[0] = 1
            _powers[k] = np.multiply.accumulate(v)
    return _powers["up"][:n], _powers["down"][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * MIX
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """The words of some texts that stand one after the other in buf, a space after each."""

    buf: np.ndarray
    starts: np.ndarray  # of the texts
    at: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    code: np.ndarray


def words_of(texts: list[bytes]) -> Words:
    buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    space = IS_SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
    at, end = edge[0::2], edge[1::2]
    up, down = _power(len(buf) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_CODE[buf] * up[: len(buf)], dtype=np.uint64)))
    code = _mix((sums[end] - sums[at]) * down[at])
    return Words(buf, starts, at, end, np.searchsorted(starts, at, side="right") - 1, code)


def _per_doc(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values.astype(np.int64), starts)


def base_counts(texts: list[bytes], w: Words | None = None) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    w = w or words_of(texts)
    n = len(texts)
    space = IS_SPACE[w.buf]
    repeat = np.zeros(len(w.at), dtype=bool)
    if len(w.at) > 2:
        c = w.code
        window = _mix(_mix(c[:-2] + c[1:-1] * np.uint64(3) + c[2:] * np.uint64(0x9E3779B1)) ^ (w.doc[:-2].astype(np.uint64) * BASE))
        whole = w.doc[:-2] == w.doc[2:]
        where = np.flatnonzero(whole)
        order = where[np.argsort(window[where])]
        key = window[order]
        same = key[1:] == key[:-1]
        again = np.zeros(len(order), dtype=bool)
        again[1:] |= same
        again[:-1] |= same
        hit = _equal_windows(w, order[again])
        for k in range(3):
            repeat[hit + k] = True
    lines = np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        if b"\n" in t:
            seen: set[bytes] = set()
            for line in t.split(b"\n"):
                if line in seen:
                    lines[i] += 1
                elif line and not line.isspace():
                    seen.add(line)
    return {
        "n_words": np.bincount(w.doc, minlength=n),
        "word_chars": _per_doc(~space & ~CONTINUES[w.buf], w.starts),
        "n_symbols": _per_doc(SYMBOL[w.buf], w.starts),
        "n_dup_lines": lines,
        "n_repeat_words": np.bincount(w.doc[repeat], minlength=n),
    }


def _equal_windows(w: Words, at: np.ndarray) -> np.ndarray:
    """Of 3-word windows whose hashes agree, those that have an equal one in their text."""
    data, begin, end, doc = w.buf.tobytes(), w.at, w.end, w.doc
    keys = [(d, *(data[x:y] for x, y in zip(begin[i : i + 3].tolist(), end[i : i + 3].tolist()))) for i, d in zip(at.tolist(), doc[at].tolist())]
    count = Counter(keys)
    return at[np.fromiter((count[k] > 1 for k in keys), bool, len(keys))]


def _slots(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words, word pairs and 4-byte windows: the slot and the text of each occurrence. Each kind has its own SIZE slots."""
    shift = np.uint64(64 - BITS)
    one = ((w.code * BASE) >> shift).astype(np.int64)
    pair = (_mix(w.code[:-1] * np.uint64(31) + w.code[1:]) >> shift).astype(np.int64) + SIZE
    near = w.doc[:-1] == w.doc[1:]
    b = w.buf.astype(np.uint32)
    four = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)
    grams = ((four * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64) + 2 * SIZE
    ends = np.append(w.starts[1:], len(w.buf)) - w.starts
    doc = np.repeat(np.arange(len(w.starts)), ends)
    inside = doc[:-3] == doc[3:]
    return [(one, w.doc), (pair[near], w.doc[:-1][near]), (grams[inside], doc[:-3][inside])]


@dataclass(frozen=True)
class NgramModel:
    weights: bytes  # float32, KINDS * SIZE
    intercept: float
    slope: float
    shift: float


def mean_weights(texts: list[bytes], weights: np.ndarray, intercept: float, w: Words | None = None) -> np.ndarray:
    w = w or words_of(texts)
    total = np.full(len(texts), intercept, dtype=np.float64)
    for slot, doc in _slots(w):
        n = np.bincount(doc, minlength=len(texts))
        total += np.bincount(doc, weights=weights[slot], minlength=len(texts)) / np.maximum(n, 1)
    return total


def train(sample: list[tuple[str, int]], prior: float, steps: int = 60, rate: float = 2.0) -> NgramModel:
    """Adaptive gradient steps on four fifths of the sample, then a logistic curve on the rest.

    With no text of one of the labels every score is the share of label 1.
    """
    sample = [(t.encode("utf-8", "replace"), y) for t, y in sample]
    labels = {y for _, y in sample}
    if labels != {0, 1}:
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return NgramModel(np.zeros(KINDS * SIZE, np.float32).tobytes(), 0.0, 0.0, float(np.log(p / (1 - p))))
    held = [x for i, x in enumerate(sample) if i % 5 == 4] if len(sample) >= 10 else sample
    used = [x for i, x in enumerate(sample) if i % 5 != 4] if len(sample) >= 10 else sample
    if {y for _, y in held} != {0, 1}:
        held = sample
    rows, cols, vals, first = [], [], [], 0
    for chunk in in_chunks((t for t, _ in used), CHUNK):
        for slot, doc in _slots(words_of(chunk)):
            n = np.bincount(doc, minlength=len(chunk))
            key, count = np.unique(doc * (KINDS * SIZE) + slot, return_counts=True)
            d = key // (KINDS * SIZE)
            rows.append(d + first)
            cols.append(key % (KINDS * SIZE))
            vals.append((count / np.maximum(n[d], 1)).astype(np.float32))
        first += len(chunk)
    row, col, val = np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)
    y = np.array([v for _, v in used], float)
    share = {v: max(1, int((y == v).sum())) for v in (0, 1)}
    weight = np.where(y == 1, 0.5 / share[1], 0.5 / share[0])
    w, b, square, square_b = np.zeros(KINDS * SIZE), 0.0, np.full(KINDS * SIZE, 1e-8), 1e-8
    for _ in range(steps):
        z = np.bincount(row, weights=w[col] * val, minlength=len(y)) + b
        e = (sigmoid(z) - y) * weight
        g = np.bincount(col, weights=e[row] * val, minlength=KINDS * SIZE) + 1e-6 * w
        square += g * g
        w -= rate * g / np.sqrt(square)
        square_b += e.sum() ** 2
        b -= 0.2 * e.sum() / np.sqrt(square_b)
    w32 = w.astype(np.float32)
    z = np.concatenate([mean_weights(c, w32, b) for c in in_chunks((t for t, _ in held), CHUNK)])
    v = np.array([v for _, v in held], float)
    counts = {k: max(1, int((v == k).sum())) for k in (0, 1)}
    importance = np.where(v == 1, prior / counts[1], (1 - prior) / counts[0]) * len(v)
    scale = float(np.std(z)) or 1.0
    beta = fit_logistic((z / scale)[:, None], v, importance, l2=0.05)
    return NgramModel(w32.tobytes(), float(b), float(beta[0]) / scale, float(beta[1]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 800, max_chars: int = 20_000, keep: Column | None = None) -> NgramModel:
    """Fit on a bounded sample of labelled rows: per_class texts of either label, each of at most max_chars."""
    return train(*labelled_sample(docs, labels, label, per_class, max_chars, keep))


VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"


def judge(texts: list[str | None], model: NgramModel, threshold: float = THRESHOLD) -> pd.DataFrame:
    """The counts and verdict of each text; a null text has no words and so fails."""
    weights = np.frombuffer(model.weights, np.float32)
    frames = []
    for chunk in in_chunks(((t or "").encode("utf-8", "replace") for t in texts), CHUNK):
        w = words_of(chunk)
        got = base_counts(chunk, w)
        n, repeated = got["n_words"], got["n_repeat_words"]
        failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_SHARE * n)
        p = sigmoid(model.slope * mean_weights(chunk, weights, model.intercept, w) + model.shift)
        frames.append(pd.DataFrame(got | {"base_failed": failed, "kept": ~failed & (p >= threshold), "probability": p}))
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(columns=[c.split()[0] for c in VERDICT.split(", ")])


def verdict_column(model: NgramModel, text: str | Column = "text", threshold: float = THRESHOLD) -> Column:
    @F.pandas_udf(VERDICT)
    def verdict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        settle()
        for s in batches:
            yield judge(s.tolist(), model, threshold)

    return verdict(F.col(text) if isinstance(text, str) else text)


def check_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id with the counts, base_failed, kept and the calibrated probability, for each row of docs.

    A map over documents; only the labelled sample is joined. Repeated rows are judged each for itself,
    other columns are not read, an empty table gives an empty result.
    """
    return docs.select("doc_id", verdict_column(fit(docs, labels, label), threshold=threshold).alias("_v")).select("doc_id", "_v.*")
