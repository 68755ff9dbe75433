"""Quality classifier by compression.

Two zstandard dictionaries are built, one from texts labelled good and one from texts labelled bad. A text
is cut into blocks, and each block is compressed with either dictionary; blocks keep the dictionary's share
alike in short and long texts. The difference of the two sizes over the block's length, as the mean of the
text and as its worst block, is turned into a probability by a logistic curve that is fitted on labelled
texts outside the dictionaries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fit_logistic, fold, labelled_sample, settle, sigmoid

BLOCK = 256
DICT_BYTES = 64 * 1024
LEVEL = 3
SHORT = 32  # characters at which a text counts half


@dataclass(frozen=True)
class CompressionModel:
    """Plain bytes and numbers, so that it travels to the executors inside the UDF."""

    good: bytes
    bad: bytes
    slope: tuple[float, float]
    shift: float
    prior: float
    level: int = LEVEL
    block: int = BLOCK


def build_dictionary(texts: list[bytes], size: int = DICT_BYTES, block: int = BLOCK) -> bytes:
    """A trained dictionary, or the texts themselves as content where there are too few to train on."""
    blocks = [t[i : i + block] for t in texts for i in range(0, len(t), block)]
    if len(blocks) >= 64:
        try:
            return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(blocks)[-size:]


def _compressor(content: bytes, level: int):
    if len(content) < 8:
        return zstandard.ZstdCompressor(level=level, write_content_size=False)
    d = zstandard.ZstdCompressionDict(content)
    d.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_dict_id=False)


class Scorer:
    def __init__(self, model: CompressionModel):
        self.model = model
        self.good, self.bad = _compressor(model.good, model.level), _compressor(model.bad, model.level)

    def differences(self, text: str | None) -> tuple[float, float]:
        """(bad size - good size) / bytes over the text, and the least over its blocks; zeros for an empty text.

        A last block of under 0.6 of the first one's length counts for the mean alone.
        """
        data = (text or "").encode("utf-8", "replace")
        total, worst = 0, 1e9
        least = 0.6 * min(len(data), self.model.block)
        for i in range(0, len(data), self.model.block):
            part = data[i : i + self.model.block]
            d = len(self.bad.compress(part)) - len(self.good.compress(part))
            total += d
            if len(part) >= least:
                worst = min(worst, d / len(part))
        return (total / len(data), worst) if data else (0.0, 0.0)

    def score(self, text: str | None) -> float:
        if not text:
            return self.model.prior
        a, b = self.differences(text)
        # a few bytes say little: their score stays near the share of label 1
        told = len(text) / (len(text) + SHORT)
        known = self.model.slope[0] * a + self.model.slope[1] * b + self.model.shift
        share = min(max(self.model.prior, 1e-6), 1 - 1e-6)
        return float(sigmoid(told * known + (1 - told) * np.log(share / (1 - share))))


def train(sample: list[tuple[str, int]], prior: float) -> CompressionModel:
    """Three quarters of the sample make the dictionaries, the rest fits the curve.

    With no text of one of the labels every score is the share of label 1.
    """
    sets = {y: [t.encode("utf-8", "replace") for t, v in sample if v == y] for y in (0, 1)}
    if not sets[0] or not sets[1]:
        return CompressionModel(b"", b"", (0.0, 0.0), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))), prior)
    held = {y: max(1, len(v) // 4) if len(v) > 1 else 1 for y, v in sets.items()}
    parts = {y: v[held[y] :] or v for y, v in sets.items()}
    good, bad = build_dictionary(parts[1]), build_dictionary(parts[0])
    probe = Scorer(CompressionModel(good, bad, (0.0, 0.0), 0.0, prior))
    x, y, w = [], [], []
    for label, texts in sets.items():
        for t in texts[: held[label]]:
            x.append(probe.differences(t.decode("utf-8", "replace")))
            y.append(label)
            w.append((prior if label else 1 - prior) / held[label])
    scale = np.maximum(np.std(x, axis=0), 1e-9)
    beta = fit_logistic(np.array(x) / scale, np.array(y, float), np.array(w) * len(x), l2=0.05)
    return CompressionModel(good, bad, (float(beta[0] / scale[0]), float(beta[1] / scale[1])), float(beta[2]), prior)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1000, max_chars: int = 40_000, keep: Column | None = None) -> CompressionModel:
    """Fit on a bounded sample of labelled rows: per_class texts of either label, each of at most max_chars."""
    return train(*labelled_sample(docs, labels, label, per_class, max_chars, keep))


def score_column(model: CompressionModel, text: str | Column = "text") -> Column:
    """The score of a text column: 0 to 1, higher where label 1 is likelier. Null and empty texts get the prior."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        settle()
        scorer = Scorer(model)
        for s in batches:
            yield pd.Series([scorer.score(t) for t in s], dtype="float64")

    return score(F.col(text) if isinstance(text, str) else text)


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of docs; labels are learnt outside the held-out fold.

    A map over documents: no shuffle besides the labelled sample. Repeated rows are scored each for itself,
    other columns are not read, and an empty table gives an empty result.
    """
    model = fit(docs, labels, keep=fold("doc_id", folds) != 0)
    out = docs.select("doc_id", (fold("doc_id", folds) == 0).alias("held_out"), score_column(model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
