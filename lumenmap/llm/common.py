"""Helpers that the corpus operators share: shared storage, labelled samples, byte tables."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from ..storage import cut, fresh_dir, shared_dir  # noqa: F401

#: The bytes that part words: space and \x09-\x0D.
SPACE_BYTES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACE_BYTES)] = True
#: A-Z to a-z, other bytes as they are.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


#: Rows of an Arrow batch. Texts are large rows; Spark's default of 10,000 would hold tens of MB on either side.
BATCH_ROWS = 2000


def for_texts(spark: SparkSession) -> None:
    """Send the library to the executors and keep Arrow batches of texts small, unless the session says how small."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


#: Bytes of the Parquet row group that a task writes, rows that it reads at once, bytes that it sends to Python at once
#: (rows wait in memory for their results). By Spark's defaults 128 MB, 4,096 rows and BATCH_ROWS texts of any length.
SMALL_BUFFERS = {"parquet.block.size": 16 << 20, "spark.sql.parquet.columnarReaderBatchSize": 256, "spark.sql.execution.arrow.maxBytesPerBatch": 1 << 20}


#: Files that a task of a shuffle may keep open, each with buffers of its own. Up to spark.shuffle.sort.bypassMergeThreshold
#: partitions, which Spark's own number of them just meets, it opens one for each; above, it sorts rows in managed memory.
OPEN_FILES = 64


def small_buffers(spark: SparkSession) -> None:
    """Keep small what each of the tasks in one heap holds, unless the session says how much.

    A number of shuffle partitions that would open more than OPEN_FILES in each task is raised until Spark sorts.
    """
    for key, value in SMALL_BUFFERS.items():
        if spark.conf.get(key, None) is None and spark.conf.get("spark.hadoop." + key, None) is None:
            spark.conf.set(key, str(value))
    key, most = "spark.sql.shuffle.partitions", int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    if OPEN_FILES < int(spark.conf.get(key)) <= most:
        spark.conf.set(key, str(most + 1))


def settle(encoders: bool = False) -> None:
    """In a Python worker, at the start of a task: give back what earlier tasks left, the token encoders too unless they are kept.

    Workers are used again for other stages; the caches of the token encoders and freed memory that the
    allocators keep would else add up.
    """
    tokens = sys.modules.get("lumenmap.llm.tokens")
    if tokens is not None and not encoders:
        tokens.release()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def texts_of(column: pa.Array) -> list[str]:
    """The texts of an Arrow column, null as empty."""
    return [t or "" for t in column.to_pylist()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for_texts(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, n: int):
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int, keep=None) -> tuple[list[tuple[str, int]], float]:
    """At most per_class texts of either label, those with the smallest hash of their id, and the share of label 1.

    docs has doc_id and text. keep: a condition on doc_id. Rows with a null text, label or id, and texts
    of more than max_chars characters, are not taken; so the sample is bounded by 2 * per_class * max_chars.
    An id with both labels has none; an id whose label is given more than once counts once.
    """
    rows = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    rows = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    if keep is not None:
        rows = rows.where(keep)
    share = rows.agg(F.avg("label").alias("p"), F.count("*").alias("n")).first()
    if not share["n"]:
        return [], 0.5
    # twice as many ids as texts are wanted: some may have no text or too long a one
    picked = [rows.where(F.col("label") == y).withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(2 * per_class) for y in (0, 1)]
    sample = picked[0].unionByName(picked[1])
    got = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= max_chars)).join(F.broadcast(sample), "doc_id")
    kept = [got.where(F.col("label") == y).orderBy("h", "doc_id", "text").limit(per_class) for y in (0, 1)]
    out = [(r["text"], r["label"]) for r in kept[0].unionByName(kept[1]).select("text", "label").collect()]
    return out, float(share["p"])


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Newton's method for a small dense logistic regression; the last coefficient is the intercept."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.ones(len(x)) if weight is None else weight
    beta = np.zeros(a.shape[1])
    ridge = l2 * np.eye(a.shape[1])
    ridge[-1, -1] = 1e-9
    for _ in range(steps):
        p = sigmoid(a @ beta)
        grad = a.T @ (w * (p - y)) + ridge @ beta
        hess = (a * (w * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a + ridge
        step = np.linalg.solve(hess, grad)
        scale = min(1.0, 4.0 / max(1e-12, float(np.abs(step).max())))
        beta -= scale * step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def in_chunks(values: Iterable[bytes], limit: int) -> Iterable[list[bytes]]:
    """Runs of values of at most limit bytes together; a longer value is a run of its own."""
    run, size = [], 0
    for v in values:
        if run and size + len(v) > limit:
            yield run
            run, size = [], 0
        run.append(v)
        size += len(v)
    if run:
        yield run
