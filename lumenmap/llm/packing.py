"""Packing along a space-filling curve.

A document's token ids are hashed to signed buckets, the bucket vector is projected to four dimensions by a
fixed random matrix and scaled to unit length, and the place of that point on a Hilbert curve is the
document's key. The documents are sorted by ranges of keys; laid end to end in that order they make one line
of tokens, which is cut every 4,096. Neighbours on the curve so share a sequence, no place is padded, and a
document is cut only where a sequence ends. What is left at the line's end becomes sequences whose lengths are
powers of two.

Only (key, id, number of tokens) is sorted. The places on the line come from the sums of the ranges: one number
for each range goes to the driver. Then the ids are joined to their places, and each is cut by itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, settle, texts_of
from .tokens import encoder

LENGTH = 4096
DIMENSIONS, BITS = 4, 10
BUCKETS, SEED = 256, 20240717

ENCODED = "uid long, doc_id long, key long, n long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def projection(size: int) -> np.ndarray:
    """For each token id, the share it adds to the four projected values: its bucket's sign times the bucket's random row."""
    rows = np.random.Generator(np.random.PCG64(SEED)).standard_normal((BUCKETS, DIMENSIONS))
    h = (np.arange(size, dtype=np.uint64) + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    sign = np.where(h >> np.uint64(63), 1.0, -1.0)
    return (rows[(h >> np.uint64(40)).astype(np.int64) % BUCKETS] * sign[:, None]).astype(np.float32)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of each row of integers below 2 ** bits; Skilling's transform, for all rows at once."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, t)
            x[i] ^= t if i else 0
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def document_keys(ids: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """The Hilbert key of each document; one without ids lies at the middle of the cube."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    sums = np.zeros((len(ids), DIMENSIONS))
    some = np.flatnonzero(sizes)
    if len(some):
        sums[some] = np.add.reduceat(table[np.concatenate([ids[i] for i in some.tolist()])], (np.cumsum(sizes) - sizes)[some], axis=0, dtype=np.float64)
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = sums / np.where(norm > 0, norm, 1)
    return hilbert_key(np.clip(((unit + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1))


def tail_bounds(total: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, sequence id) of the sequences after the last full one: lengths are falling powers of two."""
    full = total // length
    at, rest, out = full * length, total - full * length, []
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, full + len(out)))
        at += size
        rest -= size
    return out


def cut_document(at: int, n: int, tail: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence id, offset) of the pieces of a document of n ids that begins at a place on the line."""
    out, start, end = [], 0, at + n
    first_tail = tail[0][0] if tail else end
    while at < end:
        if at < first_tail:
            seq, offset = divmod(at, length)
            stop = min(end, (seq + 1) * length)
        else:
            k = max(i for i, (s, _) in enumerate(tail) if s <= at)
            seq, offset = tail[k][1], at - tail[k][0]
            stop = min(end, tail[k + 1][0] if k + 1 < len(tail) else end)
        out.append((start, stop - at, seq, offset))
        start += stop - at
        at = stop
    return out


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """uid (unique for the row), doc_id, Hilbert key, number of ids and ids of each row; a null text is empty."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle(encoders=True)
        enc = encoder(tokenizer)
        end, width = np.array([end_id], dtype=enc.dtype).tobytes(), enc.dtype.itemsize
        table = projection(max(enc.size, end_id + 1))
        uid = TaskContext.get().partitionId() << 33
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                rows = [ids + end for ids in enc.encode_all(texts_of(b.column(1)))]
                keys = document_keys([np.frombuffer(r, enc.dtype)[:-1] for r in rows], table)
                n = pa.array([len(r) // width for r in rows], pa.int64())
                yield pa.record_batch([pa.array(range(uid, uid + len(rows)), pa.int64()), b.column(0), pa.array(keys), n, pa.array(rows, pa.binary())], names=["uid", "doc_id", "key", "n", "ids"])
                uid += len(rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, ENCODED)


def places(encoded: DataFrame) -> tuple[DataFrame, int]:
    """uid and the place on the line of each row in the order of (key, doc_id, uid), and the line's length."""
    spark = encoded.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        part, before = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.column(1).to_numpy()
            starts = before + np.cumsum(n) - n
            before += int(n.sum())
            yield pa.record_batch([b.column(0), pa.array(np.full(len(n), part), pa.int64()), pa.array(starts), b.column(1)], names=["uid", "part", "local", "n"])

    ranged = encoded.select("key", "doc_id", "uid", "n").repartitionByRange(parts, "key", "doc_id", "uid").sortWithinPartitions("key", "doc_id", "uid")
    ordered = cut(ranged.select("uid", "n").mapInArrow(number, "uid long, part long, local long, n long"), "packing-order")
    sums = {r["part"]: r["n"] for r in ordered.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # one row for each range
    bases, total = [], 0
    for part in sorted(sums):
        bases.append((part, total))
        total += sums[part]
    base = spark.createDataFrame(bases, "part long, base long")
    # as many rows as there are ranges
    return ordered.join(F.broadcast(base), "part").select("uid", (F.col("base") + F.col("local")).alias("at")), total


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """The pieces of all rows of docs (doc_id, text) along the curve.

    Each id lies in exactly one piece, offsets run from 0 without a gap, and only the line's end is shorter than
    length, in powers of two. Repeated rows are packed each for itself; rows of the same key are in the order of
    doc_id. keep_ids adds the ids of each piece as a binary column. An empty table gives an empty result; other columns are not read.
    """
    enc = encoder(tokenizer)
    dtype = enc.dtype
    encoded = cut(encode_documents(docs, tokenizer, end_id), "packing-ids")
    at, total = places(encoded)
    tail = tail_bounds(total, length)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 7 + [pa.binary()] * keep_ids
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][: len(kinds)]
        settle()
        for b in batches:
            rows = []
            for doc_id, n, place, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                values = np.frombuffer(ids.as_buffer(), dtype)
                for start, size, seq, offset in cut_document(place, n, tail, length):
                    part = values[start : start + size]
                    rows.append((doc_id, start, size, zlib.crc32(part.astype("<u4").tobytes()), n, seq, offset, part.tobytes())[: len(kinds)])
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    joined = encoded.select("uid", "doc_id", "n", "ids").join(at, "uid").select("doc_id", "n", "at", "ids")
    return joined.mapInArrow(pieces, PIECES + ", ids binary" * keep_ids)
