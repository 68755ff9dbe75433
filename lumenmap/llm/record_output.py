"""Token ids as length-delimited binary records.

A record is a length (8 bytes, little-endian), its masked checksum (4 bytes), the data and the data's masked
checksum (4 bytes). The checksum is CRC-32, masked by a rotation of 15 bits and a constant, so that a record
inside a record has no plain checksum over a checksum. The data is one flag byte (1: the id is null), the
document's id (8 bytes) and its token ids. Beside each file of records stands an index file with one entry of
33 bytes for each record (flag, id, offset of the record, number of tokens, tokens before it in the file), by
which single records can be read in any order.

Files are written in ascending order of ids, a range of (id, text's beginning and hash) to each task, so that
rows of one id are spread too; a new file is begun when one is full. Names come from the task's place in that order and
are moved into place when complete, so a task that runs again replaces what it wrote. The manifest, one row for
each file, stays a table; the driver gets one sum for each range.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh_dir, settle, texts_of
from .tokens import encoder

HEADER = struct.Struct("<QI")
FOOTER = struct.Struct("<I")
DATA = struct.Struct("<Bq")
ENTRY = struct.Struct("<BqQQQ")
MASK = 0xA282EAD8
FILE_BYTES = 16 << 20
HEAD = 64  # characters of a text that order the rows of one id

MANIFEST = "part int, file int, name string, docs long, tokens long, bytes long, before long"
ROWS = "name string, doc_id long, n_tokens long, local_start long, ids_crc32 long"


class RecordError(ValueError):
    """A record's checksum or length is wrong."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    length = len(data).to_bytes(8, "little")
    return b"".join((length, FOOTER.pack(masked(length)), data, FOOTER.pack(masked(data))))


def unframe(buf: bytes | memoryview, at: int = 0) -> tuple[memoryview, int]:
    """The data of the record at a place, and the place after it."""
    buf = memoryview(buf)
    if at + HEADER.size > len(buf):
        raise RecordError("a record's head is cut off")
    length, crc = HEADER.unpack_from(buf, at)
    if masked(bytes(buf[at : at + 8])) != crc:
        raise RecordError("a length's checksum is wrong")
    end = at + HEADER.size + length
    if end + FOOTER.size > len(buf):
        raise RecordError("a record is cut off")
    data = buf[at + HEADER.size : end]
    if masked(data) != FOOTER.unpack_from(buf, end)[0]:
        raise RecordError("a record's checksum is wrong")
    return data, end + FOOTER.size


class _Writer:
    """Files of one task; each is written under a name of this attempt and moved when it is whole."""

    def __init__(self, folder: str, part: int, attempt: int, limit: int):
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.part, self.attempt, self.limit, self.file, self.before = part, attempt, limit, 0, 0
        self.done: list[tuple] = []
        self._open()

    def _open(self) -> None:
        self.name = f"part-{self.part:06d}-{self.file:05d}"
        self.temp = f"{self.root}/_attempt-{self.attempt}-{self.name}"
        self.out = self.store.open_output_stream(self.temp)
        self.index: list[bytes] = []
        self.at = self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes, n: int) -> None:
        if self.at and self.at + len(ids) > self.limit:
            self.close()
            self.file += 1
            self._open()
        flag = doc_id is None
        record = frame(DATA.pack(flag, doc_id or 0) + ids)
        self.index.append(ENTRY.pack(flag, doc_id or 0, self.at, n, self.tokens))
        self.out.write(record)
        self.at += len(record)
        self.tokens += n

    def close(self) -> None:
        self.out.close()
        if not self.index:
            self.store.delete_file(self.temp)
            return
        with self.store.open_output_stream(self.temp + ".idx") as f:
            f.write(b"".join(self.index))
        for suffix, source in ((".rec", self.temp), (".idx", self.temp + ".idx")):
            self.store.move(source, f"{self.root}/{self.name}{suffix}")
        self.done.append((self.part, self.file, self.name, len(self.index), self.tokens, self.at, self.before))
        self.before += self.tokens


def write_records(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode docs (doc_id, text), append end_id to each and write records in ascending order of doc_id.

    Null texts are empty; null ids come first; rows with the same id are in the order of the first 64 characters
    of their texts (null first), then of a hash of the text. The texts are shuffled once, by ranges of all three,
    so only rows that agree in id and text must share a task. Returns the manifest, one row for each file: its part, place,
    name, documents, tokens, bytes, and the tokens of its part's files before it.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        settle(encoders=True)
        enc = encoder(tokenizer)
        end, width = np.array([end_id], dtype=enc.dtype).tobytes(), enc.dtype.itemsize
        writer = _Writer(folder, context.partitionId(), context.taskAttemptId(), file_bytes)
        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), enc.encode_all(texts_of(b.column(1)))):
                ids += end
                writer.add(doc_id, ids, len(ids) // width)
        writer.close()
        if writer.done:
            names = ["part", "file", "name", "docs", "tokens", "bytes", "before"]
            kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 4]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*writer.done), kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.substring("text", 1, HEAD).alias("head"), F.xxhash64("text").alias("h"))
    ranged = rows.repartitionByRange(parts, "doc_id", "head", "h").sortWithinPartitions("doc_id", "head", "h", "text").select("doc_id", "text")
    return cut(ranged.mapInArrow(write, MANIFEST), "records-manifest")


def records_of(name: str, data: memoryview, id_bytes: int) -> Iterator[tuple]:
    """(file, doc_id, n_tokens, tokens before it in the file, checksum of the ids) of each record of a file."""
    at = tokens = 0
    while at < len(data):
        record, at = unframe(data, at)
        flag, doc_id = DATA.unpack_from(record)
        ids = np.frombuffer(record, dtype=f"<u{id_bytes}", offset=DATA.size)
        yield name, None if flag else doc_id, len(ids), tokens, zlib.crc32(ids.astype("<u4").tobytes())
        tokens += len(ids)


def read_records(spark: SparkSession, folder: str, id_bytes: int) -> DataFrame:
    """Name of the file, doc_id, n_tokens, tokens before it in its file, and the ids' checksum, of each record, checked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), *[pa.int64()] * 4]
        settle()
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows = list(records_of(path.rsplit("/", 1)[-1].removesuffix(".rec"), memoryview(content.as_buffer()), id_bytes))
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["name", "doc_id", "n_tokens", "local_start", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.rec").load(folder)
    return files.select("path", "content").mapInArrow(read, ROWS)


def read_index(data: bytes) -> list[tuple[int | None, int, int, int]]:
    """Of an index file: doc_id, offset, n_tokens and tokens before, of each record."""
    return [(None if flag else doc_id, at, n, before) for flag, doc_id, at, n, before in ENTRY.iter_unpack(data)]


def record_at(data: bytes | memoryview, offset: int, id_bytes: int) -> tuple[int | None, np.ndarray]:
    """The document's id and its token ids, of the record at an offset that an index gives."""
    got, _ = unframe(data, offset)
    flag, doc_id = DATA.unpack_from(got)
    return (None if flag else doc_id), np.frombuffer(got, dtype=f"<u{id_bytes}", offset=DATA.size)


def output(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write records to the shared folder, read them back and return doc_id, start, n_tokens and ids_crc32.

    start counts the ids of all documents before this one. Repeated rows are records of their own. An empty table
    writes nothing and returns no rows; other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or fresh_dir(spark, "records")
    id_bytes = encoder(tokenizer).dtype.itemsize
    manifest = write_records(docs, tokenizer, folder, end_id)
    base = manifest.join(F.broadcast(part_bases(manifest)), "part").select("name", (F.col("base") + F.col("before")).alias("base"))
    rows = read_records(spark, folder, id_bytes).join(base, "name")
    return rows.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def part_bases(manifest: DataFrame) -> DataFrame:
    """part and the tokens of all parts before it: one row for each range of the shuffle, which goes through the driver."""
    before, bases = 0, []
    for r in manifest.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect():
        bases.append((r["part"], before))
        before += r["n"]
    return manifest.sparkSession.createDataFrame(bases, "part int, base long")


def shuffled_ids(spark: SparkSession, folder: str, id_bytes: int, seed: int) -> DataFrame:
    """doc_id and token ids (array) of all records, in an order drawn by the seed, read by the index files alone.

    The index entries are ordered by a hash keyed by the seed and the record's place; each task opens the files
    that its entries name and reads single records at their offsets. Equal seeds give equal orders.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1)):
                rows = [(path.removesuffix(".idx") + ".rec", at, n) for _, at, n, _ in read_index(content.as_py())]
                if rows:
                    kinds = [pa.string(), pa.int64(), pa.int64()]
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["path", "at", "n"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        for b in batches:
            ids, found = [], []
            for path, at, n in zip(*(c.to_pylist() for c in b.columns[:3])):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as f:
                    f.seek(at)
                    doc_id, got = record_at(f.read(overhead + n * id_bytes), 0, id_bytes)
                ids.append(doc_id)
                found.append(got.astype(np.int64))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    overhead = HEADER.size + DATA.size + FOOTER.size
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.idx").load(folder).select("path", "content")
    index = files.mapInArrow(entries, "path string, at long, n long").withColumn("h", F.xxhash64(F.lit(seed), F.element_at(F.split("path", "/"), -1), "at"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return index.repartitionByRange(parts, "h", "path", "at").sortWithinPartitions("h", "path", "at").select("path", "at", "n").mapInArrow(fetch, "doc_id long, ids array<long>")
