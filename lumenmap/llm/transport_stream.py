"""Media columns as MPEG transport streams.

A payload is cut into access units of 576 bytes. Up to 16 units make one elementary packet with a time
stamp; its first transport packet has the random-access mark and a clock reference. Tables that name the
program and its stream come first and again every 16 elementary packets. Reading parses the tables and their
checksums, checks sync bytes and continuity counters, reassembles the elementary packets and stores time
stamps and the places of the random-access points.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the format.
PACKET, SYNC, BODY = 188, 0x47, 184
PAT_PID, PMT_PID, STREAM_PID, NULL_PID = 0x0000, 0x1000, 0x0100, 0x1FFF
PRIVATE_STREAM, PRIVATE_DATA_TYPE = 0xBD, 0x06
CLOCK, SAMPLE_RATE = 90_000, 48_000

UNIT = 576
UNITS_PER_PES = 16
TABLES_EVERY = 16
TICKS = UNIT * CLOCK // SAMPLE_RATE


class StreamError(ValueError):
    """The bytes are no transport stream that can be read without loss."""


@lru_cache(maxsize=1024)
def section_crc(data: bytes) -> int:
    """The CRC of table sections: polynomial 0x04C11DB7, most significant bit first, all ones at the start."""
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def _section(table_id: int, table_key: int, body: bytes) -> bytes:
    length = 5 + len(body) + 4
    head = bytes([table_id, 0xB0 | length >> 8, length & 0xFF, table_key >> 8, table_key & 0xFF, 0xC1, 0, 0]) + body
    return head + section_crc(head).to_bytes(4, "big")


def _table_body(section: bytes) -> bytes:
    return (b"\0" + section).ljust(BODY, b"\xff")


PAT_BODY = _table_body(_section(0x00, 1, bytes([0, 1, 0xE0 | PMT_PID >> 8, PMT_PID & 0xFF])))
PMT_BODY = _table_body(_section(0x02, 1, bytes([0xE0 | STREAM_PID >> 8, STREAM_PID & 0xFF, 0xF0, 0, PRIVATE_DATA_TYPE, 0xE0 | STREAM_PID >> 8, STREAM_PID & 0xFF, 0xF0, 0])))


def _header(pid: int, start: bool, adaptation: bool, counter: int) -> bytes:
    return bytes([SYNC, (0x40 if start else 0) | pid >> 8, pid & 0xFF, (0x30 if adaptation else 0x10) | counter & 15])


HEADS = {(pid, start, adaptation): [_header(pid, start, adaptation, c) for c in range(16)] for pid in (PAT_PID, PMT_PID, STREAM_PID) for start in (False, True) for adaptation in (False, True)}


def _stamp(prefix: int, pts: int) -> bytes:
    pts &= (1 << 33) - 1
    return bytes([prefix << 4 | (pts >> 30) << 1 | 1, pts >> 22 & 0xFF, (pts >> 14 & 0xFE) | 1, pts >> 7 & 0xFF, (pts << 1 & 0xFE) | 1])


def _read_stamp(b: bytes) -> int:
    return (b[0] >> 1 & 7) << 30 | b[1] << 22 | b[2] >> 1 << 15 | b[3] << 7 | b[4] >> 1


def pad_payload(data: bytes, unit: int = UNIT) -> bytes:
    """Bytes 255 up to a positive multiple of unit."""
    return data + b"\xff" * (max(unit, -(-len(data) // unit) * unit) - len(data))


def mux(payload: bytes) -> bytes:
    """A transport stream of the payload, whose length is a positive multiple of 576."""
    if not payload or len(payload) % UNIT:
        raise StreamError("the payload is no positive multiple of the unit")
    out, counter, tables = [], 0, 0
    plain = HEADS[STREAM_PID, False, False]
    step = UNIT * UNITS_PER_PES
    for k, at in enumerate(range(0, len(payload), step)):
        if k % TABLES_EVERY == 0:
            out += (HEADS[PAT_PID, True, False][tables & 15], PAT_BODY, HEADS[PMT_PID, True, False][tables & 15], PMT_BODY)
            tables += 1
        units = payload[at : at + step]
        pts = (at // UNIT) * TICKS
        pes = b"\0\0\1" + bytes([PRIVATE_STREAM]) + (8 + len(units)).to_bytes(2, "big") + b"\x84\x80\x05" + _stamp(2, pts) + units
        clock = (pts << 15 | 0x3F << 9).to_bytes(6, "big")
        out += (HEADS[STREAM_PID, True, True][counter & 15], b"\x07\x50", clock, pes[:176])
        counter += 1
        full = 176 + (len(pes) - 176) // BODY * BODY
        for i in range(176, full, BODY):
            out += (plain[counter & 15], pes[i : i + BODY])
            counter += 1
        if rest := pes[full:]:
            stuffing = BODY - len(rest) - 1  # after the byte of the field's length
            out += (HEADS[STREAM_PID, False, True][counter & 15], bytes([stuffing]), (b"\0" + b"\xff" * (stuffing - 1)) if stuffing else b"", rest)
            counter += 1
    return b"".join(out)


@dataclass
class Stream:
    payload: bytes = b""
    packets: int = 0
    tables: int = 0
    pts: list[int] = field(default_factory=list)
    random_access: list[tuple[int, int]] = field(default_factory=list)  # packet number, time stamp
    counter_errors: int = 0

    def feature(self) -> str:
        last = self.pts[-1] if self.pts else 0
        return f"pid={STREAM_PID};packets={self.packets};tables={self.tables};pes={len(self.pts)};rap={len(self.random_access)};first_pts={self.pts[0] if self.pts else 0};last_pts={last};counter_errors={self.counter_errors}"


def _section_of(body: bytes) -> bytes:
    at = 1 + body[0]
    length = 3 + ((body[at + 1] & 0x0F) << 8 | body[at + 2])
    section = body[at : at + length]
    if len(section) != length or section_crc(section):
        raise StreamError("a table's checksum is wrong")
    return section


@lru_cache(maxsize=64)
def _pmt_pids(body: bytes) -> frozenset[int]:
    s = _section_of(body)
    return frozenset((s[i + 2] & 0x1F) << 8 | s[i + 3] for i in range(8, len(s) - 4, 4) if s[i] << 8 | s[i + 1])


@lru_cache(maxsize=64)
def _stream_pids(body: bytes) -> frozenset[int]:
    s, out = _section_of(body), set()
    i = 12 + ((s[10] & 0x0F) << 8 | s[11])
    while i < len(s) - 4:
        out.add((s[i + 1] & 0x1F) << 8 | s[i + 2])
        i += 5 + ((s[i + 3] & 0x0F) << 8 | s[i + 4])
    return frozenset(out)


def demux(data: bytes, strict: bool = True) -> Stream:
    """Read a stream of one program and one elementary stream.

    A duplicate packet (same counter and body as the one before it on its stream) is skipped, as the format
    allows. Another break in the counters is an error if strict, else it is counted and the packet is read on.
    """
    if len(data) % PACKET:
        raise StreamError("the length is no multiple of 188")
    out = Stream(packets=len(data) // PACKET)
    pmts: frozenset[int] = frozenset()
    streams: frozenset[int] = frozenset()
    last: dict[int, tuple[int, bytes]] = {}
    parts: list[list[bytes]] = []
    rap_packet: list[int] = []
    for n in range(out.packets):
        at = n * PACKET
        if data[at] != SYNC:
            raise StreamError(f"no sync byte at packet {n}")
        b1, b3 = data[at + 1], data[at + 3]
        if b1 & 0x80:
            raise StreamError(f"packet {n} is marked as broken")
        pid, start, counter, start_of_body = (b1 & 0x1F) << 8 | data[at + 2], b1 & 0x40, b3 & 15, at + 4
        if pid == NULL_PID:
            continue
        random_access = False
        if b3 & 0x20:
            size = data[at + 4]
            random_access = bool(size and data[at + 5] & 0x40)
            start_of_body += 1 + size
        if not b3 & 0x10:
            continue
        body = data[start_of_body : at + PACKET]
        if pid in last and counter != (last[pid][0] + 1) & 15:
            if (counter, body) == last[pid]:
                continue
            if strict:
                raise StreamError(f"continuity is broken at packet {n}")
            out.counter_errors += 1
        last[pid] = (counter, body)
        if pid in streams:
            if start:
                parts.append([])
                if random_access:
                    rap_packet.append(n)
                    out.random_access.append((n, -1))
            if not parts:
                raise StreamError("an elementary packet has no start")
            parts[-1].append(body)
            if start and random_access:
                head = body
                if head[:3] == b"\0\0\1" and head[7] & 0x80:
                    out.random_access[-1] = (n, _read_stamp(head[9:14]))
        elif pid == PAT_PID:
            pmts = _pmt_pids(body)
            out.tables += 1
        elif pid in pmts:
            streams = _stream_pids(body)
            out.tables += 1
    pieces = []
    for group in parts:
        pes = b"".join(group)
        if pes[:3] != b"\0\0\1":
            raise StreamError("an elementary packet's start code is missing")
        length = pes[4] << 8 | pes[5]
        if strict and length and length + 6 != len(pes):
            raise StreamError("an elementary packet's length is wrong")
        if pes[7] & 0x80:
            out.pts.append(_read_stamp(pes[9:14]))
        pieces.append(pes[9 + pes[8] :])
    out.payload = b"".join(pieces)
    return out


STORED = "n_bytes long, payload_bytes long, media binary"


def media_column(text: str | Column = "text") -> Column:
    """A struct of the unpadded and the padded length, and the transport stream, of a text as UTF-8 (null: empty)."""

    @F.pandas_udf(STORED)
    def store(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = []
            for t in s:
                data = (t or "").encode("utf-8", "replace")
                padded = pad_payload(data)
                rows.append((len(data), len(padded), mux(padded)))
            yield pd.DataFrame(rows, columns=["n_bytes", "payload_bytes", "media"])

    return store(F.col(text) if isinstance(text, str) else text)


READ = "payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, time_stamps array<long>, random_access array<struct<packet: long, time_stamp: long>>"


def read_column(media: str | Column) -> Column:
    """What reading a stored stream gives: checksums of the payload and of the stream, and its features.

    time_stamps has one for each elementary packet, random_access the numbers of the transport packets at which
    reading may begin, with their time stamps.
    """

    @F.pandas_udf(READ)
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = []
            for m in s:
                got = demux(bytes(m))
                rows.append((hashlib.sha256(got.payload).hexdigest(), zlib.crc32(got.payload[-32:]), len(m), hashlib.sha256(m).hexdigest(), got.feature(), got.pts, [{"packet": n, "time_stamp": t} for n, t in got.random_access]))
            yield pd.DataFrame(rows, columns=["payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "time_stamps", "random_access"])

    return read(F.col(media) if isinstance(media, str) else media)


def with_media(docs: DataFrame, text: str = "text", to: str = "media") -> DataFrame:
    """docs with a column of transport streams, for writing as Parquet."""
    return docs.withColumn(to, media_column(text)["media"])


def digest(docs: DataFrame) -> DataFrame:
    """Store each text, read it back and return doc_id with lengths, checksums and features.

    A map over documents without a shuffle. Equal texts give equal values: nothing else goes into a stream.
    A null text counts as empty (one unit of 255s); repeated rows are stored each for itself; other columns are
    not read; an empty table gives an empty result.
    """
    stored = docs.select("doc_id", media_column().alias("_s"))
    got = stored.select("doc_id", "_s.n_bytes", "_s.payload_bytes", read_column(F.col("_s.media")).alias("_r"))
    return got.select("doc_id", "n_bytes", "payload_bytes", "_r.*")
