"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Encoding starts from single characters and merges neighbours that form a piece of the model, best score first
and leftmost of equals, as the model's own agenda does. With dropout a candidate merge is skipped where a hash
keyed by (seed, document, place of its left character, piece) falls below the rate. The hash depends on
nothing else, so a segmentation comes out the same on any partitioning, and another seed or document gives
another one. With rate 0 the ids are those of the library.

The words of a batch are merged in step: one array operation finds every word's best candidate, another
applies it. Words are grouped by length; very long ones take a heap. A candidate's skip is known when it
arises, so skipped ones never enter the agenda.

White space becomes U+2581, with one before the text; a U+2581 in the text itself and characters without a
piece become byte pieces, so that decoding gives back every text exactly.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE, SEED = 0.1, 1234
SPACE = 0x2581
LONG_WORD = 48
BATCH_CHARS = 400_000
NONE = np.iinfo(np.int32).max

_C1, _C2, _C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _C3
    h = (h ^ (h >> np.uint64(29))) * _C2
    return h ^ (h >> np.uint64(32))


class Pieces:
    """A BPE model's pieces as tables: of single characters, of merges, and of each piece's bytes."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.size, self.dtype = n, np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")
        names, plain = [sp.id_to_piece(i) for i in range(n)], {}
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_id = np.full(256, sp.unk_id(), dtype=np.int64)
        score = np.zeros(n)
        for i, name in enumerate(names):
            if sp.is_byte(i):
                self.byte_id[int(name[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(name[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain[name] = i
                score[i] = sp.get_score(i)
                self.bytes_of[i] = name.replace(chr(SPACE), " ").encode()
        if (self.byte_id == sp.unk_id()).any():
            raise ValueError("the model has no byte pieces")
        self.char = np.full(0x110000, -1, dtype=np.int32)
        pairs = {}
        self.joins_words = False
        for name, i in plain.items():
            if len(name) == 1:
                self.char[ord(name)] = i
            self.joins_words |= chr(SPACE) in name.lstrip(chr(SPACE)) or "\n" in name
            for k in range(1, len(name)):
                a, b = plain.get(name[:k]), plain.get(name[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        values, rank = np.unique(-score, return_inverse=True)
        self.rank = rank.astype(np.int32)
        self.piece_of = np.full(len(values), -1, dtype=np.int32)  # of a rank that one piece has
        alone = np.bincount(rank, minlength=len(values))[rank] == 1
        self.piece_of[rank[alone]] = np.flatnonzero(alone)
        self._table(pairs)

    def _table(self, pairs: dict[int, int]) -> None:
        bits = max(10, (len(pairs) * 8).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, -1, dtype=np.int64)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        for key, at in zip(keys.tolist(), self._slot(keys).tolist()):
            while self.keys[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.values[at] = key, pairs[key]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _C1) >> self.shift).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that two pieces form, -1 where they form none."""
        key = np.where((a >= 0) & (b >= 0), a.astype(np.int64) << 32 | b, np.int64(-2))
        at = self._slot(key)
        there = self.keys[at]
        out = np.where(there == key, self.values[at], -1)
        rest = np.flatnonzero((there != key) & (there >= 0) & (key >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & self.mask
            there = self.keys[at[rest]]
            hit = there == key[rest]
            out[rest[hit]] = self.values[at[rest[hit]]]
            rest = rest[~hit & (there >= 0)]
        return out


class Agenda:
    """Candidates are ranks, NONE for no candidate or a skipped one; of equal ranks the leftmost comes first."""

    def __init__(self, pieces: Pieces, rate: float):
        self.pieces = pieces
        self.limit = np.uint64(min(int(rate * 2.0**64), 2**64 - 1))

    def order(self, a: np.ndarray, b: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Merging a and b; key: the hash of seed, document and place of the left character."""
        piece = self.pieces.merged(a, b)
        out = np.where(piece >= 0, self.pieces.rank[piece], np.int32(NONE))
        if self.limit:
            some = np.flatnonzero(piece >= 0)
            skip = _mix(key[some] + piece[some].astype(np.uint64) * _C2) < self.limit
            out[some[skip]] = NONE
        return out

    def result(self, rank: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that candidates of these ranks make."""
        piece = self.pieces.piece_of[rank]
        if (piece < 0).any():
            piece = np.where(piece < 0, self.pieces.merged(a, b), piece)
        return piece


def _merge_in_step(agenda: Agenda, sym: np.ndarray, at: np.ndarray, keys: np.ndarray, put) -> None:
    """Merge rows of symbols (words of one length). at: places of the symbols; put: takes places and symbols of finished words.

    A row has its symbols, their places and the candidate of each with the next.
    """
    width = sym.shape[1]
    sym, at = sym.astype(np.int32), at.astype(np.int32)
    count = np.full(len(sym), width)
    merge = np.full(sym.shape, NONE, dtype=np.int32)
    if width > 1:
        merge[:, :-1] = agenda.order(sym[:, :-1].ravel(), sym[:, 1:].ravel(), keys[at[:, :-1].ravel()]).reshape(len(sym), -1)
    column = np.arange(width)
    while len(sym):
        best = merge.argmin(axis=1)
        rows = np.arange(len(sym))
        top = merge[rows, best]
        done = top == NONE
        if done.any():
            live = column[: sym.shape[1]] < count[done][:, None]
            put(at[done][live], sym[done][live])
            left = ~done
            sym, at, merge, count, best, top = sym[left], at[left], merge[left], count[left], best[left], top[left]
            if not len(sym):
                return
            rows = np.arange(len(sym))
        sym[rows, best] = agenda.result(top, sym[rows, best], sym[rows, best + 1])
        # the right part goes: what is after it moves up
        w = sym.shape[1]
        stay = column[:w] != (best + 1)[:, None]
        sym, at, merge = (m[stay].reshape(-1, w - 1) for m in (sym, at, merge))
        count = count - 1
        for place in (best - 1, best):
            ok = np.flatnonzero((place >= 0) & (place + 1 < count))
            x = place[ok]
            merge[ok, x] = agenda.order(sym[ok, x], sym[ok, x + 1], keys[at[ok, x]])
        end = np.flatnonzero(best == count - 1)
        merge[end, best[end]] = NONE


def _merge_by_heap(agenda: Agenda, sym: np.ndarray, at: np.ndarray, keys: np.ndarray, put) -> None:
    """The same for one long word."""
    n = len(sym)
    s, after, before, alive = sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(c, i, i + 1) for i, c in enumerate(agenda.order(sym[:-1], sym[1:], keys[at[:-1]]).tolist()) if c != NONE]
    heapq.heapify(heap)
    made = {(i, j): c for c, i, j in heap}
    while heap:
        c, i, j = heapq.heappop(heap)
        if not alive[i] or not alive[j] or after[i] != j or made.get((i, j)) != c:
            continue
        s[i], alive[j] = int(agenda.result(np.array([c]), np.array([s[i]]), np.array([s[j]]))[0]), False
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        for x, y in ((before[i], i), (i, k)):
            if x >= 0 and y < n:
                c = int(agenda.order(np.array([s[x]]), np.array([s[y]]), keys[at[x : x + 1]])[0])
                made.pop((x, y), None)
                if c != NONE:
                    made[x, y] = c
                    heapq.heappush(heap, (c, x, y))
    live = np.array(alive)
    put(at[live], np.array(s)[live])


def document_key(seed: int, doc_id: int | None) -> int:
    """64 bits from the seed and the id; a null id is told apart from every number."""
    raw = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")


def encode_batch(texts: list[str], doc_keys: list[int], pieces: Pieces, rate: float = RATE) -> list[np.ndarray]:
    """The ids of each text; an empty text has none."""
    line = "".join(" " + t for t in texts if t)
    if not line:
        return [np.zeros(0, pieces.dtype) for _ in texts]
    raw = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)
    place = (np.arange(len(raw)) - (ends - sizes)[owner]).astype(np.uint64)
    keys = _mix(np.array(doc_keys, dtype=np.uint64)[owner] + place * _C1)
    sym = pieces.char[np.where(raw == 32, SPACE, raw)].astype(np.int64)
    sym[raw == SPACE] = -1
    blank, first = raw == 32, np.zeros(len(raw), dtype=bool)
    first[(ends - sizes)[sizes > 0]] = True
    if not pieces.joins_words:
        cut = blank.copy()
        cut[1:] &= ~blank[:-1]
        stop = sym < 0  # never merges: a word of its own
        first |= cut | stop
        first[1:] |= stop[:-1]
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(raw)))
    out = np.full(len(raw), -2, dtype=np.int64)

    def put(at: np.ndarray, symbols: np.ndarray) -> None:
        out[at] = symbols

    agenda = Agenda(pieces, rate)
    one = starts[lengths == 1]
    put(one, sym[one])
    for size in np.unique(lengths[lengths > 1]).tolist():
        mine = starts[lengths == size]
        if size > LONG_WORD:
            for s in mine.tolist():
                at = np.arange(s, s + size)
                _merge_by_heap(agenda, sym[at], at, keys, put)
        else:
            at = mine[:, None] + np.arange(size)
            _merge_in_step(agenda, sym[at], at, keys, put)
    at = np.flatnonzero(out != -2)
    ids, code, doc = out[at], raw[at], owner[at]
    unknown = ids < 0
    width = np.where(unknown, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF), 1)
    final = np.repeat(ids, width)
    slot = np.cumsum(width) - width
    for k in range(4):
        has = np.flatnonzero(unknown & (width > k))
        if len(has):
            w, c = width[has], code[has]
            low = 0x80 | (c >> np.uint32(6) * (w - 1 - k).astype(np.uint32)) & 0x3F
            head = np.array([0, 0, 0xC0, 0xE0, 0xF0])[w] | c >> np.uint32(6) * (w - 1).astype(np.uint32)
            final[slot[has] + k] = pieces.byte_id[np.where(w == 1, c, head if k == 0 else low).astype(np.int64)]
    counts = np.bincount(doc, weights=width, minlength=len(texts)).astype(np.int64)
    return np.split(final.astype(pieces.dtype), np.cumsum(counts)[:-1])


def decode(ids: np.ndarray, pieces: Pieces) -> str:
    """The text of some ids: their bytes, without the space that stands before every text."""
    table = pieces.bytes_of
    return b"".join([table[i] for i in ids.tolist()])[1:].decode("utf-8")


_pieces: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


ENCODED = "doc_id long, n_bytes long, n_ids long, ids binary"


def _slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def encode(docs: DataFrame, model: str, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, n_bytes, n_ids and ids (little-endian) of each row of docs (doc_id, text); a null text is empty and has no ids.

    A map without a shuffle. Equal texts of the same id are encoded alike, of other ids in their own way; a null
    id is one more id. Other columns are not read; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for i, j in _slices([len(t) for t in texts], BATCH_CHARS):
                got = encode_batch(texts[i:j], [document_key(seed, d) for d in ids[i:j]], pieces, rate)
                n_bytes = [len(t.encode("utf-8", "replace")) for t in texts[i:j]]
                yield pa.record_batch([pa.array(ids[i:j], pa.int64()), pa.array(n_bytes, pa.int64()), pa.array([len(g) for g in got], pa.int64()), pa.array([g.tobytes() for g in got], pa.binary())], names=["doc_id", "n_bytes", "n_ids", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ENCODED)


def decoded(encoded: DataFrame, model: str) -> DataFrame:
    """encoded with its text: doc_id, n_bytes, n_ids, ids, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for b in batches:
            texts = [decode(np.frombuffer(i.as_buffer(), pieces.dtype), pieces) for i in b.column(3)]
            yield pa.record_batch([b.column(k) for k in range(4)] + [pa.array(texts, pa.string())], names=["doc_id", "n_bytes", "n_ids", "ids", "text"])

    return encoded.select("doc_id", "n_bytes", "n_ids", "ids").mapInArrow(run, ENCODED + ", text string")


def digest(docs: DataFrame, model: str, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """doc_id, n_bytes, n_ids, ids_crc32 (of the ids as little-endian unsigned 32-bit integers) and decoded_sha256 of each row; see encode for odd rows."""
    got = decoded(encode(docs, model, rate, seed), model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = pieces_of(model).dtype
        for b in batches:
            crc = [zlib.crc32(np.frombuffer(i.as_buffer(), dtype).astype("<u4").tobytes()) for i in b.column(3)]
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(crc, pa.int64()), b.column(4)], names=["doc_id", "n_bytes", "n_ids", "ids_crc32", "text"])

    rows = got.mapInArrow(run, "doc_id long, n_bytes long, n_ids long, ids_crc32 long, text string")
    return rows.select("doc_id", "n_bytes", "n_ids", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))
