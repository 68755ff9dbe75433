"""Token ids of whole texts by a tokenizers file, with the work on all texts of a batch done at once.

The library's own encoding spends most of its time on single pieces. Here the bytes of a batch are parted into
pieces by array operations that follow the file's pattern, equal pieces are told apart once, and the pieces
that are new are merged in step: one array operation finds the best merge of every piece, another applies it.
The result is equal to encode(text, add_special_tokens=False).

That is done for texts of Latin-1 alone, whose classes are the same in every version of Unicode and which have
no marks that combine. Other texts are parted at spaces, and only their parts beyond Latin-1 go to the library.
Texts that hold an added token, and files with other rules than the two that are known here, are used through
the library alone.
"""

from __future__ import annotations

import json
import re
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

# The pre-tokenization patterns of the two kinds of file.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")

PIECES = 100_000  # entries of a cache, held up to twice
BATCH_BYTES = 2 << 20  # of texts that are encoded at once
LONG_PIECE = 64  # bytes; longer ones are left to the library's model

SPACE, LETTER, NUMBER, OTHER = range(4)
LATIN = bytes(range(256)).decode("latin-1")
CLASS = np.array([SPACE if regex.match(r"\s", c) else LETTER if regex.match(r"\p{L}", c) else NUMBER if regex.match(r"\p{N}", c) else OTHER for c in LATIN], dtype=np.uint8)
LATIN_LOWER = bytes(ord(c.lower()) if len(c.lower()) == 1 and ord(c.lower()) < 256 else ord(c) for c in LATIN)
NONE = np.iinfo(np.int32).max
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def byte_letters() -> dict[int, int]:
    """Byte-level models name each byte by a printable letter: its own where it has one, else the next from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


class Recent(dict):
    """A cache of what is used: when full, its entries become the old half, from which a hit brings them back."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.old = limit, {}

    def known(self, keys: list) -> list:
        """The value of each key, None for those that are new."""
        out = list(map(self.get, keys))
        if self.old:
            for i, value in enumerate(out):
                if value is None:
                    value = self.old.get(keys[i])
                    if value is not None:
                        out[i] = self[keys[i]] = value
        return out

    def trim(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


def _values(array: pa.BinaryArray) -> list[bytes]:
    """The values of an array without nulls; slices of one copy are much faster than to_pylist."""
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[array.offset : array.offset + len(array) + 1].tolist()
    raw = data.to_pybytes() if data is not None else b""
    return [raw[x:y] for x, y in zip(at, at[1:])]


class Merges:
    """The merges of a BPE model as a table, and the first symbol of each byte."""

    def __init__(self, model: dict):
        vocab, suffix, letters = model["vocab"], model.get("end_of_word_suffix") or "", byte_letters()
        self.first = np.array([vocab.get(chr(letters[b]), -1) for b in range(256)], dtype=np.int32)
        self.last = np.array([vocab.get(chr(letters[b]) + suffix, -1) for b in range(256)], dtype=np.int32)
        self.whole = bool((self.first >= 0).all() and (self.last >= 0).all())
        pairs, made = {}, []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pairs[vocab[a] << 32 | vocab[b]] = rank  # of a pair named twice the library keeps the later rank
            made.append(vocab[a + b])
        self.made = np.array(made + [-1], dtype=np.int32)
        bits = max(10, (len(pairs) * 2).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, NONE, dtype=np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        for key, at in zip(keys.tolist(), self._slot(keys).tolist()):
            while self.keys[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.ranks[at] = key, pairs[key]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MULTIPLIER) >> self.shift).view(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of two symbols, NONE where there is none."""
        key = a.astype(np.int64) << 32 | b
        at = self._slot(key)
        there = self.keys[at]
        out = np.where(there == key, self.ranks[at], NONE)
        rest = np.flatnonzero((there != key) & (there >= 0))
        while len(rest):
            at[rest] = (at[rest] + 1) & self.mask
            there = self.keys[at[rest]]
            hit = there == key[rest]
            out[rest[hit]] = self.ranks[at[rest[hit]]]
            rest = rest[~hit & (there >= 0)]
        return out

    def merge(self, sym: np.ndarray, put) -> None:
        """Merge columns of symbols, all of one length; put takes the columns' numbers and their symbols when they are done."""
        number = np.arange(sym.shape[1])
        rank = self.rank(sym[:-1].ravel(), sym[1:].ravel()).reshape(len(sym) - 1, len(number))
        while len(rank):
            best, top = rank.argmin(axis=0), rank.min(axis=0)
            done = top == NONE
            if done.any():
                put(number[done], sym[:, done])
                left = ~done
                sym, rank, number, best, top = sym[:, left], rank[:, left], number[left], best[left], top[left]
                if not len(number):
                    return
            column, w = np.arange(len(number)), len(sym)
            sym[best, column] = self.made[top]
            # the right part goes: what is after it moves up
            for k in range(1, w - 1):
                np.copyto(sym[k], sym[k + 1], where=best < k)
                np.copyto(rank[k - 1], rank[k], where=best < k)
            sym, rank = sym[:-1], rank[:-1]
            if w > 2:
                before, after = np.flatnonzero(best > 0), np.flatnonzero(best < w - 2)
                at, x = np.concatenate((best[before] - 1, best[after])), np.concatenate((before, after))
                rank[at, x] = self.rank(sym[at, x], sym[at + 1, x])
        put(number, sym)


class Encoder:
    """added: whether texts may hold the file's added tokens, as encode() has it by default; else these are ordinary text."""

    def __init__(self, path: str, added: bool = False):
        self.path, self.matches_added = path, added
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        known = set(rules.get("model", {}).get("vocab") or ()) | {t["content"] for t in rules.get("added_tokens") or []}
        self.size = len(known)
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.merges = None
        self.kind = self._kind(rules)
        self.added = [t["content"].lower() for t in rules.get("added_tokens") or []] if added else []  # files may lower texts first
        self.letters = byte_letters()
        if self.kind != "other":
            self.merges = Merges(rules["model"])
            if not self.merges.whole:
                self.kind = "other"
        self.pattern = regex.compile(BYTE_LEVEL_PATTERN if self.kind == "spaces kept" else WORD_PATTERN)
        self.pieces = Recent(PIECES)

    @cached_property
    def tokenizer(self) -> Tokenizer:
        """The library's own, loaded for the first text that needs it."""
        t = Tokenizer.from_file(self.path)
        t.encode_special_tokens = not self.matches_added
        t.no_padding()
        t.no_truncation()
        return t

    @cached_property
    def model(self):
        return self.tokenizer.model

    @staticmethod
    def _kind(rules: dict) -> str:
        pre, normal, model = rules.get("pre_tokenizer") or {}, rules.get("normalizer"), rules.get("model") or {}
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        if plain and (rules.get("post_processor") is None or (rules["post_processor"] or {}).get("type") == "ByteLevel"):
            if pre.get("type") == "ByteLevel" and normal is None and not pre.get("add_prefix_space") and pre.get("use_regex", True):
                return "spaces kept"
            if pre.get("type") == "Sequence" and [n.get("type") for n in (normal or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
                first = pre["pretokenizers"][0]
                if first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed" and first["pattern"].get("Regex") == WORD_PATTERN:
                    return "spaces dropped"
        return "other"

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _alone(self, piece: bytes) -> bytes:
        """The ids of one piece, by the library's model."""
        letters = piece.decode("latin-1").translate(self.letters)
        return np.array([t.id for t in self.model.tokenize(letters)], dtype=self.dtype).tobytes()

    # pieces of Latin-1 texts

    def _bounds(self, buf: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The first places of the pieces of texts that stand one after the other in buf; first: of the texts that are not empty.

        Stretches of white space are pieces too, where the pattern has none for them.
        """
        kind = CLASS[buf]
        begin = np.zeros(len(buf), dtype=bool)
        begin[first] = True
        text = begin.copy()
        np.logical_or(begin[1:], kind[1:] != kind[:-1], out=begin[1:])
        if self.kind == "spaces kept":
            # a space before a word begins its piece, other white space before it is a piece of its own
            word = np.flatnonzero(begin & (kind != SPACE) & ~text)
            word = word[kind[word - 1] == SPACE]
            begin[word - 1] = True
            begin[word[buf[word - 1] == 32]] = False
        else:
            begin |= kind == NUMBER
        quote = np.flatnonzero((buf == 39) & begin)
        for tail in CONTRACTIONS:
            at = quote[quote + len(tail) < len(buf)]
            for k, c in enumerate(tail, 1):
                at = at[(buf[at + k] == c) & ~text[at + k]]
            begin[at + 1] = False
            after = at + 1 + len(tail)
            begin[after[after < len(buf)]] = True
        return np.flatnonzero(begin)

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of different pieces, given in Latin-1."""
        out: list[bytes] = [b""] * len(pieces)
        utf = [p if p.isascii() else p.decode("latin-1").encode() for p in pieces]
        if self.kind == "spaces dropped":
            utf = [b"" if CLASS[p[0]] == SPACE else u for p, u in zip(pieces, utf)]
        sizes = np.fromiter(map(len, utf), np.int64, len(utf))
        buf = np.frombuffer(b"".join(utf), dtype=np.uint8)
        starts = np.cumsum(sizes) - sizes
        rows, symbols, counts = [], [], []
        for size in (np.flatnonzero(np.bincount(sizes)[1:]) + 1).tolist():
            mine = np.flatnonzero(sizes == size)
            if size > LONG_PIECE:
                for i in mine.tolist():
                    out[i] = self._alone(utf[i])
                continue
            raw = buf[starts[mine] + np.arange(size)[:, None]]
            sym = self.merges.first[raw]
            sym[-1] = self.merges.last[raw[-1]]

            def put(number: np.ndarray, got: np.ndarray, mine=mine) -> None:
                rows.append(mine[number])
                symbols.append(got.T.astype(self.dtype).ravel())
                counts.append(np.full(len(number), len(got)))

            self.merges.merge(sym, put)
        if rows:
            data = np.concatenate(symbols).tobytes()
            at = (np.cumsum(np.concatenate(counts)) * self.dtype.itemsize).tolist()
            begin = 0
            for i, end in zip(np.concatenate(rows).tolist(), at):
                out[i] = data[begin:end]
                begin = end
        return out

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        got = self.pieces.known(pieces)
        new = [i for i, g in enumerate(got) if g is None]
        if new:
            for i, ids in zip(new, self._merged([pieces[i] for i in new])):
                got[i] = self.pieces[pieces[i]] = ids
        self.pieces.trim()
        return got

    def _latin(self, texts: list[bytes]) -> list[bytes]:
        data = b"".join(texts)
        if self.kind == "spaces dropped":
            data = data.translate(LATIN_LOWER)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        if not data:
            return [b""] * len(texts)
        buf = np.frombuffer(data, dtype=np.uint8)
        begin = np.cumsum(sizes) - sizes
        at = self._bounds(buf, begin[sizes > 0])
        offsets = np.append(at, len(buf)).astype(np.int32)
        pieces = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        different = _values(pieces.dictionary)
        ids = self._ids_of(different)
        flat = np.frombuffer(b"".join(ids), dtype=self.dtype)
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        code = pieces.indices.to_numpy()
        each = n[code]
        after = np.cumsum(each)
        out = flat[np.repeat((np.cumsum(n) - n)[code] - (after - each), each) + np.arange(int(after[-1]))]
        # a text ends where the last of its pieces does
        stop = np.concatenate(([0], after))[np.searchsorted(at, begin + sizes)] * self.dtype.itemsize
        raw = out.tobytes()
        return [raw[x:y] for x, y in zip([0, *stop[:-1].tolist()], stop.tolist())]

    # other texts

    def _split(self, part: str) -> bytes:
        try:
            part.encode("latin-1")
        except UnicodeEncodeError:
            return self._library(part)
        if self.kind == "spaces dropped":
            part = part.lower()
        return b"".join(self._ids_of([p.encode("latin-1") for p in self.pattern.findall(part)]))

    def _mixed(self, text: str) -> bytes:
        """A text with characters beyond Latin-1."""
        text = text.encode("utf-8", "replace").decode("utf-8")
        if self.kind == "spaces dropped":
            # no pattern crosses a space; composition could only do so with a mark that follows one
            if _MARK_AFTER_SPACE.search(text):
                return self._library(text)
            return b"".join(map(self._split, text.replace("\n", " ").split(" ")))
        # a space before a word begins a piece; white space before it ends one
        cut = _SPACE_BEFORE_WORD.split(text) if _SPACE_BEFORE_SPACE.search(text) else text.split(" ")
        if len(cut) > 1 and cut[-1] == "":  # a space at the end belongs to the white space before it
            cut[-2:] = [cut[-2] + " "]
        return self._split(cut[0]) + b"".join([self._split(" " + c) for c in cut[1:]])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned integers of self.dtype."""
        if self.kind == "other":
            return [self._library(t.encode("utf-8", "replace").decode("utf-8")) for t in texts]
        out: list[bytes] = [b""] * len(texts)
        latin: list[bytes] = []
        owner: list[int] = []
        size = 0

        def flush() -> None:
            for i, ids in zip(owner, self._latin(latin)):
                out[i] = ids

        for i, t in enumerate(texts):
            if self.added:
                low = t.lower()
                if any(a in low for a in self.added):
                    out[i] = self._library(t.encode("utf-8", "replace").decode("utf-8"))
                    continue
            try:
                raw = t.encode("latin-1")
            except UnicodeEncodeError:
                out[i] = self._mixed(t)
                continue
            if latin and size + len(raw) > BATCH_BYTES:
                flush()
                latin, owner, size = [], [], 0
            latin.append(raw)
            owner.append(i)
            size += len(raw)
        if latin:
            flush()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


_SPACE_BEFORE_SPACE = re.compile(r" \s")
_SPACE_BEFORE_WORD = re.compile(r" (?=\S)")
_MARK_AFTER_SPACE = re.compile("[ \n][" + "".join(chr(c) for c in range(0x300, 0x370)) + "]")

_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each file and process, so that a reused Python worker keeps what it has learnt."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, added=True)
    return _encoders[path]


def release() -> None:
    """Give up all encoders of this process."""
    _encoders.clear()
