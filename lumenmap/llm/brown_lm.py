"""Scores of a Brown class-based bigram model.

Words are counted over all training documents and put into classes by exchange clustering, which moves each word
to the class that most raises the likelihood of class bigrams:

* the core, words that make at least one in 20,000 tokens, with a symbol for the shape of all others (last
  character, letters beyond ASCII, length). Their bigrams are counted once and kept as a table; a sweep sums it by
  the classes of either side and moves every other symbol, until no two sweeps raise the likelihood any more;
* every other word that occurs twice, however many there are, is exchanged once against the classes that the
  core has made: its neighbours' classes come together by word, and no list of words goes to the driver. Rarer
  words stay with their shape: a class chosen by one place fits that place and no others.

These words don't sharpen the class bigrams that chose their classes: the bigrams are those of the core and the
shapes, scaled to the classes' final sizes. Then P(word | before) = P(class | class before) * P(word | class).
Transitions are smoothed by the classes' own shares. A class keeps a share for words that were never seen, by the
number of words seen once of their shape. Every text ends with an end token that has a class of its own.

A bounded number of the most frequent words, with their counts and classes, goes to all executors. The other words
are joined: each document sends its own rare words once each, and none of these is frequent in training.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, LOWER, cut, fold, in_chunks, settle, texts_of

FREQUENT = 100_000  # words whose counts and classes every executor gets
CORE = 5e-5  # share of the tokens from which a word takes part in all sweeps; so at most 20,000 do
CLASSES = 80
LEAST = 2  # occurrences from which a word outside the core is exchanged
PRIOR = 200.0  # weight, in tokens, of the classes' own shares in a transition
TOLERANCE = 1e-3  # log-likelihood a token by which two sweeps must better it
SHAPES = 24
HOLE = 255
CHUNK = 2 << 20
HELD_ROWS = 40_000  # that a task takes together, besides those of its last word or document
TABLE_PARTS = 32  # of the table of bigrams

TABLE = bytes(32 if IS_SPACE[b] else LOWER[b] for b in range(256))


@dataclass
class Words:
    """The words of some texts: the different words, and of each occurrence the number of its word and of its text."""

    word: pa.BinaryArray
    shape: np.ndarray
    code: np.ndarray
    text: np.ndarray
    texts: int


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.BinaryArray:
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def words_of(texts: list[bytes]) -> Words:
    """Texts as UTF-8; A-Z are lowered."""
    data = b"".join([t.translate(TABLE) + b" " for t in texts])
    buf = np.frombuffer(data, dtype=np.uint8)
    blank = buf == 32
    begin = ~blank
    begin[1:] &= blank[:-1]
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    text = np.searchsorted(np.cumsum(sizes), np.flatnonzero(begin), side="right")
    stay = ~blank
    stay[1:] |= ~blank[:-1]
    stay[0] = not blank[0]
    close = buf[stay]
    offsets = np.concatenate(([0], np.flatnonzero(close == 32) + 1))
    coded = _binary(close, offsets).dictionary_encode()
    # each has the space that ended it
    word = pc.binary_slice(coded.dictionary, 0, -1)
    raw, at = np.frombuffer(coded.dictionary.buffers()[2] or b"", np.uint8), np.frombuffer(coded.dictionary.buffers()[1], np.int32)[: len(word) + 1].astype(np.int64)
    return Words(word, shapes_of(raw, at), coded.indices.to_numpy().astype(np.int64), text, len(texts))


def shapes_of(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The shape of each word, given with a space behind it."""
    if len(at) < 2:
        return np.zeros(0, np.int64)
    last, size = raw[at[1:] - 2], np.diff(at) - 1
    wide = np.maximum.reduceat(raw, at[:-1]) >= 128
    kind = np.select([(last >= 97) & (last <= 122), last >= 128, (last == 46) | (last == 44)], [0, 1, 2], 3)
    return (kind * 2 + wide) * 3 + np.select([size <= 4, size <= 8], [0, 1], 2)


def _chunks(column: pa.Array) -> Iterator[list[bytes]]:
    yield from in_chunks((t.encode("utf-8", "replace") for t in texts_of(column)), CHUNK)


def count_words(texts: DataFrame) -> DataFrame:
    """word, its shape and its count over all texts (column text); words are counted within a chunk first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        for b in batches:
            for chunk in _chunks(b.column(0)):
                w = words_of(chunk)
                yield pa.record_batch([w.word, pa.array(w.shape.astype(np.int32)), pa.array(np.bincount(w.code, minlength=len(w.word)))], names=["word", "shape", "n"])

    return texts.select("text").mapInArrow(count, "word binary, shape int, n long").groupBy("word", "shape").agg(F.sum("n").alias("c"))


def frequent_from(counts: DataFrame, most: int) -> int:
    """A count that at most so many words reach. Words are counted by buckets of counts, 64 to a power of two, so few rows come back."""
    bucket = F.floor(F.log2(F.col("c")) * 64).cast("int")
    rows = counts.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"), F.min("c").alias("c")).orderBy(F.desc("b")).collect()
    words, least = 0, (rows[0]["c"] << 7 if rows else 1)
    for r in rows:
        words += r["n"]
        if words > most:
            break
        least = r["c"]
    return least


@dataclass
class Vocabulary:
    """The frequent words, the most frequent first, ties by word; the first `core` take part in all sweeps."""

    word: pa.BinaryArray
    shape: np.ndarray
    count: np.ndarray
    core: int

    @property
    def size(self) -> int:
        """Symbols: the core, the shapes and the boundary, which is the last."""
        return self.core + SHAPES + 1

    def places(self, word: pa.BinaryArray) -> np.ndarray:
        """The place of each word, -1 for words that are not frequent."""
        return pc.fill_null(pc.index_in(word, value_set=self.word), -1).to_numpy().astype(np.int64)

    def symbols(self, w: Words) -> np.ndarray:
        """The symbol of each different word."""
        place = self.places(w.word)
        return np.where((place >= 0) & (place < self.core), place, self.core + w.shape)


def vocabulary(counts: DataFrame, least: int, core_from: float) -> Vocabulary:
    t = counts.where(F.col("c") >= least).select("word", "shape", "c").toArrow().combine_chunks()
    t = t.take(pc.sort_indices(t, [("c", "descending"), ("word", "ascending")]))
    c = t.column("c").to_numpy()
    word = t.column("word").combine_chunks().cast(pa.binary()) if len(t) else pa.array([], pa.binary())
    if isinstance(word, pa.ChunkedArray):
        word = word.combine_chunks()
    return Vocabulary(word, t.column("shape").to_numpy().astype(np.int64), c, int((c >= core_from).sum()))


def _line(values: np.ndarray, w: Words, boundary: int) -> tuple[np.ndarray, np.ndarray]:
    """A value for each word with a boundary before the first text and after each, and the places of the words."""
    at = np.arange(len(w.code)) + w.text + 1
    line = np.full(len(w.code) + w.texts + 1, boundary, dtype=np.int64)
    line[at] = values
    return line, at


def count_bigrams(texts: DataFrame, shared) -> DataFrame:
    """(a, b, n) of symbol bigrams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        v = shared.value
        for b in batches:
            for chunk in _chunks(b.column(0)):
                w = words_of(chunk)
                line, _ = _line(v.symbols(w)[w.code], w, v.size - 1)
                pair, n = np.unique(line[:-1] * v.size + line[1:], return_counts=True)
                yield pa.record_batch([pa.array((pair // v.size).astype(np.int32)), pa.array((pair % v.size).astype(np.int32)), pa.array(n)], names=["a", "b", "n"])

    return texts.select("text").mapInArrow(count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


# exchange clustering

Vectors = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(joint: np.ndarray) -> float:
    return float(_xlogx(joint).sum() - _xlogx(joint.sum(0)).sum() - _xlogx(joint.sum(1)).sum())


def class_vectors(bigrams: DataFrame, size: int, total: int) -> Vectors:
    """For labels, the counts of each symbol before and after each class: (size, total) either way. The table is read once a sweep."""

    def vectors(label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(2 * size * total, np.int64)
            for batch in batches:
                a, b, n = (c.to_numpy().astype(np.int64) for c in batch.columns)
                np.add.at(sums, a * total + label[b], n)
                np.add.at(sums, size * total + b * total + label[a], n)
            key = np.flatnonzero(sums)
            yield pa.record_batch([pa.array(key), pa.array(sums[key])], names=["key", "n"])

        got = bigrams.mapInArrow(add, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # at most 2 * size * total rows
        both = np.zeros(2 * size * total)
        both[got.column("key").to_numpy()] = got.column("n").to_numpy()
        return both[: size * total].reshape(size, total), both[size * total :].reshape(size, total)

    return vectors


def exchange(loop: np.ndarray, vectors: Vectors, classes: int = CLASSES, tolerance: float = TOLERANCE) -> np.ndarray:
    """The class of each symbol; the last symbol keeps a class of its own, the last one.

    loop: how often each symbol follows itself. Every other symbol moves in a sweep, in the order of frequency, ties
    by number, against class bigrams that follow each move; the counts beside single symbols are those from before
    the sweep. A sweep that doesn't raise the likelihood is taken back, and two such end the clustering. Ties of
    classes go to the lesser; so the result is the same every time.
    """
    size = len(loop)
    classes = max(1, min(classes, size - 1))
    label, total = np.full(size, classes, dtype=np.int64), classes + 1
    best, best_value, order, part, idle = None, -np.inf, None, 0, 0
    while True:
        if order is None:
            label[:-1] = np.arange(size - 1) % classes
        out, into = vectors(label)
        if order is None:
            freq = out.sum(1) + into.sum(1)
            order = np.argsort(-freq[:-1], kind="stable")
            first = np.full(size, classes, dtype=np.int64)
            first[order] = np.arange(size - 1) % classes
            if not np.array_equal(first, label):
                label = first
                out, into = vectors(label)
        joint = np.zeros((total, total))
        np.add.at(joint, label, out)
        value = likelihood(joint)
        idle = 0 if best is None or value > best_value + tolerance * max(1.0, joint.sum()) else idle + 1
        if best is None or value > best_value:
            best, best_value = (label.copy(), out, into), value
        else:
            label, out, into = best[0].copy(), best[1], best[2]
            joint = np.zeros((total, total))
            np.add.at(joint, label, out)
        if idle == 2:
            return best[0]
        _sweep(label, joint, out, into, loop, order[part::2], freq, classes)
        part ^= 1


def _sweep(label: np.ndarray, joint: np.ndarray, out: np.ndarray, into: np.ndarray, loop: np.ndarray, symbols: np.ndarray, freq: np.ndarray, classes: int) -> None:
    """Move symbols to their best classes; label and joint follow."""
    for w in symbols.tolist():
        if not freq[w]:
            continue
        old, self_loop = label[w], loop[w]
        a, b = out[w].copy(), into[w].copy()
        a[old] -= self_loop
        b[old] -= self_loop  # links to the others of its class only
        base = joint.copy()
        base[old] -= a
        base[:, old] -= b
        base[old, old] -= self_loop
        np.maximum(base, 0, out=base)  # the counts beside symbols are from before the sweep
        gain = _xlogx(base + a).sum(1) - _xlogx(base).sum(1) + _xlogx(base.T + b).sum(1) - _xlogx(base.T).sum(1)
        d = np.diag(base)
        gain -= _xlogx(d + a) - _xlogx(d) + _xlogx(d + b) - _xlogx(d)
        gain += _xlogx(d + a + b + self_loop) - _xlogx(d)
        row, col = base.sum(1), base.sum(0)
        gain -= _xlogx(row + out[w].sum()) - _xlogx(row) + _xlogx(col + into[w].sum()) - _xlogx(col)
        new = int(np.argmax(gain[:classes]))
        if gain[new] <= gain[old] + 1e-9:
            continue
        base[new] += a
        base[:, new] += b
        base[new, new] += self_loop
        joint[:] = base
        label[w] = new


def smoothed(joint: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(class | class before), smoothed by the classes' shares, and these."""
    share = (joint.sum(0) + 1) / (joint.sum() + len(joint))
    return (joint + PRIOR * share) / (joint.sum(1, keepdims=True) + PRIOR), share


def best_classes(after: np.ndarray, before: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """For words with counts by the class after and before (words, classes): the class that most raises the likelihood of their places; ties to the lesser.

    That is by the smoothed bigrams as they are: each word is one of very many, and if each counted on what it
    alone would add, all would go to the smallest class.
    """
    step, share = smoothed(joint)
    gain = (after @ np.log(step).T + before @ np.log(step / share))[:, : len(joint) - 1]
    return (gain >= gain.max(axis=1, keepdims=True) - 1e-9).argmax(axis=1)


def _contexts(texts: DataFrame, shared, label: np.ndarray) -> DataFrame:
    """Rows (word, shape, beside) of the words outside the core: for each occurrence a byte for the class before and one for the class after. A neighbour outside the core has the class of its shape."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        v = shared.value
        for b in batches:
            for chunk in _chunks(b.column(0)):
                w = words_of(chunk)
                symbol = v.symbols(w)
                rest = symbol >= v.core
                line, at = _line(label[symbol][w.code], w, int(label[-1]))
                mine = np.flatnonzero(rest[w.code])
                mine = mine[np.argsort(w.code[mine], kind="stable")]
                beside = np.stack((line[at[mine] - 1], line[at[mine] + 1]), axis=1).astype(np.uint8).ravel()
                n = np.bincount(w.code[mine], minlength=len(w.word))
                some = np.flatnonzero(n)
                yield pa.record_batch([w.word.take(pa.array(some)), pa.array(w.shape[some].astype(np.int32)), _binary(beside, np.concatenate(([0], np.cumsum(n[some]))) * 2)], names=["word", "shape", "beside"])

    return texts.select("text").mapInArrow(rows, "word binary, shape int, beside binary")


ASSIGNED = "word binary, shape int, c long, class int"


def _assigned(contexts: DataFrame, joint: np.ndarray, shape_class: np.ndarray, least: int) -> DataFrame:
    """Rows (word, shape, c, class) of each word; those of fewer than `least` occurrences have the class of their shape."""
    total = len(joint)

    def choose(table: pa.Table) -> pa.RecordBatch:
        word = table.column("word").combine_chunks().dictionary_encode()
        which = word.indices.to_numpy()
        raw = table.column("beside").combine_chunks()
        ends = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
        beside = np.frombuffer(raw.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, 2).astype(np.int64)
        owner = np.repeat(which, np.diff(ends) // 2)
        n = len(word.dictionary)
        after, before = (np.bincount(owner * total + beside[:, k], minlength=n * total).reshape(n, total) for k in (1, 0))
        shape = np.zeros(n, np.int32)
        shape[which] = table.column("shape").to_numpy()
        to = shape_class[shape]
        often = np.flatnonzero(after.sum(1) >= least)
        to[often] = best_classes(after[often], before[often], joint)
        return pa.record_batch([word.dictionary, pa.array(shape), pa.array(after.sum(1)), pa.array(to.astype(np.int32))], names=["word", "shape", "c", "class"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        held: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            rows += b.num_rows
            if rows < HELD_ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            same = pc.equal(table.column("word"), table.column("word")[-1]).combine_chunks()
            stop = table.num_rows - int(pc.sum(same.cast(pa.int64())).as_py())  # the last word may go on
            if stop:
                yield choose(table.slice(0, stop))
            held = table.slice(stop).to_batches()
            rows = table.num_rows - stop
        if rows:
            yield choose(pa.Table.from_batches(held).combine_chunks())

    return contexts.repartition("word").sortWithinPartitions("word").mapInArrow(run, ASSIGNED)


# the model


@dataclass(frozen=True)
class ClassModel:
    step: np.ndarray  # log10 of class transitions
    mass: np.ndarray  # log10 of each class's divisor
    unseen: np.ndarray  # log10 P(word | class) of a word of each shape that was never seen
    shape_class: np.ndarray
    label: np.ndarray  # class of each frequent word
    tokens: int  # N
    distinct: int  # V
    ends: int


def class_model(joint: np.ndarray, shape_class: np.ndarray, class_tokens: np.ndarray, once: np.ndarray, distinct_of: np.ndarray, label: np.ndarray, tokens: int, distinct: int, ends: int) -> ClassModel:
    """class_tokens: tokens of the words of each class; once and distinct_of: words seen once, and words, of each shape."""
    total = len(joint)
    step = np.log10(smoothed(joint)[0])
    spare = once + 1.0
    mass = class_tokens.astype(np.float64)
    np.add.at(mass, shape_class, spare)
    mass[-1] = 1  # the boundary's class has the end alone
    mass = np.log10(np.maximum(mass, 1))
    return ClassModel(step, mass, np.log10(spare / (distinct_of + 1.0)) - mass[shape_class], shape_class, label, tokens, distinct, ends)


DOC = "line binary, holes binary, doc_id long, held_out boolean, known long, logs double, emitted double"


def _score_rows(docs: DataFrame, shared) -> DataFrame:
    """A row for each document with its line of classes, in which words that are not frequent are holes, and a row for each different such word of it.

    A document's rows are tied by x and y; the word of its own row holds a space and so matches none.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        v, model = shared.value
        log_count, log_next = np.log10(np.maximum(v.count, 1)), np.log10(v.count + 1.0)
        emit = log_count - model.mass[model.label] if len(v.count) else log_count
        names = ["word", "x", "y", "k", "shape", *(c.split()[0] for c in DOC.split(", "))]
        for b in batches:
            done = 0
            for chunk in _chunks(b.column(4)):
                m = len(chunk)
                x, y = (b.column(i).slice(done, m).to_numpy() for i in (0, 1))
                w = words_of(chunk)
                place = v.places(w.word)
                known = place[w.code] >= 0
                at = place[w.code[known]]
                line = np.full(len(w.code), HOLE, np.uint8)
                line[known] = model.label[at]
                per = [np.bincount(w.text[known], weights=g, minlength=m) for g in (log_next[at], emit[at])]
                pair, first, hole = np.unique(w.text[~known] * len(w.word) + w.code[~known], return_index=True, return_inverse=True)
                order = np.argsort(first)  # by first occurrence, so that copies of a document number alike
                pair, hole = pair[order], np.argsort(order)[hole]
                owner, word = (pair // len(w.word), pair % len(w.word)) if len(pair) else (pair, pair)
                k = np.arange(len(pair)) - np.searchsorted(owner, np.arange(m))[owner]
                ends = np.concatenate(([0], np.cumsum(np.bincount(w.text, minlength=m))))
                hole_ends = np.concatenate(([0], np.cumsum(np.bincount(w.text[~known], minlength=m)))) * 4
                own = np.concatenate((np.full((m, 1), 32, np.uint8), x[:, None].copy().view(np.uint8).reshape(m, 8)), axis=1)
                no = pa.nulls(m, pa.int32())
                yield pa.record_batch(
                    [
                        _binary(own.ravel(), np.arange(m + 1) * 9),
                        pa.array(x),
                        pa.array(y),
                        no,
                        no,
                        _binary(line, ends),
                        _binary(k[hole].astype("<u4").view(np.uint8) if len(hole) else np.zeros(0, np.uint8), hole_ends),
                        b.column(2).slice(done, m),
                        b.column(3).slice(done, m),
                        pa.array(np.bincount(w.text[known], minlength=m)),
                        pa.array(per[0], pa.float64()),
                        pa.array(per[1], pa.float64()),
                    ],
                    names=names,
                )
                if len(pair):
                    n = len(pair)
                    blank = [pa.nulls(n, t) for t in (pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.int64(), pa.float64(), pa.float64())]
                    yield pa.record_batch([w.word.take(pa.array(word)), pa.array(x[owner]), pa.array(y[owner]), pa.array(k.astype(np.int32)), pa.array(w.shape[word].astype(np.int32)), *blank], names=names)
                done += m

    return docs.select("x", "y", "doc_id", "held_out", "text").mapInArrow(score, "word binary, x long, y long, k int, shape int, " + DOC)


def _finish(table: pa.Table, model: ClassModel) -> pa.RecordBatch:
    """Scores of the documents whose rows these are, one document's after the other: holes are filled with the classes of the words that were found."""
    col = lambda c: table.column(c).combine_chunks()
    boundary = len(model.step) - 1
    x, y = col("x").to_numpy(), col("y").to_numpy()
    new = np.ones(len(x), dtype=bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    group = np.cumsum(new) - 1
    m = int(group[-1]) + 1
    own = np.array(col("line").is_valid())
    copies = np.bincount(group[own], minlength=m)
    doc = np.flatnonzero(own)
    doc = doc[np.unique(group[doc], return_index=True)[1]]  # copies of a document have the same line
    d = table.select([c.split()[0] for c in DOC.split(", ")]).take(pa.array(doc)).combine_chunks()
    line, line_ends = _flat(_one(d, "line"), np.uint8)
    hole, _ = _flat(_one(d, "holes"), np.dtype("<u4"))
    word = np.flatnonzero(~own)
    k, shape_of = col("k").take(pa.array(word)).to_numpy().astype(np.int64), col("shape").take(pa.array(word)).to_numpy()
    each = np.zeros(m, np.int64)
    np.maximum.at(each, group[word], k + 1)
    base = np.cumsum(each) - each
    slot = base[group[word]] + k
    c, cls, shape = (np.zeros(int(each.sum()), np.int64) for _ in range(3))
    found_c, found_cls = col("c").take(pa.array(word)), col("class").take(pa.array(word))
    c[slot] = pc.fill_null(found_c, 0).to_numpy()
    shape[slot] = shape_of
    cls[slot] = np.where(np.array(found_c.is_valid()), pc.fill_null(found_cls, 0).to_numpy(), model.shape_class[shape_of])
    text = np.repeat(np.arange(m), np.diff(line_ends))
    whole = line.astype(np.int64)
    at = np.flatnonzero(line == HOLE)
    of = base[text[at]] + hole
    whole[at] = cls[of]
    found = c[of] > 0
    seen = np.bincount(text[at][found], minlength=m)
    logs = np.bincount(text[at][found], weights=np.log10(c[of][found] + 1.0), minlength=m)
    emitted = np.bincount(text[at], weights=np.where(found, np.log10(np.maximum(c[of], 1)) - model.mass[cls[of]], model.unseen[shape[of]]), minlength=m)
    full = np.full(len(whole) + m + 1, boundary)
    full[np.arange(len(whole)) + text + 1] = whole
    steps = model.step[full[:-1], full[1:]]
    last = line_ends[1:] + np.arange(m)  # each text's step to its end
    stepped = np.add.reduceat(steps, np.concatenate(([0], last[:-1] + 1)))
    again = pa.array(np.repeat(np.arange(m), copies))
    n_tokens = np.diff(line_ends) + 1
    log_counts = _one(d, "logs").to_numpy() + logs + np.log10(model.ends + 1.0)
    base_score = log_counts - n_tokens * np.log10(model.tokens + model.distinct + 1)
    score = stepped + emitted + _one(d, "emitted").to_numpy()
    n_known = _one(d, "known").to_numpy() + seen + (model.ends > 0)
    cols = [_one(d, "doc_id"), _one(d, "held_out"), pa.array(n_tokens), pa.array(n_known), pa.array(np.full(m, model.tokens)), pa.array(base_score), pa.array(score), pa.array(10.0 ** (-score / n_tokens))]
    return pa.record_batch([v.take(again) for v in cols], names=[n.split()[0] for n in SCORES.split(", ")])


def _one(table: pa.Table, name: str) -> pa.Array:
    c = table.column(name)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def _scored(rows: DataFrame, shared) -> DataFrame:
    """Rows of documents and their words to scores. They are sorted by document, so that each task holds few at a time."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        _, model = shared.value
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            n += b.num_rows
            if n < HELD_ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            x, y = _one(table, "x").to_numpy(), _one(table, "y").to_numpy()
            stop = int(np.flatnonzero((x != x[-1]) | (y != y[-1]))[-1:].sum()) + 1 if ((x != x[-1]) | (y != y[-1])).any() else 0
            if stop:  # the last document may go on
                yield _finish(table.slice(0, stop), model)
            held = table.slice(stop).to_batches()
            n = table.num_rows - stop
        if n:
            yield _finish(pa.Table.from_batches(held).combine_chunks(), model)

    names = ["x", "y", "k", "shape", "c", "class", *(c.split()[0] for c in DOC.split(", "))]
    return rows.select(*names).repartition("x", "y").sortWithinPartitions("x", "y").mapInArrow(finish, SCORES)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def _flat(column: pa.BinaryArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and where each row's begin and end."""
    width = np.dtype(dtype).itemsize
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.copy().view(dtype), (ends - ends[0]) // width


def score(docs: DataFrame, folds: int = 7, held: int = 2, frequent: int = FREQUENT, core: float = CORE, classes: int = CLASSES, least_count: int = LEAST) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of each row of docs (doc_id, text).

    Training takes every row outside the held-out fold, however many. A null text is empty: its end token
    alone is scored. Repeated rows are counted and scored each for itself. With no training rows N and V are 0
    and the model is uniform over its classes. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    key = [F.col("doc_id"), F.col("doc_id").isNull(), F.coalesce("text", F.lit(""))]
    texts = docs.select(F.xxhash64(*key).alias("x"), F.xxhash64(F.lit(1), *key).alias("y"), F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", folds) == held).alias("held_out"), "text")
    train = texts.where(~F.col("held_out"))
    counts = cut(count_words(train), "lm-counts")
    ends = train.count()
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    least = frequent_from(counts, frequent)
    v = vocabulary(counts, least, core * tokens)  # bounded by frequent
    shared = spark.sparkContext.broadcast(v)
    bigrams = cut(count_bigrams(train, shared), "lm-bigrams")
    bigrams = cut(bigrams.coalesce(TABLE_PARTS), "lm-table")  # read once a sweep; bounded by the core's size, whatever the input's
    total = max(1, min(classes, v.size - 1)) + 1
    loops = bigrams.where("a = b").toArrow()  # at most one row for each symbol
    loop = np.zeros(v.size)
    loop[loops.column("a").to_numpy()] = loops.column("n").to_numpy()
    vectors = class_vectors(bigrams, v.size, total)
    label = exchange(loop, vectors, classes)
    joint = np.zeros((total, total))
    np.add.at(joint, label, vectors(label)[0])
    rest = cut(_assigned(_contexts(train, shared, label), joint, label[v.core : v.core + SHAPES], least_count), "lm-classes")
    class_tokens = np.bincount(label[: v.core], weights=v.count[: v.core], minlength=total)
    for r in rest.groupBy("class").agg(F.sum("c").alias("n")).collect():
        class_tokens[r["class"]] += r["n"]
    once, distinct_of = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in counts.groupBy("shape").agg(F.count("*").alias("v"), F.sum((F.col("c") == 1).cast("long")).alias("once")).collect():
        once[r["shape"]], distinct_of[r["shape"]] = r["once"], r["v"]
    # a class's words outside the core are taken to follow and to be followed as those inside it
    grown = class_tokens / np.maximum(joint.sum(0), 1)
    grown[-1] = 1
    model = class_model(joint * grown * grown[:, None], label[v.core : v.core + SHAPES], class_tokens, once, distinct_of, _labels(v, label, rest, least), tokens, distinct, ends)
    shared = spark.sparkContext.broadcast((v, model))
    rows = _score_rows(texts, shared)
    joined = rows.join(rest.where(F.col("c") < least).select("word", "c", "class"), "word", "left")
    return _scored(joined, shared)


def _labels(v: Vocabulary, label: np.ndarray, rest: DataFrame, least: int) -> np.ndarray:
    """The class of each frequent word."""
    got = rest.where(F.col("c") >= least).select("word", "class").toArrow()  # bounded as the frequent words are
    out = np.zeros(len(v.count), dtype=np.int64)
    out[: v.core] = label[: v.core]
    if len(got):
        word = got.column("word").combine_chunks()
        out[v.places(word.combine_chunks() if isinstance(word, pa.ChunkedArray) else word)] = got.column("class").to_numpy()
    return out
