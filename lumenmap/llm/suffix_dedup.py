"""Removal of repeated passages by prefix-free parsing and suffix arrays.

Every byte goes that is covered by a string of `length` bytes which also starts anywhere else, in any document
or the same one.

Parsing. A rolling hash over 8 bytes picks triggers: for a string of `length` bytes, its trigger is the place
of the least hash among its first `gap` places (the rightmost of equal ones). It depends on the string alone,
so equal strings have equal triggers at equal places, and no string is without one. Strings that start one
after the other and have the same trigger make a run; the bytes from the run's start to the trigger's end are
its phrase, and what follows is the text that the next phrases parse.

Finding. Strings that are equal agree on the bytes from their trigger on, so a run whose bytes from the trigger
on (as many as all its strings have) occur once in the corpus has no repeated string. Only the hash of these
bytes goes through the first shuffle. Of the other runs, those that are equal as a whole are repeated as a
whole. What remains are the runs in which a repeated passage begins or ends. Their bytes are brought together
by the hash of what follows the trigger, and there the corpus order is made of two arrays: the suffixes of the
phrases of the dictionary are ranked from the trigger's end backwards, each by its first byte and the rank of
the rest; the texts that follow are sorted, with the lengths of the prefixes that neighbours share. A string
is a phrase's suffix and a prefix of what follows, so strings are equal when they have the same suffix rank and
no shorter shared prefix lies between them in the order of what follows.

A place of the corpus with more different runs than one task should sort is parted: the strings of its runs are
dealt by how far before the trigger's end they start, in cells of a few bytes. All strings of a cell share more
bytes than those of the place, so its parts are places of their own, keyed by the hash of these bytes, and go
through the same steps with ever smaller cells. In a cell of one byte the shared bytes are the whole string.

Words. Sequences of words go through the same steps as strings: a text becomes the codes of its words, 8 bytes
each, and only multiples of 8 are places of triggers and starts of strings (`unit`). Words are told apart by 64
bits of XXH3 and nothing but words counts, so passages are equal whatever white space parts their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, in_chunks, settle

LENGTH = 400
GAP = 160  # at most 256, as a run's extents are stored in a byte each
WIDTH = 8
CHUNK = 1 << 20
LARGE = 1_000  # different runs at one place of the corpus that one task sorts
CELLS = (32, 8, 1)  # bytes of the cells by which a larger place is parted, one after the other
SORTED = 10_000  # runs that a task sorts at a time, besides the last place's
PASSAGE_WORDS = 51  # "over 50 words"
WORD_CELLS = (64, 16, 8)  # CELLS for word codes


def _least(key: np.ndarray, gap: int) -> np.ndarray:
    """The least of each gap consecutive values."""
    have, out = 1, key
    while have * 2 <= gap:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < gap:
        out = np.minimum(out[: len(out) - (gap - have)], out[gap - have :])
    return out


def word_codes(text: bytes) -> bytes:
    """WIDTH bytes for each word of a text; white space as for `SPACE_BYTES`."""
    return b"".join(map(xxhash.xxh3_64_digest, text.split()))


def parse(texts: list[bytes], length: int = LENGTH, gap: int = GAP, unit: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of the texts: the text's number, the first and the last start, and the trigger's place, counted in the texts' concatenation.

    With a unit, starts and triggers are multiples of it; texts, length and gap must be such too.
    """
    empty = np.zeros(0, np.int64)
    buf = np.frombuffer(b"".join(texts) + bytes(WIDTH), dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) // unit
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    length, gap = length // unit, gap // unit
    if n < length:
        return empty, empty, empty, empty
    gram = np.lib.stride_tricks.sliding_window_view(buf, WIDTH)[: n * unit : unit].copy().view(np.uint64).ravel()
    gram = gram * np.uint64(0x9E3779B97F4A7C15)
    gram ^= gram >> np.uint64(32)
    gram *= np.uint64(0xD6E8FEB86659FD93)
    gram &= np.uint64(0xFFFFFFFF00000000)
    gram |= np.arange(0xFFFFFFFF, 0xFFFFFFFF - n, -1, dtype=np.uint64)
    trigger = np.uint64(0xFFFFFFFF) - (_least(gram, gap) & np.uint64(0xFFFFFFFF))
    trigger = trigger[: n - length + 1].astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)[: len(trigger)]
    inside = np.arange(len(trigger)) + length <= ends[doc]
    change = np.ones(len(trigger), dtype=bool)
    change[1:] = (trigger[1:] != trigger[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(change & inside)
    if not len(first):
        return empty, empty, empty, empty
    # a run ends before the next one's start, or with the last string of its text
    last = np.minimum(np.append(np.flatnonzero(change)[1:], len(trigger))[np.searchsorted(np.flatnonzero(change), first)] - 1, ends[doc[first]] - length)
    return doc[first], first * unit, last * unit, trigger[first] * unit


def run_rows(texts: list[bytes], length: int = LENGTH, gap: int = GAP, unit: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each run: its text's number, the hash of what follows the trigger, the hash of the whole, and its place packed."""
    doc, first, last, trigger = parse(texts, length, gap, unit)
    if not len(doc):
        return doc, doc, doc, doc
    whole = b"".join(texts)
    right = length - gap + unit
    hashed = xxhash.xxh3_64_intdigest
    a, b, t = first.tolist(), last.tolist(), trigger.tolist()
    place = np.fromiter((hashed(whole[x : x + right], 1) for x in t), np.uint64, len(t))
    own = np.fromiter((hashed(whole[x : y + length], (z - x) << 8 | (y - x)) for x, y, z in zip(a, b, t)), np.uint64, len(t))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    local = first - (np.cumsum(sizes) - sizes)[doc]
    return doc, place.view(np.int64), own.view(np.int64), local << 16 | (trigger - first) << 8 | (last - first)


def unpack_place(at):
    """First start in the text, trigger's distance from it, last start's distance from it."""
    return at >> 16, at >> 8 & 0xFF, at & 0xFF


def repeated_starts(runs: list[bytes], ahead: np.ndarray, span: np.ndarray, length: int = LENGTH, unit: int = 1) -> np.ndarray:
    """For each run (row) and start within it (column, in units), whether its string occurs more than once among the runs.

    runs: the bytes from the first start to the last string's end; ahead: the trigger's distance from the
    first start; span: the last start's.
    """
    n = len(runs)
    phrase = ahead + WIDTH
    widest = int(phrase.max())
    out = np.zeros((n, int(span.max()) // unit + 1), dtype=bool)
    # what follows the phrases, sorted, and the shared prefix of neighbours; 0 is the end, so bytes count from 1
    most = int((span - ahead + length - WIDTH).max())
    follow = np.zeros((n, most), dtype=np.uint8)
    before = np.zeros((n, widest), dtype=np.uint8)
    for i, r in enumerate(runs):
        v = np.frombuffer(r, dtype=np.uint8)
        p = int(phrase[i])
        before[i, widest - p :] = v[:p]
        follow[i, : len(v) - p] = v[p:]
    sizes = np.fromiter(map(len, runs), np.int64, n) - phrase
    shifted = np.where(np.arange(most) < sizes[:, None], follow.astype(np.uint16) + 1, 0).astype(">u2")
    order = np.argsort(np.ascontiguousarray(shifted).view(f"S{2 * most}").ravel(), kind="stable") if (shifted == 256).any() else np.argsort(np.ascontiguousarray(shifted.astype(np.uint8)).view(f"S{most}").ravel(), kind="stable")
    before, phrase, ahead, span = before[order], phrase[order], ahead[order], span[order]
    if unit > 1:
        before = np.unique(before.view(np.uint64), return_inverse=True)[1].reshape(n, -1)
    unequal = shifted[order[1:]] != shifted[order[:-1]]
    shared = np.where(unequal.any(axis=1), unequal.argmax(axis=1), most)
    rank = np.zeros(n, np.int64)
    for m in range(unit, widest + 1, unit):
        # rank of the phrases' suffixes of m bytes: by the first byte (or unit), then by the rank of the others
        long_enough = np.flatnonzero(phrase >= m)
        _, r = np.unique(before[long_enough, (widest - m) // unit].astype(np.int64) << 32 | rank[long_enough], return_inverse=True)
        rank[long_enough] = r
        mine = np.flatnonzero((phrase >= m) & (phrase - span <= m))
        if len(mine) < 2:
            continue
        segment = np.concatenate(([0], np.cumsum(shared < length - m)))
        _, group, count = np.unique(rank[mine] << 32 | segment[mine], return_inverse=True, return_counts=True)
        hit = mine[count[group] > 1]
        out[order[hit], (phrase[hit] - m) // unit] = True
    return out


def spans_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each stretch of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[0::2].tolist(), (edge[1::2] - 1).tolist()))


RUN = "place long, own long, x long, y long, at long"
WITH_BYTES = "place long, x long, y long, at long, single boolean, hot boolean, run binary"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], names=[n for n, _ in fields])


def coded(text: bytes, unit: int) -> bytes:
    """What is parsed: the bytes of a text, or the codes of its words."""
    return text if unit == 1 else word_codes(text)


def _runs(keyed: DataFrame, length: int, gap: int, unit: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        for b in batches:
            x, y = b.column(0).to_numpy(), b.column(1).to_numpy()
            done = 0
            for chunk in in_chunks((coded(t.as_py(), unit) for t in b.column(2)), CHUNK):
                doc, place, own, at = run_rows(chunk, length, gap, unit)
                yield pa.record_batch([pa.array(place), pa.array(own), pa.array(x[done + doc]), pa.array(y[done + doc]), pa.array(at)], names=["place", "own", "x", "y", "at"])
                done += len(chunk)

    least = length if unit == 1 else 2 * (length // unit) - 1  # a word has a byte or more, and one follows it
    return keyed.select("x", "y", "t").where(F.length("t") >= least).mapInArrow(rows, RUN)


def _bytes_of(keyed: DataFrame, wanted: DataFrame, length: int, unit: int) -> DataFrame:
    """wanted (place, x, y, at, single, hot) with the bytes of the runs; the wanted runs of a text go to it together, once however many copies it has."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        for b in batches:
            rows = []
            for x, y, text, runs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                text = coded(text.as_py(), unit)
                for r in runs.as_py():
                    lo, _, span = unpack_place(r["at"])
                    rows.append((r["place"], x, y, r["at"], r["single"], r["hot"], text[lo : lo + span + length]))
                if len(rows) > 5_000:
                    yield _batch(rows, WITH_BYTES)
                    rows = []
            if rows:
                yield _batch(rows, WITH_BYTES)

    lists = wanted.groupBy("x", "y").agg(F.collect_list(F.struct("place", "at", "single", "hot")).alias("runs"))
    return keyed.join(lists, ["x", "y"]).select("x", "y", "t", "runs").dropDuplicates(["x", "y"]).mapInArrow(read, WITH_BYTES)


def _sorted_places(runs: DataFrame, length: int, unit: int) -> DataFrame:
    """Of the runs that come together by place, the starts of single runs that are repeated: (x, y, s, e)."""
    schema = "x long, y long, s long, e long"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle()
        held: list[pa.Table] = []
        size = 0

        def flush(table: pa.Table):
            at = table.column("at").to_numpy()
            lo, ahead, span = unpack_place(at)
            flags = repeated_starts(table.column("run").to_pylist(), ahead, span, length, unit)
            x, y, single = table.column("x").to_numpy(), table.column("y").to_numpy(), table.column("single").to_pylist()
            return _batch([(x[i], y[i], lo[i] + a * unit, lo[i] + b * unit) for i in np.flatnonzero(flags.any(axis=1)).tolist() if single[i] for a, b in spans_of(flags[i])], schema)

        for b in batches:
            held.append(pa.Table.from_batches([b]))
            size += b.num_rows
            if size > SORTED:
                table = pa.concat_tables(held).combine_chunks()
                place = table.column("place").to_numpy()
                # places are not parted here; each has at most LARGE runs
                stops = np.flatnonzero(place[1:] != place[:-1]) + 1
                begin = 0
                while len(stops) and (rest := stops[stops > begin]).size:
                    stop = int(rest[max(0, int(np.searchsorted(rest, begin + SORTED, side="right")) - 1)])
                    yield flush(table.slice(begin, stop - begin))
                    begin = stop
                rest = table.slice(begin)
                held, size = [rest], rest.num_rows
        if size:
            yield flush(pa.concat_tables(held).combine_chunks())

    placed = runs.repartition("place").sortWithinPartitions("place")
    return placed.select("place", "x", "y", "at", "single", "run").mapInArrow(search, schema)


def part_run(run: bytes, at: int, length: int, cell: int, unit: int = 1) -> list[tuple[int, int, int, bytes]]:
    """A run parted by cells: (place, hash of the whole, packed place, bytes) of each part."""
    lo, ahead, span = unpack_place(at)
    far, near = ahead + WIDTH, ahead + WIDTH - span  # bytes from its first and its last start to the trigger's end
    out = []
    for c in range(near // cell, far // cell + 1):
        first, last = min(far, (c + 1) * cell - unit), max(near, c * cell)
        shared = run[far - c * cell : far + length - (c + 1) * cell + unit]
        part = run[far - first : far - last + length]
        place = xxhash.xxh3_64_intdigest(shared, c << 8 | cell)
        own = xxhash.xxh3_64_intdigest(part, first << 8 | first - last)
        out.append((place - (1 << 63), own - (1 << 63), lo + far - first << 16 | first - WIDTH << 8 | first - last, part))
    return out


def _parted(hot: DataFrame, length: int, cell: int, unit: int) -> DataFrame:
    """The parts of the runs of large places: place, own, x, y, at, n (2 for a run that is repeated already) and run."""
    schema = "place long, own long, x long, y long, at long, n long, run binary"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 500):
                cols = (c.to_pylist() for c in b.slice(k, 500).columns)
                yield _batch([(place, own, x, y, part_at, 1 if single else 2, part) for x, y, at, single, run in zip(*cols) for place, own, part_at, part in part_run(run, at, length, cell, unit)], schema)

    return hot.select("x", "y", "at", "single", "run").mapInArrow(rows, schema)


def _ends(at: str = "at") -> list[Column]:
    return [F.shiftright(at, 16).alias("s"), (F.shiftright(at, 16) + F.col(at).bitwiseAND(0xFF)).alias("e")]


def _undecided(classes: DataFrame, large: int) -> DataFrame:
    """Of classes (place, own, n, one): those at places where a single run has others beside it."""
    places = classes.groupBy("place").agg(F.count("*").alias("runs"), F.sum((F.col("n") == 1).cast("long")).alias("singles")).where("singles > 0 and runs > 1")
    places = cut(places, "passages-places")  # a join of written tables can part a skewed key
    return classes.join(places, "place").select("place", "one.*", (F.col("n") == 1).alias("single"), (F.col("runs") > large).alias("hot"))


def repeated(docs: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = LENGTH, gap: int = GAP, large: int = LARGE, unit: int = 1) -> DataFrame:
    """Rows (x, y, spans): for each text with repeated strings, the stretches of their starts, first and last.

    With unit WIDTH all this is about the codes of the words; starts that follow one another are a unit apart.

    x and y are 128 bits of hashes of a row's id (null told apart) and text. Rows that agree on both are copies
    of one another and have the same spans.
    """
    keyed = with_key(docs, text, id_col)
    runs = _runs(keyed, length, gap, unit)
    often = cut(runs.groupBy("place").count().where("count > 1").select("place"), "passages-often")  # a join of written tables can part a skewed key
    found = cut(runs.join(often, "place"), "passages-runs")
    classes = found.groupBy("place", "own").agg(F.count("*").alias("n"), F.min(F.struct("x", "y", "at")).alias("one"))
    classes = cut(classes, "passages-classes")
    spans = found.join(classes.where("n > 1").select("place", "own"), ["place", "own"]).select("x", "y", *_ends())
    with_bytes = cut(_bytes_of(keyed, _undecided(classes, large), length, unit), "passages-bytes")
    spans = spans.unionByName(_sorted_places(with_bytes.where("not hot"), length, unit))
    for cell in CELLS if unit == 1 else WORD_CELLS:
        hot = with_bytes.where("hot")
        if hot.isEmpty():
            break
        parts = cut(_parted(hot, length, cell, unit), "passages-parts")
        classes = parts.groupBy("place", "own").agg(F.sum("n").alias("n"), F.min(F.struct("x", "y", "at", "run")).alias("one"))
        again = classes.where("n > 1").select("place", "own")
        spans = spans.unionByName(parts.where("n = 1").join(again, ["place", "own"]).select("x", "y", *_ends()))
        if cell == unit:
            break  # a place holds one string only
        with_bytes = cut(_undecided(classes, large), "passages-bytes")
        spans = spans.unionByName(_sorted_places(with_bytes.where("not hot"), length, unit))
    return spans.groupBy("x", "y").agg(F.collect_set(F.struct("s", "e")).alias("spans"))


def repeated_words(docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = PASSAGE_WORDS, large: int = LARGE) -> DataFrame:
    """repeated() for sequences of so many words: rows (x, y, spans), counted in bytes of the words' codes."""
    gap = min(31, -(-3 * words // 5))  # a run's extents are stored in a byte each
    return repeated(docs, text, id_col, words * WIDTH, gap * WIDTH, large, WIDTH)


def with_key(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """x, y and t (the text as bytes, null as empty)."""
    return docs.select(*row_key(text, id_col), _bytes(text).alias("t"))


def _bytes(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def row_key(text: str, id_col: str) -> list[Column]:
    parts = [F.col(id_col), F.col(id_col).isNull(), F.coalesce(F.col(text), F.lit(""))]
    return [F.xxhash64(*parts).alias("x"), F.xxhash64(F.lit(1), *parts).alias("y")]


def stretches(spans: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """The bytes that strings cover which start from the first to the last place of a span: begin and end of each stretch."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e + length))
        else:
            out.append((s, e + length))
    return out


def remove(data: bytes, spans: list[tuple[int, int]], length: int = LENGTH, least_words: int = 0) -> tuple[bytes, int, int]:
    """The bytes that no repeated string covers, the number removed and the number of stretches removed.

    Stretches of fewer than least_words words (parted by ASCII white space, those at the ends included) stay.
    """
    kept, at, removed, n = [], 0, 0, 0
    for begin, end in stretches(spans, length):
        if least_words and len(data[begin:end].split()) < least_words:
            continue
        kept.append(data[at:begin])
        removed += end - begin
        n += 1
        at = end
    kept.append(data[at:])
    return b"".join(kept), removed, n


CUT = "n_bytes long, n_removed long, n_spans long, kept binary"


def cut_column(text: Column, spans: Column, length: int = LENGTH, least_words: int = 0) -> Column:
    """What is kept of a text (as bytes), with the numbers of bytes, bytes removed and stretches."""

    @F.pandas_udf(CUT)
    def cut_out(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        settle()
        for texts, lists in batches:
            rows = []
            for t, sp in zip(texts, lists):
                kept, removed, n = remove(t, [(x["s"], x["e"]) for x in sp] if sp is not None else [], length, least_words)
                rows.append((len(t), removed, n, kept))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    return cut_out(text, spans)


def dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", length: int = LENGTH, least_words: int = 0, **limits) -> DataFrame:
    """Rows (row, passages): all columns of docs as a struct, and n_bytes, n_removed, n_spans and kept (bytes).

    A null text is empty; texts under `length` bytes keep everything. Rows with equal ids and texts are
    documents of their own, so each repeats the other; rows with null ids are told apart by their texts. The
    columns of docs stay inside `row`, so no name clashes. An empty table gives an empty result.
    """
    spans = repeated(docs, text, id_col, length, **limits)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *row_key(text, id_col), _bytes(text).alias("t"))
    return rows.join(spans, ["x", "y"], "left").select("row", cut_column(F.col("t"), F.col("spans"), length, least_words).alias("passages"))


def digest(docs: DataFrame, length: int = LENGTH, **limits) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes kept, of each row; see dedup for odd rows."""
    got = dedup(docs.select("doc_id", "text"), length=length, **limits)
    return got.select("row.doc_id", "passages.n_bytes", "passages.n_removed", "passages.n_spans", F.sha2("passages.kept", 256).alias("kept_sha256"))


def counted_column(spans: Column, words: int = PASSAGE_WORDS) -> Column:
    """The number of stretches that repeated sequences of words cover, and of the words in them."""

    @F.pandas_udf("n_passages long, n_passage_words long")
    def count(lists: pd.Series) -> pd.DataFrame:
        rows = []
        for sp in lists:
            got = stretches([(x["s"], x["e"]) for x in sp] if sp is not None else [], words * WIDTH)
            rows.append((len(got), sum(end - begin for begin, end in got) // WIDTH))
        return pd.DataFrame(rows, columns=["n_passages", "n_passage_words"])

    return count(spans)


def digest_with_passages(docs: DataFrame, words: int = PASSAGE_WORDS, large: int = LARGE) -> DataFrame:
    """digest's columns, n_passages and n_passage_words: the stretches of words, and the words in them, that are covered
    by sequences of so many words (parted by ASCII white space) which also start anywhere else, in any document or the same one.

    Such a passage may be shorter than LENGTH bytes, so it stays in what is kept unless a longer string covers
    it. Odd rows as for dedup; a text of fewer words has no passage.
    """
    docs = docs.select("doc_id", "text")
    spans = repeated(docs, large=large)
    passages = repeated_words(docs, words=words, large=large).withColumnRenamed("spans", "sequences")
    rows = docs.select("doc_id", *row_key("text", "doc_id"), _bytes("text").alias("t"))
    got = rows.join(spans, ["x", "y"], "left").join(passages, ["x", "y"], "left")
    got = got.select("doc_id", cut_column(F.col("t"), F.col("spans")).alias("cut"), counted_column(F.col("sequences"), words).alias("found"))
    return got.select("doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256).alias("kept_sha256"), "found.*")


def without_repeats(docs: DataFrame, text: str = "text", **limits) -> DataFrame:
    """docs with repeated passages cut from the text, which stays null where it is null; a character that the cut parts goes whole.

    Other columns stay as they are, whatever their names; repeated rows each lose what they share; an empty
    table gives an empty result.
    """

    @F.pandas_udf("string")
    def decode(s: pd.Series) -> pd.Series:
        return s.map(lambda b: b.decode("utf-8", "ignore"))

    got = dedup(docs, text, **limits)
    new = F.when(F.col("passages.n_removed") > 0, decode(F.col("passages.kept"))).otherwise(F.col(f"row.`{text}`"))
    return got.select(*(new.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns))
