"""Near-duplicates by SimHash and a hierarchical index in Gray order.

A fingerprint has a bit where more than half of the text's shingle hashes have it. Two fingerprints link when
they differ in at most `radius` bits, and documents that links connect form a component.

The search never compares all with all. Equal fingerprints are one entry. The 64 bits are split into six
blocks; two that differ in at most four bits agree on at least two blocks, so each fingerprint goes to the 15
groups named by two of its blocks. A group that is still large is split the same way on its remaining bits,
until what remains is so few bits that the group is bounded by them. Within a group the fingerprints are
sorted by Gray rank, which puts those with long shared bit patterns side by side, and a tree is built over
them: each node keeps the bits on which all below it agree and their values. Pairs of nodes are compared from
the root down. The bits on which both agree within but differ from one another add up to a least difference;
a pair above the radius is dropped with all below it, and a pair whose greatest possible difference is within
the radius is joined as a whole. A group gives one link from each member to its component's least member, so
its output is linear. Components over all groups come from rounds of joins, with tables written in between.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connect
from .common import LOWER, cut, settle

SEED = 42
SHINGLE = 4
RADIUS = 4
BLOCKS, AGREE = 6, 2
LARGE_GROUP = 1 << 14
FAN = 8
CHUNK = 1 << 13

_SHIFTS = np.arange(63, -1, -1, dtype=np.uint64)


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """The SimHash of a text; 0 for a text without words."""
    parts = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    hashed = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return hashed(joined, SEED)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(sizes + 1) - 1
    start = (end - sizes)[: len(parts) - words + 1].tolist()
    stop = end[words - 1 :].tolist()
    h = np.array([hashed(joined[a:b], SEED) for a, b in zip(start, stop)], dtype=np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 15):
        bits = np.unpackbits(h[i : i + (1 << 15)].astype(">u8").view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(sum(1 << int(s) for s in _SHIFTS[counts * 2 > len(h)]))


def fingerprint_column(text: str | Column = "text", words: int = SHINGLE) -> Column:
    """The fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        settle()
        for s in batches:
            yield pd.Series(np.array([fingerprint(t, words) for t in s], dtype=np.uint64).view(np.int64))

    return of(F.col(text) if isinstance(text, str) else text)


def gray_rank(v: np.ndarray) -> np.ndarray:
    """The place of each word in the sequence of Gray codes."""
    r = v.astype(np.uint64).copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def _count(v: np.ndarray) -> np.ndarray:
    return np.bitwise_count(v).astype(np.int64)


class GrayIndex:
    """Levels of nodes over fingerprints in Gray order; a node stands for FAN nodes of the level below."""

    def __init__(self, values: np.ndarray):
        values = np.unique(values.astype(np.uint64))
        self.values = values[np.argsort(gray_rank(values), kind="stable")]
        pattern, mask = self.values, np.full(len(values), ~np.uint64(0))
        self.levels = [(pattern, mask)]
        while len(pattern) > 1:
            starts = np.arange(0, len(pattern), FAN)
            both, either = np.bitwise_and.reduceat(pattern, starts), np.bitwise_or.reduceat(pattern, starts)
            mask = np.bitwise_and.reduceat(mask, starts) & ~(both ^ either)
            pattern = both & mask
            self.levels.append((pattern, mask))

    def components(self, radius: int) -> np.ndarray:
        """For each of self.values, the least value that links within the radius connect it with.

        Pairs below which all is connected already are dropped, so a dense group costs few comparisons.
        """
        n = len(self.values)
        root = np.arange(n)

        def join(a: np.ndarray, b: np.ndarray) -> None:
            nonlocal root
            while True:
                x, y = root[a], root[b]
                apart = x != y
                if not apart.any():
                    return
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while not np.array_equal(up := root[root], root):
                    root = up

        step = np.arange(FAN)
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))] if n else []
        while stack:
            level, a, b = stack.pop()
            if len(a) > CHUNK:
                stack.append((level, a[CHUNK:], b[CHUNK:]))
                a, b = a[:CHUNK], b[:CHUNK]
            pattern, mask = self.levels[level]
            common = mask[a] & mask[b]
            least = _count((pattern[a] ^ pattern[b]) & common)
            if not level:
                near = least <= radius
                join(a[near], b[near])
                continue
            span = FAN**level
            starts = np.arange(0, n, span)
            low, high = np.minimum.reduceat(root, starts), np.maximum.reduceat(root, starts)
            open_ = (least <= radius) & ~((low[a] == high[b]) & (high[a] == low[b]))
            a, b, common, least = a[open_], b[open_], common[open_], least[open_]
            whole = least + _count(~common) <= radius
            if whole.any():
                x, y = a[whole] * span, b[whole] * span
                firsts = np.unique(np.concatenate((x, y)))
                members = (firsts[:, None] + np.arange(span)).ravel()
                heads = np.repeat(firsts, span)
                join(np.concatenate((x, heads[members < n])), np.concatenate((y, members[members < n])))
                a, b = a[~whole], b[~whole]
            below = len(self.levels[level - 1][0])
            x = np.broadcast_to(a[:, None, None] * FAN + step[None, :, None], (len(a), FAN, FAN)).ravel()
            y = np.broadcast_to(b[:, None, None] * FAN + step[None, None, :], (len(a), FAN, FAN)).ravel()
            keep = (x < below) & (y < below) & ((x < y) if level == 1 else (x <= y))
            if keep.any():
                stack.append((level - 1, x[keep], y[keep]))
        least_value = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
        np.minimum.at(least_value, root, self.values)
        return least_value[root]


def _blocks(bits: list[int], blocks: int = BLOCKS) -> list[list[int]]:
    return [[int(i) for i in b] for b in np.array_split(np.array(bits), blocks)]


def group_masks(rest: list[int], agree: int = AGREE) -> list[tuple[int, list[int]]]:
    """Masks of the groups on some bits, each with the bits that remain. Radius must be at most BLOCKS - agree."""
    out = []
    parts = _blocks(rest)
    for chosen in combinations(range(len(parts)), agree):
        mask = sum(1 << b for i in chosen for b in parts[i])
        out.append((mask, [b for i, p in enumerate(parts) if i not in chosen for b in p]))
    return out


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def _grouped(prints: DataFrame, level: int) -> DataFrame:
    """Rows (fp, used) to rows (fp, used, value), used being the mask on which the group agrees and value the bits there."""
    if level == 0:
        masks = F.array(*[F.lit(_signed(m)) for m, _ in group_masks(list(range(64)))])
        out = prints.select("fp", F.explode(masks).alias("used"))
    else:

        def deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                fps, used = b.column(0).to_numpy(), b.column(1).to_numpy()
                for u in np.unique(used):
                    mine = fps[used == u]
                    taken = int(u) & ((1 << 64) - 1)
                    for mask, _ in group_masks([i for i in range(64) if not taken >> i & 1]):
                        yield pa.record_batch([pa.array(mine), pa.array(np.full(len(mine), _signed(taken | mask)), pa.int64())], names=["fp", "used"])

        out = prints.select("fp", "used").mapInArrow(deeper, "fp long, used long")
    return out.withColumn("value", F.col("fp").bitwiseAND(F.col("used")))


def _local_links(groups: DataFrame, radius: int) -> DataFrame:
    """Of groups that fit in a task: from each member but the least, a link to the least member of its component there."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by group; a group may go on in the next batch
        held: list[np.ndarray] = []
        key = None

        def links(parts: list[np.ndarray]):
            v = np.concatenate(parts).view(np.uint64)
            if len(v) < 2:
                return None
            index = GrayIndex(v)
            least = index.components(radius)
            other = least != index.values
            if not other.any():
                return None
            return pa.record_batch([pa.array(index.values[other].view(np.int64)), pa.array(least[other].view(np.int64))], names=["a", "b"])

        for b in batches:
            fp, used, value = (b.column(i).to_numpy() for i in range(3))
            if not len(fp):
                continue
            change = np.flatnonzero((used[1:] != used[:-1]) | (value[1:] != value[:-1])) + 1
            for i, j in zip([0, *change.tolist()], [*change.tolist(), len(fp)]):
                now = (used[i], value[i])
                if now != key and held:
                    if (got := links(held)) is not None:
                        yield got
                    held = []
                key = now
                held.append(fp[i:j].copy())
        if held and (got := links(held)) is not None:
            yield got

    placed = groups.repartition("used", "value").sortWithinPartitions("used", "value")
    return placed.select("fp", "used", "value").mapInArrow(one, "a long, b long").distinct()


def links(prints: DataFrame, radius: int = RADIUS, large: int = LARGE_GROUP) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column fp) that connect the same sets as all pairs within the radius."""
    if radius > BLOCKS - AGREE:
        raise ValueError("the blocks find differences of at most 4 bits")
    found, rest = None, prints
    for level in range(3):
        grouped = _grouped(rest, level)
        last = level == 2  # 19 bits remain at most: a group has at most 2 ** 19 members
        if not last:
            counts = grouped.groupBy("used", "value").count().where("count > 1")
            sized = grouped.join(counts, ["used", "value"])
            small = sized.where(F.col("count") <= large)
            big = sized.where(F.col("count") > large).select("fp", "used")
        else:
            small, big = grouped, None
        got = _local_links(small.select("fp", "used", "value"), radius)
        found = got if found is None else found.unionByName(got)
        if big is None:
            break
        rest = cut(big.distinct(), "simhash-large")
        if rest.isEmpty():
            break
    return found.distinct()


def classes(prints: DataFrame, id_col: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """Rows (id, fp) to one row (fp, root, component_id) of each fingerprint: the least fingerprint and the least id that links connect it with."""
    named = prints.groupBy("fp").agg(F.min(id_col).alias("least_id"))
    named = cut(named, "simhash-prints")
    stars = connect(links(named.select("fp"), radius), "simhash-links")
    root = named.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("least", "fp").alias("root"), "least_id")
    owner = cut(root.groupBy("root").agg(F.min("least_id").alias("component_id")), "simhash-owners")  # a join of written tables can part a skewed key
    return root.join(owner, "root").select("fp", "root", "component_id")


def components(prints: DataFrame, id_col: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """Rows (id, fp) to rows (id, fp, component_id, root): the least id that links connect a row with, itself included, and the least fingerprint."""
    return prints.join(classes(prints, id_col, radius), "fp").select(id_col, "fp", F.coalesce("component_id", F.col(id_col)).alias("component_id"), "root")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row of docs (doc_id, text).

    A null text is empty and has fingerprint 0, which links as any other. Rows with a null doc_id get a
    component like others (null only where no connected row has an id); repeated rows stay. Other columns are
    not read; an empty table gives an empty result.
    """
    prints = cut(docs.select("doc_id", fingerprint_column(words=words).alias("fp")), "simhash")
    got = components(prints, radius=radius)
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, words: int = SHINGLE) -> DataFrame:
    """docs with one row of each component: of those with the least doc_id, by fingerprint and text.

    Rows with a null doc_id stay, as they can't be told apart. Rows that share an id are documents of their own:
    of those in one component one stays, others are kept with their own component. Of rows that agree in id and
    text one stays. Other columns stay as they are, whatever their names; an empty table gives an empty one.
    The rows that stay are found by keys alone and written; where these are few, as Spark's size check has it, no text is shuffled.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    h = [F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit(""))), F.xxhash64(F.lit(1), F.col("doc_id"), F.coalesce("text", F.lit("")))]
    prints = docs.select("doc_id", fingerprint_column(words=words).alias("fp"), h[0].alias("x"), h[1].alias("y"))
    prints = cut(prints, "simhash")
    counted = prints.where("doc_id is not null").groupBy("fp", "doc_id", "x", "y").agg(F.count("*").alias("n"))
    least = counted.groupBy("fp").agg(F.min(F.struct("doc_id", "x", "y", "n")).alias("m"))  # so the join has one row of a fingerprint
    least = least.join(classes(prints.select("doc_id", "fp"), radius=radius), "fp")
    first = least.groupBy("root").agg(F.min(F.struct("m.doc_id", "fp", "m.x", "m.y", "m.n")).alias("m"))
    first = cut(first.select("m.x", "m.y", "m.n"), "simhash-first")
    names = [F.col(f"row.`{c}`") for c in docs.columns]
    known = docs.where(F.col("doc_id").isNotNull()).select(row, h[0].alias("x"), h[1].alias("y"))
    kept = known.join(first.where("n = 1").select("x", "y"), ["x", "y"], "left_semi").select(*names)
    repeated = first.where("n > 1").select("x", "y")
    if not repeated.isEmpty():
        again = known.join(repeated, ["x", "y"], "left_semi").dropDuplicates(["x", "y"])
        kept = kept.unionByName(again.select(*names))
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
