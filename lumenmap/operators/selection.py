"""Selections whose result depends on order: greedy caps, matchings, covers, portfolios.

A greedy rule sees its rows one by one, so each runs within one group (a pair, an image, a session set). The
group's size is checked where it is not bounded by its meaning; nothing is cut off silently.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_group(df: DataFrame, by: Sequence[str], keep: Callable[[pd.DataFrame], Sequence[int]]) -> DataFrame:
    """The rows of each group that a rule keeps."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.reset_index(drop=True)
        return rows.iloc[list(keep(rows))]

    return df.groupBy(*by).applyInPandas(run, df.schema)


def degree_cap(pairs: DataFrame, by: Sequence[str], a: str, b: str, order: Sequence[str], total: int, cross: str | None = None, cross_cap: int | None = None) -> DataFrame:
    """Pairs taken in order while both ends are below their caps; `cross` marks pairs that have a cap of their own."""

    def keep(rows: pd.DataFrame) -> list[int]:
        n: dict = defaultdict(int)
        m: dict = defaultdict(int)
        out = []
        rows = rows.sort_values(list(order), kind="stable")
        for i, x, y, c in zip(rows.index, rows[a], rows[b], rows[cross] if cross else [False] * len(rows)):
            if n[x] >= total or n[y] >= total or (c and cross_cap is not None and (m[x] >= cross_cap or m[y] >= cross_cap)):
                continue
            out.append(i)
            for z in (x, y):
                n[z] += 1
                m[z] += bool(c)
        return out

    return _per_group(pairs, by, keep)


def unique_matches(matches: DataFrame, by: Sequence[str], left: str, right: str, score: str) -> DataFrame:
    """One-to-one matches of each pair, best score first; ties by left, then right."""

    def keep(rows: pd.DataFrame) -> list[int]:
        a, b, out = set(), set(), []
        rows = rows.sort_values([score, left, right], ascending=[False, True, True], kind="stable")
        for i, x, y in zip(rows.index, rows[left], rows[right]):
            if x not in a and y not in b:
                a.add(x)
                b.add(y)
                out.append(i)
        return out

    return _per_group(matches, by, keep)


def prune_redundant(candidates: DataFrame, by: Sequence[str], order: Sequence[str], redundant: Callable[[dict, dict], bool]) -> DataFrame:
    """Candidates in order that are redundant to none kept before."""

    def keep(rows: pd.DataFrame) -> list[int]:
        out: list[int] = []
        taken: list[dict] = []
        for i, r in rows.sort_values(list(order), kind="stable").iterrows():
            d = r.to_dict()
            if not any(redundant(d, t) for t in taken):
                out.append(i)
                taken.append(d)
        return out

    return _per_group(candidates, by, keep)


def keyframes(frames: DataFrame, session: str, order: str, digest: str, gap: int, least_bits: int) -> DataFrame:
    """Frames of each session that are far enough in number and in bits from the last one kept."""

    def keep(rows: pd.DataFrame) -> list[int]:
        out, last = [], None
        for i, o, h in zip((r := rows.sort_values(order, kind="stable")).index, r[order], r[digest]):
            if last is None or (o - last[0] >= gap and (int(h) ^ int(last[1])) % (1 << 64) and bin((int(h) ^ int(last[1])) % (1 << 64)).count("1") >= least_bits):
                out.append(i)
                last = (o, h)
        return out

    return _per_group(frames, [session], keep)


def farthest_first(vectors: np.ndarray, order: Sequence[int] | None = None) -> list[int]:
    """Indices by falling distance to those before; the first is that farthest from the mean, ties to the lesser index."""
    if not len(vectors):
        return []
    first = int(np.linalg.norm(vectors - vectors.mean(0), axis=1).argmax())
    out, d = [first], np.linalg.norm(vectors - vectors[first], axis=1)
    while len(out) < len(vectors):
        d[out] = -1
        i = int(d.argmax())
        out.append(i)
        d = np.minimum(d, np.linalg.norm(vectors - vectors[i], axis=1))
    return out


RANKED = "rank int, uniqueness double"


def rank_by_uniqueness(candidates: DataFrame, by: Sequence[str], id_col: str, vector: str) -> DataFrame:
    """(by, id, rank, uniqueness) in farthest-first order; uniqueness is the distance to those before, 1 for the first."""
    kinds = dict(candidates.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*by, id_col]) + ", " + RANKED

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(id_col).reset_index(drop=True)
        v = np.array([np.asarray(x, float) for x in rows[vector]])
        order = farthest_first(v)
        u = [1.0 if k == 0 else float(np.linalg.norm(v[order[:k]] - v[i], axis=1).min()) for k, i in enumerate(order)]
        out = rows.iloc[order][[*by, id_col]].reset_index(drop=True)
        return out.assign(rank=np.arange(1, len(order) + 1, dtype=np.int32), uniqueness=u)

    return candidates.select(*by, id_col, vector).groupBy(*by).applyInPandas(run, schema)


def cover(candidates: DataFrame, by: Sequence[str], id_col: str, cells: str, utility: str, cost: str, budget: float, times: int = 2) -> DataFrame:
    """Candidates of each group chosen by gain over cost until the budget is spent: gain counts cells that are not yet covered `times`, and utility."""
    kinds = dict(candidates.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*by, id_col]) + ", pick int, gain double"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(id_col).reset_index(drop=True)
        left, need = budget, defaultdict(lambda: times)
        chosen, rest = [], list(rows.index)
        while rest:
            best = None
            for i in rest:
                if rows.at[i, cost] > left:
                    continue
                g = (sum(need[c] > 0 for c in rows.at[i, cells]) + float(rows.at[i, utility])) / max(float(rows.at[i, cost]), 1e-9)
                if best is None or g > best[0] + 1e-12:
                    best = (g, i)
            if best is None or best[0] <= 0:
                break
            i = best[1]
            chosen.append((i, best[0]))
            rest.remove(i)
            left -= float(rows.at[i, cost])
            for c in rows.at[i, cells]:
                need[c] = max(0, need[c] - 1)
        out = rows.iloc[[i for i, _ in chosen]][[*by, id_col]].reset_index(drop=True)
        return out.assign(pick=np.arange(1, len(chosen) + 1, dtype=np.int32), gain=[g for _, g in chosen])

    return candidates.select(*by, id_col, cells, utility, cost).groupBy(*by).applyInPandas(run, schema)


def bridge_counts(groups: DataFrame, weight: str, total: int, order: str) -> DataFrame:
    """Whole numbers that add up to `total`, in proportion to the weights, at least one each; largest remainders, ties by order.

    groups is small (one row for each pair of sequences); an error if there are more groups than the total.
    """
    from pyspark.sql import Window

    t = groups.agg(F.sum(weight).alias("_w"), F.count("*").alias("_n"))
    g = groups.crossJoin(F.broadcast(t))  # one row
    g = g.withColumn("_n", F.when(F.col("_n") > total, F.raise_error(F.lit("more groups than the total")).cast("long")).otherwise(F.col("_n")))
    share = F.col(weight) / F.col("_w") * (F.lit(total) - F.col("_n"))
    g = g.withColumn("_base", F.floor(share)).withColumn("_rest", share - F.floor(share))
    s = g.agg(F.sum("_base").alias("_sum"))
    g = g.crossJoin(F.broadcast(s)).withColumn("_rank", F.row_number().over(Window.orderBy(F.desc("_rest"), order)))  # one row; few groups
    return g.withColumn("count", (1 + F.col("_base") + F.when(F.col("_rank") <= F.lit(total) - F.col("_n") - F.col("_sum"), 1).otherwise(0)).cast("long")).drop("_w", "_n", "_base", "_rest", "_sum", "_rank")


def greedy_core(sessions: list[dict], edges: list[dict], budget: int, least_gain: float = 0.02) -> list[tuple[str, float]]:
    """Sessions from the best seed on, each time that with the largest gain that an admissible edge joins to the core.

    For tens of sessions, on the driver. An edge is admissible when STRONG, or USABLE and verified.
    """
    quality = {s["session"]: float(s["quality"]) for s in sessions}
    near: dict[str, list[tuple[str, float]]] = defaultdict(list)
    for e in edges:
        if e["status"] == "STRONG" or (e["status"] == "USABLE" and e.get("num_verified_pairs", 0) > 0):
            near[e["a"]].append((e["b"], float(e["score"])))
            near[e["b"]].append((e["a"], float(e["score"])))
    linked = [s for s in quality if near[s]]
    if not linked:
        return []
    seed = min(linked, key=lambda s: (-quality[s], s))
    core = [(seed, quality[seed])]
    while len(core) < budget:
        inside = {s for s, _ in core}
        options = []
        for s in quality:
            links = [w for o, w in near[s] if o in inside]
            if s not in inside and links:
                options.append((-(quality[s] * max(links) / (1 + 0.1 * len(inside))), s))
        if not options or -min(options)[0] < least_gain:
            break
        gain, s = min(options)
        core.append((s, -gain))
    return core
