"""Session graphs made robust: communities, spanning windows of least range, cycles, bridges' paths, portfolios, frame plans.

All work on graphs of sessions or bridges: tens to a few thousands of edges, one group at a time.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Edge = tuple[str, str, float]


def eligible() -> Column:
    """Why an edge may not be used: the first rule that fails, else null. Missing evidence fails."""
    flag = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    return (
        F.when(~F.coalesce(F.col("status").isin("USABLE", "STRONG"), F.lit(False)), "status")
        .when(F.coalesce("num_verified_pairs", F.lit(0)) <= 0, "no_verified_pairs")
        .when(F.coalesce("independent_bridge_groups", F.lit(0)) <= 0, "no_bridge_group")
        .when(flag("independent_artifact"), "not_independent")
        .when(flag("geometry_complete"), "geometry_incomplete")
        .when(flag("group_holdout_disjoint"), "holdout_overlaps")
    )


def _near(edges: Iterable[Edge]) -> dict[str, dict[str, float]]:
    near: dict[str, dict[str, float]] = defaultdict(dict)
    for a, b, w in edges:
        if a != b:
            near[a][b] = near[b][a] = max(w, near[a].get(b, 0.0))
    return near


def communities(edges: Sequence[Edge], resolution: float = 1.0, rounds: int = 50) -> dict[str, int]:
    """Groups of nodes by modularity: each node in turn joins the neighbours' group that gains most, then groups are merged and it goes on.

    Nodes go in the order of their names and ties to the least group, so the result is the same every time.
    """
    near = _near(edges)
    names = sorted(near)
    member = {n: i for i, n in enumerate(names)}
    graph = {i: {member[b]: w for b, w in near[a].items()} for a, i in member.items()}
    loops = dict.fromkeys(graph, 0.0)
    total = sum(sum(v.values()) for v in graph.values()) / 2
    if total <= 0:
        return member
    while True:
        group = {n: n for n in graph}
        degree = {n: sum(v.values()) + 2 * loops[n] for n, v in graph.items()}
        weight = dict(degree)
        moved_any = False
        for _ in range(rounds):
            moved = False
            for n in sorted(graph):
                own = group[n]
                weight[own] -= degree[n]
                gain: dict[int, float] = defaultdict(float)
                gain[own] += 0.0
                for o, w in graph[n].items():
                    gain[group[o]] += w
                best = min(gain, key=lambda g: (-(gain[g] - resolution * weight[g] * degree[n] / (2 * total)), g != own, g))
                weight[best] += degree[n]
                if best != own:
                    group[n] = best
                    moved = moved_any = True
            if not moved:
                break
        if not moved_any:
            break
        renumber = {g: i for i, g in enumerate(sorted(set(group.values())))}
        member = {name: renumber[group[i]] for name, i in member.items()}
        new: dict[int, dict[int, float]] = {i: defaultdict(float) for i in renumber.values()}
        new_loops = dict.fromkeys(renumber.values(), 0.0)
        for n, v in graph.items():
            g = renumber[group[n]]
            new_loops[g] += loops[n]
            for o, w in v.items():
                h = renumber[group[o]]
                if h == g:
                    new_loops[g] += w / 2
                else:
                    new[g][h] += w
        graph, loops = {k: dict(v) for k, v in new.items()}, new_loops
    order = {}
    return {n: order.setdefault(member[n], len(order)) for n in names}


def spanning_window(edges: Sequence[Edge]) -> list[Edge]:
    """The spanning tree whose weights lie in the narrowest range: edges by weight enter one by one, each closing cycle loses its least edge."""
    nodes = {n for a, b, _ in edges for n in (a, b)}
    tree: list[Edge] = []
    best: tuple[float, list[Edge]] | None = None
    for e in sorted(edges, key=lambda x: (x[2], x[0], x[1])):
        path = _path(tree, e[0], e[1])
        if path is not None:
            tree.remove(min(path, key=lambda x: (x[2], x[0], x[1])))
        tree.append(e)
        if len(tree) == len(nodes) - 1:
            spread = e[2] - min(t[2] for t in tree)
            if best is None or spread < best[0]:
                best = (spread, list(tree))
    return best[1] if best else []


def _path(tree: Sequence[Edge], start: str, goal: str) -> list[Edge] | None:
    near: dict[str, list[Edge]] = defaultdict(list)
    for e in tree:
        near[e[0]].append(e)
        near[e[1]].append(e)
    stack, seen = [(start, [])], {start}
    while stack:
        n, path = stack.pop()
        if n == goal:
            return path
        for e in near[n]:
            o = e[1] if e[0] == n else e[0]
            if o not in seen:
                seen.add(o)
                stack.append((o, [*path, e]))
    return None


def close_cycles(tree: Sequence[Edge], candidates: Sequence[Edge], most: int = 64) -> list[Edge]:
    """Candidates, best first, that put a bridge of the graph on a cycle, until there is no bridge left or none helps."""
    graph, out = list(tree), []
    have = {tuple(sorted(e[:2])) for e in graph}
    for e in sorted(candidates, key=lambda x: (-x[2], x[0], x[1])):
        if len(out) >= most:
            break
        if tuple(sorted(e[:2])) in have:
            continue
        path = _path(graph, e[0], e[1])
        if path and any(_path([x for x in graph if x is not p], p[0], p[1]) is None for p in path):
            graph.append(e)
            out.append(e)
            have.add(tuple(sorted(e[:2])))
    return out


def harden(edges: DataFrame, score: str = "reliability", by: Sequence[str] = ()) -> DataFrame:
    """Edges of each group of sessions with the use that hardening gives them: backbone, cycle, or none.

    edges: session_a, session_b, a score; one group is one task's.
    """
    keep = [*by, "session_a", "session_b", score]
    kinds = dict(edges.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in keep) + ", use string, community_a int, community_b int"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        e = [(str(a), str(b), float(w)) for a, b, w in zip(rows["session_a"], rows["session_b"], rows[score])]
        tree = _forest(e)
        extra = close_cycles(tree, e)
        use = {tuple(sorted(x[:2])): "backbone" for x in tree} | {tuple(sorted(x[:2])): "cycle" for x in extra}
        group = communities(e)
        return rows[keep].assign(use=[use.get(tuple(sorted((a, b))), "none") for a, b, _ in e], community_a=np.array([group[a] for a, _, _ in e], np.int32), community_b=np.array([group[b] for _, b, _ in e], np.int32))

    src = edges if by else edges.withColumn("_all", F.lit("x"))
    return src.groupBy(*(by or ["_all"])).applyInPandas(run, schema)


def _forest(edges: Sequence[Edge]) -> list[Edge]:
    parent: dict[str, str] = {}

    def find(x: str) -> str:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    out = []
    for e in sorted(edges, key=lambda x: (-x[2], x[0], x[1])):
        a, b = find(e[0]), find(e[1])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append(e)
    return out


# bridges


def best_path(edges: Sequence[Edge], start: str, anchors: set[str], most_hops: int = 4) -> tuple[float, list[str]] | None:
    """The path to an anchor with the greatest product of edge weights, of at most so many hops; ties by names."""
    near = _near(edges)
    heap: list[tuple[float, list[str]]] = [(0.0, [start])]
    best: dict[tuple[str, int], float] = {}
    while heap:
        cost, path = heapq.heappop(heap)
        n, hops = path[-1], len(path) - 1
        if n in anchors:
            return math.exp(-cost), path
        if hops == most_hops or best.get((n, hops), math.inf) < cost:
            continue
        for o in sorted(near[n]):
            w = near[n][o]
            if w > 0 and o not in path:
                c = cost - math.log(min(w, 1.0))
                if c < best.get((o, hops + 1), math.inf):
                    best[o, hops + 1] = c
                    heapq.heappush(heap, (c, [*path, o]))
    return None


def disjoint_paths(edges: Sequence[Edge], start: str, anchors: set[str]) -> int:
    """How many paths from a node to the anchors share no edge: unit flow by augmenting paths."""
    near = _near(edges)
    flow: dict[tuple[str, str], int] = defaultdict(int)
    count = 0
    while True:
        back: dict[str, str] = {start: start}
        queue, end = [start], None
        for n in queue:
            if n in anchors and n != start:
                end = n
                break
            for o in sorted(near[n]):
                if o not in back and flow[n, o] < 1:
                    back[o] = n
                    queue.append(o)
        if end is None:
            return count
        while end != start:
            flow[back[end], end] += 1
            flow[end, back[end]] -= 1
            end = back[end]
        count += 1


def valid_bridges(edges: DataFrame, *, inliers: float = 30, ratio: float = 0.3, area: float = 0.05, angle_deg: float = 30, residual_px: float = 4) -> DataFrame:
    ok = (F.col("inliers") >= inliers) & (F.col("inlier_ratio") >= ratio) & (F.col("support_area") >= area) & (F.col("angle_deg") <= angle_deg) & (F.col("residual_px") <= residual_px)
    return edges.where(F.coalesce(ok, F.lit(False)))


# portfolios and plans


def portfolio(sessions: Sequence[dict], links: dict[tuple[str, str], float], budget: float, stop: float = 0.05) -> list[tuple[str, float]]:
    """Sessions by marginal value over cost until the budget is spent or the gain falls below a share of the first one.

    Value: new cells, own quality, and the strongest link to what is chosen.
    """
    chosen: list[tuple[str, float]] = []
    seen: set = set()
    left, rest, first = budget, list(sessions), None
    while rest:
        scored = []
        for s in rest:
            if s["cost"] > left:
                continue
            link = max((links.get(tuple(sorted((s["session"], c))), 0.0) for c, _ in chosen), default=0.0)
            scored.append((-(len(set(s["cells"]) - seen) + s["quality"] + (link if chosen else 0.0)) / max(s["cost"], 1e-9), s["session"], s))
        if not scored:
            break
        gain, name, s = min(scored, key=lambda x: x[:2])
        first = -gain if first is None else first
        if -gain < stop * first:
            break
        chosen.append((name, -gain))
        seen |= set(s["cells"])
        left -= s["cost"]
        rest.remove(s)
    return chosen


#: Frames a second to take of each class of motion.
FRAME_RATES = {"PARALLAX": 2.0, "LOW_PARALLAX": 1.0, "HOVER": 0.2, "PURE_ROTATION": 0.5, "FAST_BLUR": 1.0, "WEAK_GEOMETRY": 1.0, "UNKNOWN": 1.0}


def plan_frames(times: Sequence[float], classes: Sequence[str], rates: dict[str, float] = FRAME_RATES) -> list[int]:
    """Indices of frames to take: the next one is due when the rate of the class at hand has gone by since the last."""
    out: list[int] = []
    last = -math.inf
    for i, (t, c) in enumerate(zip(times, classes)):
        rate = rates.get(c, 0.0)
        if rate > 0 and t - last >= 1 / rate - 1e-9:
            out.append(i)
            last = t
    return out


def frame_plan(frames: DataFrame, sequence: str, t: str, motion: str, rates: dict[str, float] = FRAME_RATES) -> DataFrame:
    """The frames of each sequence that plan_frames takes."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(t, kind="stable").reset_index(drop=True)
        return rows.iloc[plan_frames(rows[t].tolist(), rows[motion].tolist(), rates)]

    return frames.groupBy(sequence).applyInPandas(run, frames.schema)


def cap_class(flags: Sequence[bool], share: float) -> list[int]:
    """Indices kept so that flagged ones are at most a share of what is left; an even pick of them stays."""
    flagged = [i for i, f in enumerate(flags) if f]
    others = [i for i, f in enumerate(flags) if not f]
    most = len(flagged) if share >= 1 else min(len(flagged), int(math.floor(share * len(others) / (1 - share) + 1e-9)))
    pick = {flagged[int(round(k * (len(flagged) - 1) / max(most - 1, 1)))] for k in range(most)} if most else set()
    return sorted(set(others) | pick)
