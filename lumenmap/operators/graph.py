"""Graph operators: covisibility, components, degrees, triangles, spanning trees, and kernels for small graphs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import cut


HEAVY_POINT = 1000  # views of a point that one key joins with all of the point's


def undirected_best(edges: DataFrame, a: str = "a", b: str = "b", score: str = "score", known: DataFrame | None = None) -> DataFrame:
    """One row (a, b, score) with a < b for each pair, the greatest score; pairs with themselves and of unknown nodes go."""
    e = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.col(score).alias("score")).where("a <> b")
    if known is not None:
        name = known.columns[0]
        e = e.join(known.select(F.col(name).alias("a")).distinct(), "a", "left_semi").join(known.select(F.col(name).alias("b")).distinct(), "b", "left_semi")
    return e.groupBy("a", "b").agg(F.max("score").alias("score"))


def covisibility(tracks: DataFrame, image: str = "image_id", point: str = "point3d_id", least: int = 15, longest_track: int | None = None) -> DataFrame:
    """Pairs of images (a < b) with the number of points that both see, at least `least`.

    Each image counts once for a point; points that one image sees alone are dropped before the self-join. The
    views of a point that very many images see are dealt to several keys, each of which meets all views of the
    point, so no task makes all of its pairs. longest_track leaves out points seen by more images (an
    approximation, off by default).
    """
    seen = tracks.select(F.col(image).alias("i"), F.col(point).alias("p")).where("p is not null").distinct()
    size = seen.groupBy("p").agg(F.count("*").alias("n")).where("n > 1")
    if longest_track is not None:
        size = size.where(F.col("n") <= longest_track)
    seen = seen.join(size.select("p", F.ceil(F.col("n") / HEAVY_POINT).alias("deal")), "p")
    left = seen.withColumn("salt", F.pmod(F.xxhash64("i"), "deal"))
    right = seen.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deal") - 1)))
    pairs = left.alias("x").join(right.alias("y"), (F.col("x.p") == F.col("y.p")) & (F.col("x.salt") == F.col("y.salt")) & (F.col("x.i") < F.col("y.i")))
    return pairs.groupBy(F.col("x.i").alias("a"), F.col("y.i").alias("b")).agg(F.count("*").alias("support")).where(F.col("support") >= least)


def degrees(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """(node, degree) of every node, isolated ones too."""
    ends = edges.select(F.explode(F.array("a", "b")).alias(node))
    return nodes.select(node).distinct().join(ends.groupBy(node).agg(F.count("*").alias("degree")), node, "left").select(node, F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))


def connect(edges: DataFrame, name: str = "components") -> DataFrame:
    """Rows (node, least) for each node of the links (a, b): the least node that it is connected with.

    Large-star and small-star rounds: each node's greater neighbours are joined to its least neighbour, then
    its smaller ones. A node's neighbours are never gathered; a node with very many is a skewed join key. Each
    round is written to the shared folder, so lineage stays short.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        after = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        after = cut(after.where("a <> b").distinct(), name)
        marks = [d.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")).first() for d in (edges, after)]
        edges = after
        if marks[0] == marks[1]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("least"))


def components(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """(node, component) of every node; a component is named by its least node."""
    found = connect(edges.select("a", "b")).withColumnRenamed("node", node)
    return nodes.select(node).distinct().join(found, node, "left").select(node, F.coalesce("least", node).alias("component"))


def shared_components(seen: DataFrame, node: str = "node", point: str = "point") -> DataFrame:
    """(node, component) where nodes that share a point are linked, as by components over covisibility with least=1.

    Each node is linked to the least node of each of its points, so the links are no more than the rows.
    """
    rows = seen.select(F.col(node).alias("a"), F.col(point).alias("p"))
    heads = cut(rows.where("p is not null").groupBy("p").agg(F.min("a").alias("b")), "components-heads")
    return components(rows.select(F.col("a").alias(node)), rows.distinct().join(heads, "p").select("a", "b"), node)


def largest_component(members: DataFrame, node: str = "node") -> DataFrame:
    """The members of the component with most nodes; of equal ones that with the least name."""
    sizes = members.groupBy("component").agg(F.count("*").alias("n"))
    best = sizes.orderBy(F.desc("n"), "component").limit(1).select("component")
    return members.join(best, "component", "left_semi")


def component_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("component").agg(F.count("*").alias("size"))


def threshold_sensitivity(nodes: DataFrame, edges: DataFrame, thresholds: Iterable[int], node: str = "node", weight: str = "support") -> DataFrame:
    """For each threshold the edges, the components and the largest component's share of nodes."""
    total = nodes.select(node).distinct().agg(F.count("*").alias("nodes"))
    out = None
    for k in thresholds:
        kept = edges.where(F.col(weight) >= k)
        sizes = component_sizes(components(nodes, kept, node)).agg(F.count("*").alias("components"), F.max("size").alias("largest"))
        row = sizes.crossJoin(kept.agg(F.count("*").alias("edges"))).crossJoin(total)  # one row each
        row = row.select(F.lit(k).cast("long").alias("threshold"), "edges", "components", (F.col("largest") / F.col("nodes")).alias("largest_share"))
        out = row if out is None else out.unionByName(row)
    return out


def triangles(edges: DataFrame) -> DataFrame:
    """(a, b, c) with a < b < c of every three nodes that are all joined.

    Each edge points from the node of the lower degree (ties by name), so a wedge begins at its least node and a
    node of very many neighbours begins few.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    degree = e.select(F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.count("*").alias("d"))
    key = lambda c: degree.select(F.col("v").alias(c), F.struct("d", F.col("v").alias("v")).alias(f"_{c}"))
    o = e.join(key("a"), "a").join(key("b"), "b").select(F.least("_a", "_b").alias("lo"), F.greatest("_a", "_b").alias("hi"))
    x, y = o.alias("x"), o.alias("y")
    wedge = x.join(y, (F.col("x.lo.v") == F.col("y.lo.v")) & (F.col("x.hi") < F.col("y.hi"))).select(F.sort_array(F.array("x.lo.v", "x.hi.v", "y.hi.v")).alias("t"), F.least("x.hi.v", "y.hi.v").alias("p"), F.greatest("x.hi.v", "y.hi.v").alias("q"))
    closed = wedge.join(e.select(F.col("a").alias("p"), F.col("b").alias("q")), ["p", "q"], "left_semi")
    return closed.select(*[F.element_at("t", i + 1).alias(c) for i, c in enumerate("abc")])


def triplet_support(edges: DataFrame, weight: str = "support") -> DataFrame:
    """For each edge in a triangle: the mean over its triangles of the weakest edge's weight over the strongest's, and their number."""
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col(weight).cast("double").alias("w"))
    t = triangles(e)
    for x, y in (("a", "b"), ("b", "c"), ("a", "c")):
        t = t.join(e.select(F.col("a").alias(x), F.col("b").alias(y), F.col("w").alias(f"w_{x}{y}")), [x, y])
    ws = ["w_ab", "w_bc", "w_ac"]
    rows = t.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("c").alias("b")), F.struct("a", F.col("c").alias("b")))).alias("e"), (F.least(*ws) / F.greatest(*ws)).alias("r"))
    return rows.groupBy("e.a", "e.b").agg(F.avg("r").alias("triplet_score"), F.count("*").alias("triangles"))


def rotation_cycle_error(edges: DataFrame, rotation: str = "rotation") -> DataFrame:
    """For each edge the greatest error (degrees) over its triangles of going round: the rotations should make the identity.

    edges: a < b and the rotation from a to b as 9 numbers.
    """
    e = edges.select("a", "b", F.col(rotation).alias("r"))
    t = triangles(e)
    for x, y in (("a", "b"), ("b", "c"), ("a", "c")):
        t = t.join(e.select(F.col("a").alias(x), F.col("b").alias(y), F.col("r").alias(f"r_{x}{y}")), [x, y])
    g = lambda r, i, j: F.element_at(r, 3 * i + j + 1)
    total = None
    for i in range(3):
        for j in range(3):
            p = sum((g("r_bc", i, k) * g("r_ab", k, j) for k in range(1, 3)), g("r_bc", i, 0) * g("r_ab", 0, j))
            term = p * g("r_ac", i, j)
            total = term if total is None else total + term
    err = F.degrees(F.acos(F.least(F.greatest((total - 1) / 2, F.lit(-1.0)), F.lit(1.0))))
    rows = t.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("c").alias("b")), F.struct("a", F.col("c").alias("b")))).alias("e"), err.alias("error"))
    return rows.groupBy("e.a", "e.b").agg(F.max("error").alias("max_cycle_error_deg"))


def k_spanning_trees(edges: DataFrame, k: int = 1, a: str = "a", b: str = "b", score: str = "score") -> DataFrame:
    """The union of k maximum spanning forests, each on the edges that the ones before left: (a, b, score, tree).

    Boruvka rounds on DataFrames: each component takes its best edge (ties by the edge's names), until none is left.
    """
    rest = cut(undirected_best(edges, a, b, score), "forest-edges")
    out = None
    for tree in range(1, k + 1):
        chosen = None
        while True:
            if chosen is None:
                names = rest.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("c"))
            else:
                nodes = rest.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                names = components(nodes, chosen).withColumnRenamed("component", "c")
            e = rest.join(names.select(F.col("node").alias("a"), F.col("c").alias("ca")), "a").join(names.select(F.col("node").alias("b"), F.col("c").alias("cb")), "b").where("ca <> cb")
            best = F.struct((-F.col("score")).alias("s"), "a", "b")
            picked = e.select(F.explode(F.array("ca", "cb")).alias("c"), best.alias("x")).groupBy("c").agg(F.min("x").alias("x"))
            picked = cut(picked.select("x.a", "x.b", (-F.col("x.s")).alias("score")).distinct(), "forest-round")
            if picked.isEmpty():
                break
            chosen = picked if chosen is None else cut(chosen.unionByName(picked).distinct(), "forest")
        if chosen is None:
            break
        marked = chosen.withColumn("tree", F.lit(tree))
        out = marked if out is None else out.unionByName(marked)
        rest = cut(rest.join(chosen.select("a", "b"), ["a", "b"], "left_anti"), "forest-edges")
    return out if out is not None else rest.withColumn("tree", F.lit(0))


def knn_edges(edges: DataFrame, k: int, a: str = "a", b: str = "b", score: str = "score") -> DataFrame:
    """The undirected union of each node's k best edges, ties by the other node's name."""
    from pyspark.sql import Window

    e = undirected_best(edges, a, b, score)
    both = e.select(F.col("a").alias("node"), F.col("b").alias("other"), "score").unionByName(e.select(F.col("b").alias("node"), F.col("a").alias("other"), "score"))
    w = Window.partitionBy("node").orderBy(F.desc("score"), "other")
    top = both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), "score").distinct()


def hop_distances(edges: DataFrame, sources: DataFrame, most: int, node: str = "node") -> DataFrame:
    """(source, node, hops) for nodes within `most` hops of each source, by joins of the frontier."""
    e = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    found = sources.select(F.col(node).alias("source"), F.col(node), F.lit(0).alias("hops")).distinct()
    frontier = found
    for hop in range(1, most + 1):
        step = frontier.join(e, frontier[node] == e["a"]).select("source", F.col("b").alias(node), F.lit(hop).alias("hops")).distinct()
        frontier = cut(step.join(found, ["source", node], "left_anti"), "hops-frontier")
        if frontier.isEmpty():
            break
        found = cut(found.unionByName(frontier), "hops")
    return found


def radius_components(points: DataFrame, id_col: str, xyz: Sequence[str], radius: float) -> DataFrame:
    """(id, component) where points within the radius of one another are linked."""
    from .spatial import radius_pairs

    pairs = radius_pairs(points, points, id_col, id_col, xyz, radius).where("left_id < right_id")
    return components(points.select(F.col(id_col).alias("node")), pairs.select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))).withColumnRenamed("node", id_col)


# kernels for graphs of bounded size, one group at a time


def cuts(near: list[list[int]]) -> tuple[set[int], list[tuple[int, int]]]:
    """Articulation nodes and bridges of a graph that is given as each node's neighbours, by depth-first search."""
    n = len(near)
    order, low, parent, cut_nodes, bridges, clock = [-1] * n, [0] * n, [-1] * n, set(), [], 0
    for root in range(n):
        if order[root] >= 0:
            continue
        stack = [(root, iter(near[root]))]
        order[root] = low[root] = clock
        clock += 1
        below_root = 0
        while stack:
            v, rest = stack[-1]
            for u in rest:
                if order[u] < 0:
                    parent[u] = v
                    below_root += v == root
                    order[u] = low[u] = clock
                    clock += 1
                    stack.append((u, iter(near[u])))
                    break
                if u != parent[v]:
                    low[v] = min(low[v], order[u])
            else:
                stack.pop()
                if stack:
                    p = stack[-1][0]
                    low[p] = min(low[p], low[v])
                    if low[v] > order[p]:
                        bridges.append((p, v))
                    if p != root and low[v] >= order[p]:
                        cut_nodes.add(p)
        if below_root > 1:
            cut_nodes.add(root)
    return cut_nodes, bridges


def small_graph_report(pairs: list[tuple[int, int, float]]) -> dict:
    """Bridges, articulation nodes, algebraic connectivity and its normalised form, for one connected graph."""
    nodes = sorted({n for a, b, _ in pairs for n in (a, b)})
    place = {n: i for i, n in enumerate(nodes)}
    n = len(nodes)
    near: list[list[int]] = [[] for _ in range(n)]
    weight = np.zeros((n, n))
    for a, b, w in pairs:
        i, j = place[a], place[b]
        near[i].append(j)
        near[j].append(i)
        weight[i, j] = weight[j, i] = w
    cut_nodes, bridges = cuts(near)
    degree = weight.sum(1)
    laplacian = np.diag(degree) - weight
    scale = 1 / np.sqrt(np.maximum(degree, 1e-300))
    plain, normal = np.linalg.eigvalsh(laplacian), np.linalg.eigvalsh(laplacian * scale[:, None] * scale[None, :])
    return {"nodes": n, "edges": len(pairs), "bridges": sorted(tuple(sorted((nodes[p], nodes[v]))) for p, v in bridges), "articulation": sorted(nodes[i] for i in cut_nodes), "fiedler": float(plain[1]) if n > 1 else 0.0, "lambda2": float(normal[1]) if n > 1 else 0.0}


FRAGILITY = "component long, nodes long, edges long, bridges string, articulation string, fiedler double, lambda2 double"


def fragility(nodes: DataFrame, edges: DataFrame, most: int = 20_000, node: str = "node", weight: str = "support") -> DataFrame:
    """A report for each component with an edge. A component is one task's group; one of over `most` nodes is an error, not cut down."""
    members = components(nodes, edges, node)
    e = edges.join(members.select(F.col(node).alias("a"), "component"), "a").select("component", "a", "b", F.col(weight).cast("double").alias("w"))
    size = e.groupBy("component").agg(F.approx_count_distinct("a").alias("size"))
    e = e.join(size, "component").withColumn("w", F.when(F.col("size") > most * 1.2, F.raise_error(F.lit(f"a component has over {most} nodes")).cast("double")).otherwise(F.col("w"))).drop("size")

    def report(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        got = small_graph_report(list(zip(group["a"], group["b"], group["w"])))
        names = [str([list(x) if isinstance(x, tuple) else x for x in got[k]]).replace(" ", "") for k in ("bridges", "articulation")]
        return pd.DataFrame([(key[0], got["nodes"], got["edges"], *names, got["fiedler"], got["lambda2"])], columns=[c.split()[0] for c in FRAGILITY.split(", ")])

    return e.groupBy("component").applyInPandas(report, FRAGILITY)


SETS = 1 << 28  # different sets of points, times points, that one component may have


def _second(c: np.ndarray, share: np.ndarray, member: np.ndarray, many: np.ndarray, bound: float) -> float:
    """The second least eigenvalue of diag(c) - B B' for rows sqrt(share) * member of B, each `many` times; it is at most bound.

    By Sylvester's law the eigenvalues below x are as many as the c below x and the negative eigenvalues of
    I - B' (diag(c) - x)^-1 B, a matrix by points; x is found by halving.
    """
    low, high = 0.0, bound * (1 + 1e-9)
    eye = np.eye(member.shape[1])
    while high - low > 1e-14 * bound:
        x = (low + high) / 2
        if x in (low, high):
            break
        gap = np.where(c == x, 1e-300 ** 0.5, c - x)
        m = eye.copy()
        for i in range(0, len(c), 65536):
            part = member[i : i + 65536].astype(np.float64)
            m -= part.T @ (part * (share * many / gap)[i : i + 65536, None])
        if many[c < x].sum() + (np.linalg.eigvalsh(m) < 0).sum() >= 2:
            high = x
        else:
            low = x
    return (low + high) / 2


def shared_graph_report(sets: list[Sequence[int]], many: Sequence[int], first: Sequence, last: Sequence, dense: int = 300) -> dict:
    """small_graph_report of a connected graph whose nodes are linked by each point that they share, without making its pairs.

    sets: the points of nodes, each set once, with the number of nodes that have it and the first and last of
    them. Graphs of up to `dense` nodes go to small_graph_report where every node is named.
    """
    places = {p: j for j, p in enumerate(sorted({p for s in sets for p in s}))}
    if len(sets) * len(places) > SETS:
        raise ValueError(f"a component has {len(sets)} sets of {len(places)} points")
    member = np.zeros((len(sets), len(places)), bool)
    for i, s in enumerate(sets):
        member[i, [places[p] for p in s]] = True
    many = np.array(many, np.int64)
    n = int(many.sum())
    if n <= dense and many.max() <= 2:
        named = [(name, i) for i in range(len(sets)) for name in ((first[i], last[i]) if many[i] > 1 else (first[i],))]
        pairs = [(a, b, float((member[i] & member[j]).sum())) for x, (a, i) in enumerate(named) for b, j in named[x + 1 :] if (member[i] & member[j]).any()]
        return small_graph_report(pairs)
    size = many @ member
    # pairs with a point in common, each twice, and each node with itself
    bits = np.zeros((len(sets), -(-len(places) // 64) * 8), np.uint8)
    packed = np.packbits(member, axis=1)
    bits[:, : packed.shape[1]] = packed
    words, total = bits.view(np.uint64), 0
    for i in range(0, len(sets), 128):
        met = np.zeros((len(words[i : i + 128]), len(sets)), bool)
        for w in range(words.shape[1]):
            met |= (words[i : i + 128, w, None] & words[None, :, w]) != 0
        total += int(many[i : i + 128] @ (met @ many))
    # points and nodes as one graph: two nodes stand for all that have the same points
    named = [(name, i) for i in range(len(sets)) for name in ((first[i], last[i]) if many[i] > 1 else (first[i],))]
    near: list[list[int]] = [[] for _ in named]
    of_point: list[list[int]] = [[] for _ in places]
    for x, (_, i) in enumerate(named):
        for j in np.nonzero(member[i])[0].tolist():
            of_point[j].append(x)
    seen, couples = set(), {}
    for j, nodes in enumerate(of_point):
        if size[j] < 2:
            continue  # a point of one node links nothing
        if size[j] == 2:
            if tuple(nodes) in seen:
                continue  # two nodes that share several points of their own have one edge
            seen.add(tuple(nodes))
            couples[len(near)] = nodes
        for x in nodes:
            near[x].append(len(near))
        near.append(nodes)
    cut_places, _ = cuts(near)
    bridges = sorted(tuple(sorted(named[x][0] for x in couples[p])) for p in cut_places if p in couples)
    c = member @ size.astype(np.float64)
    degree = c - member.sum(1)
    most = n / (n - 1)
    fiedler = _second(c, np.ones(len(c)), member, many, most * degree.min())
    return {"nodes": n, "edges": (total - n) // 2, "bridges": bridges, "articulation": sorted(named[x][0] for x in cut_places if x < len(named)), "fiedler": fiedler, "lambda2": _second(c / degree, 1 / degree, member, many, most)}


def shared_fragility(seen: DataFrame, node: str = "node", point: str = "point") -> DataFrame:
    """fragility over covisibility(seen, least=1), without its pairs: a component's different sets of points are one task's group."""
    rows = seen.select(F.col(node).alias("node"), F.col(point).alias("p")).where("node is not null and p is not null").distinct()
    points = cut(rows.groupBy("p").agg(F.count("*").alias("n")).where("n > 1").select("p", F.monotonically_increasing_id().alias("k")), "fragility-points")
    sets = rows.join(points, "p").groupBy("node").agg(F.sort_array(F.collect_list("k")).alias("points"))
    sets = sets.groupBy("points").agg(F.count("*").alias("many"), F.min("node").alias("first"), F.max("node").alias("last"))
    groups = sets.join(shared_components(rows, "node", "p").withColumnRenamed("node", "first"), "first")

    def report(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        got = shared_graph_report(*[group[c].tolist() for c in ("points", "many", "first", "last")])
        names = [str([list(x) if isinstance(x, tuple) else x for x in got[k]]).replace(" ", "") for k in ("bridges", "articulation")]
        return pd.DataFrame([(key[0], got["nodes"], got["edges"], *names, got["fiedler"], got["lambda2"])], columns=[c.split()[0] for c in FRAGILITY.split(", ")])

    return groups.groupBy("component").applyInPandas(report, FRAGILITY)
