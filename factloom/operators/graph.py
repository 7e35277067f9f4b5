"""Graph operators as rounds of joins; lineage is cut by reliable checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import written as _cut


def _vertices(edges: DataFrame, vertices: DataFrame | None) -> DataFrame:
    every = edges.select(F.col("src").alias("v")).union(edges.select("dst"))
    return (every if vertices is None else every.union(vertices.select("v"))).distinct()


def levels(edges: DataFrame, vertices: DataFrame | None = None, deepest_first: bool = True) -> DataFrame:
    """Kahn levels (I1, I2, W7, L4): (v, level) of edges (src, dst).

    A vertex follows all its predecessors.  Cycles and what lies behind them form one more level.  The
    order is reversed by default, so the remainder comes first, then the deepest vertices.  Each round
    is one join of the frontier with its edges; in-degrees are only kept for vertices not yet placed.
    """
    edges = _cut(edges.select("src", "dst").distinct())
    degree = edges.groupBy(F.col("dst").alias("v")).agg(F.count("*").alias("d"))
    open_ = _cut(_vertices(edges, vertices).join(degree, "v", "left").select("v", F.coalesce("d", F.lit(0)).cast("long").alias("d")))
    done, level = None, 0
    while True:
        front = open_.where("d <= 0").select("v", F.lit(level).alias("level"))
        if front.isEmpty():
            break
        done = front if done is None else done.union(front)
        if level % 32 == 31:  # so many branches at most, however deep the graph
            done = _cut(done)
        less = front.join(edges, F.col("v") == F.col("src")).groupBy(F.col("dst").alias("v")).agg(F.count("*").alias("gone"))
        open_ = _cut(open_.where("d > 0").join(less, "v", "left").select("v", (F.col("d") - F.coalesce("gone", F.lit(0))).alias("d")))
        level += 1
    rest = open_.select("v", F.lit(level).alias("level"))
    out = rest if done is None else done.union(rest)
    top = level if not open_.isEmpty() else level - 1
    return out.select("v", (F.lit(top) - F.col("level")).alias("level")) if deepest_first else out


def reachable(edges: DataFrame, start: DataFrame) -> DataFrame:
    """Breadth-first reachability (I6): (v, depth), the start included."""
    edges = _cut(edges.select("src", "dst").distinct())
    seen = front = _cut(start.select("v").distinct().withColumn("depth", F.lit(0)))
    depth = 0
    while True:
        depth += 1
        front = front.join(edges, F.col("v") == F.col("src")).select(F.col("dst").alias("v")).distinct()
        front = _cut(front.join(seen, "v", "left_anti").withColumn("depth", F.lit(depth)))
        if front.isEmpty():
            return seen
        seen = seen.union(front)
        if depth % 32 == 0:
            seen = _cut(seen)


def closure(edges: DataFrame) -> DataFrame:
    """Distinct (src, dst) pairs joined by a path of one edge or more; cycles are followed once.

    Paths double in length each round, so their number is the logarithm of the longest path.
    """
    known = _cut(edges.select("src", "dst").distinct())
    count = known.count()
    while True:
        longer = known.select("src", F.col("dst").alias("_m")).join(known.select(F.col("src").alias("_m"), "dst"), "_m").select("src", "dst")
        known = _cut(known.union(longer).distinct())
        before, count = count, known.count()
        if count == before:
            return known


def components(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """(v, component): the smallest vertex of each undirected component (I3 without a cap).

    Labels are taken from neighbours and from the label's own label, which halves the distance left.
    """
    both = _cut(edges.select("src", "dst").union(edges.select("dst", "src")).distinct())
    label = _cut(_vertices(edges, vertices).withColumn("component", F.col("v")))
    while True:
        near = both.join(label, F.col("src") == F.col("v")).groupBy(F.col("dst").alias("v")).agg(F.min("component").alias("m"))
        better = label.join(near, "v", "left").select("v", F.col("component").alias("was"), F.least("component", "m").alias("component"))
        jump = better.select(F.col("v").alias("j"), F.col("component").alias("far"))
        better = _cut(better.join(jump, F.col("component") == F.col("j"), "left").select("v", "was", F.least("component", "far").alias("component")))
        label = better.select("v", "component")
        if better.where("component <> was").isEmpty():
            return label


def roots(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Vertices without predecessor."""
    return _vertices(edges, vertices).join(edges.select(F.col("dst").alias("v")).distinct(), "v", "left_anti")


def call_paths(edges: DataFrame, start: DataFrame, most_depth: int | None = None) -> DataFrame:
    """Every path from the starts (I4): (path array, depth); a path ends before it would repeat a vertex.

    The number of paths can grow exponentially with depth; that is the operator's result, and only
    ``most_depth`` cuts it.
    """
    edges = _cut(edges.select("src", "dst").distinct())
    front = _cut(start.select(F.array(F.col("v").cast("string")).alias("path"), F.col("v").alias("last")))
    out, depth = front, 0
    while most_depth is None or depth < most_depth:
        depth += 1
        front = front.join(edges, F.col("last") == F.col("src")).where(~F.array_contains("path", F.col("dst").cast("string")))
        front = _cut(front.select(F.concat("path", F.array(F.col("dst").cast("string"))).alias("path"), F.col("dst").alias("last")))
        if front.isEmpty():
            break
        out = out.union(front)
        if depth % 32 == 0:
            out = _cut(out)
    return out.select("path", (F.size("path") - 1).alias("depth"))


def tree_text(paths: DataFrame, indent: str = "  ") -> DataFrame:
    """Paths as indented lines in depth-first order (K2): (ord path, line)."""
    return paths.select("path", F.concat(F.repeat(F.lit(indent), F.col("depth")), F.element_at("path", -1)).alias("line")).orderBy("path")


def without_cycles(edges: list[tuple[str, str]], roots_first: list[str] = ()) -> list[tuple[str, str]]:
    """Edges of a small graph without those that close a cycle (I7, I8, I9): depth first in sorted order.

    For module graphs, whose size is the number of modules; on the driver, without recursion.
    """
    after: dict[str, list[str]] = {}
    for a, b in sorted(set(edges)):
        after.setdefault(a, []).append(b)
        after.setdefault(b, [])
    entered = {b for x in after.values() for b in x}
    order = [*roots_first, *sorted(set(after) - entered), *sorted(after)]
    kept, done, path = [], set(), set()
    for root in order:
        if root in done or root not in after:
            continue
        stack = [(root, iter(after[root]))]
        path.add(root)
        while stack:
            node, nexts = stack[-1]
            for b in nexts:
                if b in path:
                    continue
                kept.append((node, b))
                if b not in done:
                    stack.append((b, iter(after[b])))
                    path.add(b)
                    break
            else:
                stack.pop()
                path.discard(node)
                done.add(node)
    return sorted(kept)
