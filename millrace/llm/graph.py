"""Connected components of an edge list, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle

# So few edges are one task's work: the rounds that are left then need no shuffles.
_FEW = 1 << 15


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of the edges (a, b); nodes of one component share a root.

    In each round every node goes to the neighbour (or itself) that comes first
    in an order drawn anew for the round, twice in a row, and the edges are
    rewritten between the nodes that are left. A fixed share of the nodes is
    expected to go in each round, also on long chains. Neighbours are folded to
    one before the shuffle, so a node with very many edges is no large group.
    Once few edges are left, of however many, a round is one partition's work.
    Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = settle(edges.select("a", "b").where("a <> b").distinct())
    steps: list[DataFrame] = []
    while left := edges.count():
        narrow = (lambda df: df.coalesce(1)) if left <= _FEW else (lambda df: df)
        edges = narrow(edges)
        draw = F.lit(len(steps))
        turned = F.struct(F.col("b").alias("node"), F.col("a").alias("other"))
        ends = edges.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), turned)))
        first = ends.groupBy("node").agg(F.min(F.struct(F.xxhash64(draw, "other").alias("h"), F.col("other"))).alias("m"))
        own = F.struct(F.xxhash64(draw, "node").alias("h"), F.col("node").alias("other"))
        step = first.select("node", F.least("m", own)["other"].alias("root"))
        step = narrow(settle(_follow(step, step)))
        moved = edges.join(step.toDF("a", "ra"), "a").join(step.toDF("b", "rb"), "b")
        edges = settle(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).where("a <> b").distinct())
        steps.append(step)
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = steps[0]
    for step in steps[1:]:
        roots = _follow(roots, step)
    return roots


def _follow(roots: DataFrame, step: DataFrame) -> DataFrame:
    further = step.toDF("root", "further")
    return roots.join(further, "root", "left").select("node", F.coalesce("further", "root").alias("root"))
