"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.sources.storage import materialise


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's neighbours (the larger ones, or the smaller ones and itself) on its least neighbour."""
    if large:
        around = edges.union(edges.selectExpr("b AS a", "a AS b"))
    else:
        around = edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    hung = around.join(least, "a")
    if large:
        hung = hung.filter("b > a").selectExpr("b AS a", "m AS b")
    else:
        hung = hung.selectExpr("b AS a", "m AS b").union(least.selectExpr("a", "m AS b"))
    return hung.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node on an edge (a, b): root is the least node reachable.

    Each round is written to the shared folder, so that lost executors cost one round at most. A round moves
    rows of two numbers; minima are pre-aggregated, and joins on a hot node keep its rows on one side only,
    which Spark splits. Ends when a round changes nothing (about log2 of the longest path). Loops and null
    ends are ignored; no edges give no rows.
    """
    now = materialise(edges.selectExpr("CAST(a AS BIGINT) AS a", "CAST(b AS BIGINT) AS b").filter("a <> b").distinct(), "edges")
    mark = None
    while True:
        now = materialise(_stars(_stars(now, True), False), "edges")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40)), F.sum(F.xxhash64("b", "a") % (1 << 40))).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
    return now.selectExpr("a AS node", "b AS root").union(now.selectExpr("b AS node", "b AS root").distinct())
