"""Ward linkage of the weighted cells, by rounds that merge all mutual nearest neighbours at once.

Joining two clusters raises the sum of squares by n m / (n + m) times the squared distance of their centres, which is their height. Merging two
clusters never brings a third one nearer to either, so two clusters that are each other's nearest will be merged by the tree at
that height, whatever happens elsewhere: all such pairs of a round can go together. Equal heights are ordered by the clusters' numbers, so that
a round always has a pair. A cluster goes by its smallest cell.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.operators.graph import CHUNK, score_columns
from patronage.sources.storage import materialise


def merge_tree(cells: DataFrame, variables: list[str]) -> tuple[DataFrame, int]:
    """``parent``, ``child`` and ``height`` of every merge, and the number of rounds.

    A round meets clusters with arrays of at most ``CHUNK`` others and keeps the nearest inside the expression, so a cluster gives a row per chunk, never one
    per pair. Rounds are stored tables. An empty table and a single cell have no merges.
    """
    columns = score_columns(variables)
    sums = [f"s{i}" for i in range(len(columns))]
    start = cells.selectExpr("cell_id AS id", "CAST(cnt AS DOUBLE) AS n", *[f"CAST(cnt AS DOUBLE) * {c} AS {s}" for c, s in zip(columns, sums)],
                             "CAST(NULL AS BIGINT) AS child", "CAST(NULL AS DOUBLE) AS height")
    state, rounds = materialise(start, "ward"), []
    chunks = (state.agg(F.max("id")).first()[0] or 0) // CHUNK
    squares = " + ".join(f"pow({s} / n - o.{s} / o.n, 2)" for s in sums)
    nearest = f"array_min(transform(filter(others, o -> o.id <> id), o -> struct(n * o.n / (n + o.n) * ({squares}) AS height, least(id, o.id) AS parent, greatest(id, o.id) AS child)))"
    own = F.struct("id", "n", *sums)
    while state.count() > 1:
        packed = state.groupBy(F.expr(f"id div {CHUNK}").alias("chunk")).agg(F.collect_list(own).alias("others"))
        near = state.withColumn("chunk", F.expr(f"explode(sequence(0L, {chunks}L))")).join(packed, "chunk").select("id", own.alias("own"), F.expr(nearest).alias("best"))
        if chunks:
            near = near.groupBy("id").agg(F.first("own").alias("own"), F.min("best").alias("best"))
        # a pair that both sides chose is one cluster from now on; a choice that is not returned leaves the cluster as it is
        chosen = near.groupBy("best.parent", "best.child", "best.height").agg(F.collect_list("own").alias("sides"))
        merged = ", ".join(["parent AS id", *[f"sides[0].{c} + sides[1].{c} AS {c}" for c in ("n", *sums)], "child AS child", "height AS height"])
        kept = ", ".join([f"sides[0].{c} AS {c}" for c in ("id", "n", *sums)] + ["CAST(NULL AS BIGINT) AS child", "CAST(NULL AS DOUBLE) AS height"])
        state = materialise(chosen.select(F.expr(f"IF(size(sides) = 2, struct({merged}), struct({kept}))").alias("c")).select("c.*"), "ward")
        rounds.append(state.filter("child IS NOT NULL").selectExpr("id AS parent", "child", "height"))
    empty = start.limit(0).selectExpr("id AS parent", "child", "height")
    return reduce(DataFrame.union, rounds, empty), len(rounds)


def ward(cells: DataFrame, variables: list[str], k_values: list[int]) -> DataFrame:
    """Cell labels for each k from one tree, in the layout of the other comparators: ``cell_id``, ``cnt``, the scores, ``cluster``, ``method``, ``k``, ``variables``.

    Leaving out the k - 1 highest merges gives k clusters. Cells find their cluster of the largest k by following merges, which doubles its reach each
    time; the few highest merges then lead to the smaller k. With fewer cells than k, each cell is a cluster.
    """
    tree, rounds = merge_tree(cells, variables)
    tree = materialise(tree, "ward-tree")
    most = max(k_values)
    top = tree.orderBy(F.desc("height"), F.desc("parent"), F.desc("child")).limit(most - 1)
    highest = [(r.parent, r.child) for r in top.collect()]  # at most k - 1 rows
    cut = ", ".join(f"{child}L" for _, child in highest) or "NULL"
    step = tree.filter(f"coalesce(child NOT IN ({cut}), true)").select(F.col("child").alias("id"), F.col("parent").alias("root"))
    for _ in range(math.ceil(math.log2(rounds)) if rounds > 1 else 0):
        further = step.selectExpr("id AS root", "root AS next")
        step = materialise(step.join(further, "root", "left").selectExpr("id", "coalesce(next, root) AS root"), "ward-steps")
    placed = cells.join(step.withColumnRenamed("id", "cell_id"), "cell_id", "left").withColumn("root", F.coalesce("root", "cell_id"))
    placed = materialise(placed.select("cell_id", "cnt", *score_columns(variables), "root"), "ward-cells")
    roots = [r.root for r in placed.select("root").distinct().orderBy("root").collect()]  # as many as the largest k
    labelled = []
    for k in k_values:
        joined = {child: parent for parent, child in highest[k - 1:]}
        ends = []
        for root in roots:
            while root in joined:
                root = joined[root]
            ends.append(root)
        number = {root: i for i, root in enumerate(sorted(set(ends)))}
        cases = " ".join(f"WHEN {root}L THEN {number[end]}" for root, end in zip(roots, ends))
        labelled.append(placed.withColumn("cluster", F.expr(f"CASE root {cases} END") if roots else F.lit(0)).drop("root").withColumns(
            {"method": F.lit("Ward"), "k": F.lit(k), "variables": F.lit("".join(variables))}))
    return reduce(DataFrame.unionByName, labelled)
