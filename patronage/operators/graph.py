"""Customers merged into weighted cells of equal scores, and sums over those cells.

A cell table is as long as the number of different score vectors, at most
``bins ** len(variables)``, however many customers there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.skew import lookup
from patronage.operators.scoring import BINS, SCORE_COLUMN

CHUNK = 1024  # cells packed into one array
BROADCAST_CELLS = 100_000  # largest lattice sent to the customers whole


def score_columns(variables: list[str]) -> list[str]:
    return [SCORE_COLUMN[v] for v in variables]


def cell_number(variables: list[str], bins: int = BINS) -> str:
    """SQL for the position of a score vector in the lattice, in the order of the vectors."""
    number = "0"
    for column in score_columns(variables):
        number = f"({number}) * {bins} + {column} - 1"
    return f"CAST({number} AS BIGINT)"


def reduce_cells(mart: DataFrame, variables: list[str], bins: int = BINS,
                 cohort: list[str] | None = None) -> DataFrame:
    """One row per score vector (and cohort) with the number of its customers."""
    columns = score_columns(variables)
    counted = mart.groupBy(*(cohort or []), *columns).agg(F.count("*").alias("cnt"))
    return counted.withColumn("cell_id", F.expr(cell_number(variables, bins)))


def distance(variables: list[str], left: str, right: str, metric: str = "manhattan") -> str:
    """SQL for the distance of two score vectors held in fields of ``left`` and ``right``."""
    def field(side: str, column: str) -> str:
        return f"{side}.{column}" if side else column

    pairs = [(field(left, c), field(right, c)) for c in score_columns(variables)]
    forms = {
        "manhattan": ("abs({0} - {1})", "CAST({} AS DOUBLE)"),
        "euclidean": ("pow({0} - {1}, 2)", "sqrt({})"),
    }
    if metric not in forms:
        raise ValueError(f"{metric!r} is not one of {', '.join(forms)}")
    term, whole = forms[metric]
    return whole.format(" + ".join(term.format(*pair) for pair in pairs))


def _chunks(variables: list[str], bins: int) -> int:
    return (bins ** len(variables) + CHUNK - 1) // CHUNK


def edges(cells: DataFrame, variables: list[str], metric: str = "manhattan", bins: int = BINS) -> DataFrame:
    """Edge list of the merged graph: weight = count x count x distance, ``i < j``.

    The edge list is the output, so it has cells-squared rows by definition. Cells meet
    in arrays of bounded length, keyed by chunk: an equi-join on small rows.
    """
    columns = score_columns(variables)
    packed = cells.groupBy(F.expr(f"cell_id div {CHUNK}").alias("chunk")).agg(
        F.collect_list(F.struct("cell_id", "cnt", *columns)).alias("others"))
    left = cells.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_chunks(variables, bins) - 1).cast("bigint"))))
    met = left.join(packed, "chunk").withColumn("o", F.explode(F.expr("filter(others, o -> o.cell_id > cell_id)")))
    return met.selectExpr(
        "cell_id AS i", "o.cell_id AS j",
        f"CAST(cnt AS DOUBLE) * o.cnt * {distance(variables, '', 'o', metric)} AS w",
    ).filter("w > 0")


# ---------------------------------------------------------------- lifting labels

def lift(mart: DataFrame, labels: DataFrame, variables: list[str], bins: int = BINS,
         broadcast_cells: int | None = None) -> DataFrame:
    """Every customer with the cluster of its cell; ``labels`` has one row per cell.

    A lattice of checked size goes to the customers by broadcast. A larger one is joined
    by shuffle, with the cells that hold many customers served apart.
    """
    columns = score_columns(variables)
    if bins ** len(variables) <= (BROADCAST_CELLS if broadcast_cells is None else broadcast_cells):
        return mart.join(F.broadcast(labels.select(*columns, "cluster")), columns)
    found = lookup(mart, labels.select(*columns, "cnt", "cluster"), columns, "cnt", "customer_id")
    return found.filter("cluster IS NOT NULL")


# ---------------------------------------------------------------- cut of a partition

def threshold_counts(labelled: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """Customers per labelling, cluster, dimension and score: at most k x q x bins rows each."""
    stacked = ", ".join(f"'{v}', {SCORE_COLUMN[v]}" for v in variables)
    return labelled.selectExpr(
        *keys, "cluster", "cnt", f"stack({len(variables)}, {stacked}) AS (dimension, score)"
    ).groupBy(*keys, "cluster", "dimension", "score").agg(F.sum("cnt").alias("h"))


def _spread(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Sum of pairwise Manhattan gaps inside each group.

    On one dimension the pairs split at each threshold into those below and those above,
    so the sum is linear in the number of scores: no pair is formed.
    """
    ordered = Window.partitionBy(*keys, "dimension").orderBy("score")
    whole = Window.partitionBy(*keys, "dimension")
    steps = counts.select(
        *keys,
        F.sum("h").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("decimal(19,0)").alias("below"),
        F.sum("h").over(whole).cast("decimal(19,0)").alias("n"),
        (F.lead("score").over(ordered) - F.col("score")).alias("gap"),
    )
    return steps.groupBy(*[k for k in keys if k != "cluster"]).agg(
        F.coalesce(F.sum(F.expr("CAST(below * (n - below) * gap AS DECIMAL(38,0))")), F.lit(0)).cast("double").alias(name))


def cut_manhattan(labelled: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """Total, intra-cluster and crossing weight of each labelling, from counts alone."""
    counts = threshold_counts(labelled, keys, variables)
    intra = _spread(counts, [*keys, "cluster"], "intra")
    overall = counts.groupBy(*keys, "dimension", "score").agg(F.sum("h").alias("h"))
    total = _spread(overall, keys, "total")
    return total.join(intra, keys).selectExpr(*keys, "total", "intra", "total - intra AS cut")


def cluster_mass(labelled: DataFrame, keys: list[str], variables: list[str], metric: str = "euclidean",
                 bins: int = BINS) -> DataFrame:
    """For every cell and cluster of a labelling: customers in the cluster, and the sum of
    their distances to the cell.

    The cells of a labelling travel as arrays of at most ``CHUNK`` entries keyed by
    (labelling, chunk); a cell yields one row per cluster, never one per pair.
    """
    columns = score_columns(variables)
    member = F.struct("cnt", *columns)
    per_cluster = labelled.groupBy(*keys, F.expr(f"cell_id div {CHUNK}").alias("chunk"), "cluster").agg(
        F.sum("cnt").alias("n"), F.collect_list(member).alias("members"))
    packed = per_cluster.groupBy(*keys, "chunk").agg(
        F.collect_list(F.struct(F.col("cluster").alias("other"), "n", "members")).alias("clusters"))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.lit(_chunks(variables, bins) - 1).cast("bigint"))
    met = (
        labelled.select(*keys, "cell_id", "cluster", "cnt", *columns)
        .withColumn("chunk", F.explode(chunks))
        .join(packed, [*keys, "chunk"])
        .withColumn("c", F.explode("clusters"))
    )
    reach = f"aggregate(c.members, 0D, (acc, u) -> acc + u.cnt * {distance(variables, '', 'u', metric)})"
    mass = met.selectExpr(*keys, "cell_id", "cluster", "cnt", "c.other AS other", "c.n AS n", f"{reach} AS mass")
    if _chunks(variables, bins) > 1:
        mass = mass.groupBy(*keys, "cell_id", "cluster", "cnt", "other").agg(
            F.sum("n").alias("n"), F.sum("mass").alias("mass"))
    return mass


def cut_by_pairs(labelled: DataFrame, keys: list[str], variables: list[str], metric: str = "euclidean",
                 bins: int = BINS) -> DataFrame:
    """Cut for any metric, from the distance sums of cells to clusters."""
    mass = cluster_mass(labelled, keys, variables, metric, bins)
    return mass.groupBy(*keys).agg(
        F.expr("sum(cnt * mass) / 2").alias("total"),
        F.expr("sum(IF(other = cluster, cnt * mass, 0D)) / 2").alias("intra"),
    ).selectExpr(*keys, "total", "intra", "total - intra AS cut")


#: Silhouette of a cell from its own cluster's size and the mean distances to its own and to the nearest other cluster.
SILHOUETTE = """CASE WHEN b IS NULL THEN double('NaN') WHEN own_n = 1 THEN 0D
                     WHEN greatest(a, b) = 0 THEN 0D ELSE (b - a) / greatest(a, b) END"""


def score_reach(labelled: DataFrame, keys: list[str], variables: list[str], bins: int = BINS) -> DataFrame:
    """One row per labelling: ``clusters``, their customers ``n``, and ``reach[variable][score - 1][cluster]``, the sum of the Manhattan gaps on
    that axis from the score to all customers of the cluster.

    Running counts and running sums of scores give each sum, so the work is linear in clusters x variables x scores.
    """
    counts = threshold_counts(labelled, keys, variables)
    axes = ", ".join(f"'{v}'" for v in variables)
    empty = labelled.select(*keys, "cluster").distinct().selectExpr(*keys, "cluster", f"explode(array({axes})) AS dimension").selectExpr(
        "*", f"explode(sequence(1, {bins})) AS score", "0L AS h")
    dense = counts.unionByName(empty).groupBy(*keys, "cluster", "dimension", "score").agg(F.sum("h").cast("double").alias("h"))
    upto = Window.partitionBy(*keys, "cluster", "dimension").orderBy("score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys, "cluster", "dimension")
    running = dense.select(
        *keys, "cluster", "dimension", "score", F.sum("h").over(upto).alias("c"), F.sum(F.expr("h * score")).over(upto).alias("s"),
        F.sum("h").over(whole).alias("n"), F.sum(F.expr("h * score")).over(whole).alias("total"))
    sums = running.selectExpr(*keys, "cluster", "dimension", "score", "n", "score * c - s + (total - s) - score * (n - c) AS gap")
    per_axis = sums.groupBy(*keys, "cluster", "dimension").agg(F.max("n").alias("n"), F.expr("transform(array_sort(collect_list(struct(score, gap))), x -> x.gap)").alias("gaps"))
    per_cluster = per_axis.groupBy(*keys, "cluster").agg(
        F.max("n").alias("n"), *[F.max(F.when(F.col("dimension") == v, F.col("gaps"))).alias(f"of_{v}") for v in variables])
    fields = ["cluster", "n", *[f"of_{v}" for v in variables]]
    packed = per_cluster.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("p"))
    of_score = ", ".join(f"transform(sequence(0, {bins - 1}), i -> transform(p, x -> x.of_{v}[i]))" for v in variables)
    return packed.selectExpr(*keys, "transform(p, x -> x.cluster) AS clusters", "transform(p, x -> x.n) AS n", f"array({of_score}) AS reach")


def _manhattan_means(labelled: DataFrame, keys: list[str], variables: list[str], bins: int) -> DataFrame:
    """``own_n``, ``a`` and ``b`` of each cell, looked up by its scores."""
    tables = score_reach(labelled, keys, variables, bins).withColumnsRenamed({k: f"of_{k}" for k in keys})
    same = F.expr(" AND ".join(f"`{k}` <=> `of_{k}`" for k in keys))
    joined = labelled.select(*keys, "cell_id", "cluster", "cnt", *score_columns(variables)).join(tables, same)
    mass = " + ".join(f"reach[{v}][{c} - 1][i]" for v, c in enumerate(score_columns(variables)))
    found = joined.selectExpr(*keys, "cell_id", "cnt", "n", "CAST(array_position(clusters, cluster) - 1 AS INT) AS own", f"transform(n, (x, i) -> {mass}) AS mass")
    return found.selectExpr(
        *keys, "cell_id", "cnt", "n[own] AS own_n", "mass[own] / nullif(n[own] - 1, 0) AS a",
        "array_min(transform(filter(sequence(0, size(n) - 1), i -> i <> own), i -> mass[i] / n[i])) AS b")


def silhouette(labelled: DataFrame, keys: list[str], variables: list[str], metric: str = "euclidean",
               bins: int = BINS) -> DataFrame:
    """Mean silhouette over all customers of each labelling, exact.

    Customers of a cell share their value, so cells weighted by their count suffice. The Manhattan metric needs no pairs: distance sums
    are looked up by score; any other meets every pair of cells. A customer alone in its cluster counts 0; with fewer than two clusters the value is NaN.
    """
    if metric == "manhattan":
        per_cell = _manhattan_means(labelled, keys, variables, bins)
    else:
        per_cell = cluster_mass(labelled, keys, variables, metric, bins).groupBy(*keys, "cell_id", "cnt").agg(
            F.expr("max(IF(other = cluster, n, NULL))").alias("own_n"),
            F.expr("max(IF(other = cluster, mass / nullif(n - 1, 0), NULL))").alias("a"),
            F.expr("min(IF(other <> cluster, mass / n, NULL))").alias("b"),
        )
    return per_cell.withColumn("s", F.expr(SILHOUETTE)).groupBy(*keys).agg(
        F.expr("sum(s * cnt) / sum(cnt)").alias("silhouette"))


# ---------------------------------------------------------------- exhaustive optimum

def exhaustive_cut(cells: DataFrame, variables: list[str], k_values: list[int], bins: int,
                   metric: str = "manhattan") -> DataFrame:
    """Largest cut over all partitions of a small lattice into at most k clusters.

    Every number below ``k ** (vertices - 1)`` is one partition, written in base k; the
    first vertex stays in cluster 0, as renaming clusters changes nothing. The edges are
    one array of at most ``vertices ** 2 / 2`` entries.
    """
    vertices = bins ** len(variables)
    if max(k_values) ** (vertices - 1) > 2 ** 40:
        raise ValueError("too many partitions to enumerate; use the local search")
    spark = cells.sparkSession
    packed = edges(cells, variables, metric, bins).agg(F.collect_list(F.struct("i", "j", "w")).alias("e")).scalar()
    results = []
    for k in k_values:
        digits = f"transform(sequence(0, {vertices - 2}), p -> (id div CAST(power({k}D, p) AS BIGINT)) % {k}L)"
        partitions = spark.range(k ** (vertices - 1)).withColumn("e", packed).withColumn(
            "digit", F.expr(f"concat(array(0L), {digits})"))
        cut = "aggregate(e, 0D, (acc, x) -> acc + IF(digit[CAST(x.i AS INT)] <> digit[CAST(x.j AS INT)], x.w, 0D))"
        results.append(partitions.agg(F.expr(f"max({cut})").alias("best_cut")).selectExpr(
            f"{k}L AS k", "coalesce(best_cut, 0D) AS best_cut"))
    return reduce(DataFrame.unionByName, results)
