"""Profiles, loyalty and value of labelled customers, and comparison of partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.operators.scoring import LRFM, RAW_COLUMN, SCORE_COLUMN
from patronage.sources.storage import materialise

# Names of the loyalty ranks, and the published silhouette curves for k = 2..10.
LOYALTY = {1: "Very high loyalty", 2: "High loyalty", 3: "Medium loyalty", 4: "Low loyalty"}
PUBLISHED = {
    "max-k-cut": {2: 0.46, 3: 0.35, 4: 0.40, 5: 0.35, 6: 0.29, 7: 0.31, 8: 0.32, 9: 0.34, 10: 0.36},
    "K-means": {2: 0.40, 3: 0.31, 4: 0.33, 5: 0.31, 6: 0.30, 7: 0.29, 8: 0.29, 9: 0.29, 10: 0.27},
    "Ward": {2: 0.32, 3: 0.25, 4: 0.28, 5: 0.26, 6: 0.23, 7: 0.23, 8: 0.23, 9: 0.21, 10: 0.21},
    "GMM": {2: 0.40, 3: 0.37, 4: 0.36, 5: 0.24, 6: 0.16, 7: 0.14, 8: 0.18, 9: 0.23, 10: 0.22},
}
REPRODUCED_BELOW = 0.03


def align_labels(mart: DataFrame, labels: DataFrame) -> DataFrame:
    """Mart rows of the labelled customers with their cluster, joined on the customer id."""
    return mart.join(labels.select("customer_id", "cluster"), "customer_id")


def profile_clusters(labelled: DataFrame, variables: list[str] = LRFM) -> DataFrame:
    """Minimum, mean and maximum of each raw value per cluster, and the customers."""
    aggregates = []
    for v in variables:
        c = RAW_COLUMN[v]
        aggregates += [
            F.min(c).cast("double").alias(f"{c}_min"),
            (F.sum(c).cast("double") / F.count(c)).alias(f"{c}_mean"),
            F.max(c).cast("double").alias(f"{c}_max"),
        ]
    return labelled.groupBy("cluster").agg(*aggregates, F.count("*").alias("customers"))


def mean_scores(labelled: DataFrame, variables: list[str] = LRFM, by: str = "cluster") -> DataFrame:
    means = [(F.sum(SCORE_COLUMN[v]).cast("double") / F.count("*")).alias(SCORE_COLUMN[v]) for v in variables]
    return labelled.groupBy(by).agg(*means)


def mean_scores_long(labelled: DataFrame, variables: list[str] = LRFM, by: str = "cluster") -> DataFrame:
    """The mean scores with one row per cluster and variable."""
    pairs = ", ".join(f"'{v}', {SCORE_COLUMN[v]}" for v in variables)
    return mean_scores(labelled, variables, by).selectExpr(
        by, f"stack({len(variables)}, {pairs}) AS (metric, score)")


def volume_value(labelled: DataFrame, by: str = "cluster") -> DataFrame:
    """Share of customers and share of revenue per cluster."""
    whole = Window.partitionBy()
    grouped = labelled.groupBy(by).agg(F.count("*").alias("customers"), F.sum("monetary").alias("revenue"))
    return grouped.select(
        by, "customers", F.col("revenue").cast("double").alias("revenue"),
        (F.lit(100.0) * F.col("customers") / F.sum("customers").over(whole)).alias("pct_customers"),
        (F.lit(100.0) * F.col("revenue").cast("double") / F.sum("revenue").over(whole).cast("double")).alias("pct_revenue"),
    )


def truncated_rank(df: DataFrame, column: str) -> DataFrame:
    """Descending rank on a table of clusters; tied rows take the mean rank, cut to a whole number."""
    ties = Window.partitionBy(column)
    place = F.rank().over(Window.orderBy(F.desc(column)))
    return df.withColumn("rank", F.floor(place + (F.count("*").over(ties) - 1) / 2).cast("bigint"))


def loyalty_ranking(labelled: DataFrame, variables: list[str] = LRFM) -> DataFrame:
    """Clusters by the length of their mean score vector, longest first."""
    squares = " + ".join(f"{SCORE_COLUMN[v]} * {SCORE_COLUMN[v]}" for v in variables)
    means = mean_scores(labelled, variables).withColumn("distance", F.expr(f"round(sqrt({squares}), 9)"))
    return truncated_rank(means, "distance")


def loyalty_segments(labelled: DataFrame, variables: list[str] = LRFM) -> DataFrame:
    """Customers with the loyalty name of their cluster."""
    names = " ".join(f"WHEN rank = {rank} THEN '{name}'" for rank, name in LOYALTY.items())
    ranks = loyalty_ranking(labelled, variables).selectExpr(
        "cluster", f"CASE {names} ELSE concat('rank ', rank) END AS segment")
    return labelled.join(ranks, "cluster")


def exact_quantiles(df: DataFrame, by: str, value: str, shares: dict[str, float], accuracy: int = 1000) -> DataFrame:
    """Interpolated quantiles of ``value`` (no NULL) per group: one row for each group, one column for each share.

    An approximate pass brackets each wanted rank (its error is bounded by ``accuracy``); then counts below the bracket and
    running counts inside it, over folded values, find the rank exactly. Groups stay in tables, whatever their number or type.
    """
    whole = df.select(F.col(by).alias("g"), F.col(value).alias("v")).filter("v IS NOT NULL")
    margin = 2 / accuracy
    ends = [min(1.0, max(0.0, s + side * margin)) for s in shares.values() for side in (-1, 1)]
    bounds = whole.groupBy("g").agg(F.percentile_approx("v", ends, 2 * accuracy).alias("e"), F.count("*").alias("n"))
    bounds = bounds.withColumnRenamed("g", "group")
    folded = whole.groupBy("g", "v").agg(F.count("*").alias("c")).join(bounds, F.expr("g <=> group")).drop("group")
    names = list(shares)
    few = 2 * accuracy  # a bracket of a smaller group could miss the neighbours of a rank, so it holds the whole group
    wanted = ", ".join(
        f"struct({i} AS i, {shares[name]}D * (n - 1) AS r, IF(n > {few}, e[{2 * i}], NULL) AS low, IF(n > {few}, e[{2 * i + 1}], NULL) AS high)" for i, name in enumerate(names))
    near = folded.selectExpr("g", "v", "c", f"explode(array({wanted})) AS w").filter("coalesce(v <= w.high, true)")
    # values below a bracket count as one row
    near = near.groupBy("g", F.col("w.i").alias("i"), F.col("w.r").alias("r"), F.expr("greatest(v, w.low)").alias("v"), F.expr("coalesce(v < w.low, false)").alias("under")).agg(F.sum("c").alias("c"))
    running = near.selectExpr("*", "sum(c) OVER (PARTITION BY g, i ORDER BY under DESC, v) AS upto").filter("NOT under")
    found = running.groupBy("g", "i").agg(
        F.expr("min(IF(upto > floor(r), v, NULL))").alias("a"), F.expr("min(IF(upto > ceil(r), v, NULL))").alias("b"), F.first("r").alias("r"))
    value_at = found.selectExpr("g", "i", "CAST(a AS DOUBLE) + (CAST(b AS DOUBLE) - CAST(a AS DOUBLE)) * (r - floor(r)) AS q")
    return value_at.groupBy(F.col("g").alias(by)).agg(*[F.expr(f"max(IF(i = {i}, q, NULL))").alias(name) for i, name in enumerate(names)])


def box_statistics(labelled: DataFrame, by: str = "cluster", accuracy: int = 1000) -> DataFrame:
    """Exact quartiles of monetary value per cluster and the whiskers inside 1.5 quartile ranges.

    Groups may be of any type and number, NULL included; an empty table gives no rows.
    """
    stored = materialise(labelled.select(by, "monetary"), "boxes")
    table = exact_quantiles(stored, by, "monetary", {"q1": 0.25, "median": 0.5, "q3": 0.75}, accuracy).withColumnRenamed(by, "group")
    return stored.join(table, F.col(by).eqNullSafe(F.col("group"))).groupBy(by, "q1", "median", "q3").agg(
        F.expr("min(IF(monetary >= q1 - 1.5D * (q3 - q1), CAST(monetary AS DOUBLE), NULL))").alias("whisker_low"),
        F.expr("max(IF(monetary <= q3 + 1.5D * (q3 - q1), CAST(monetary AS DOUBLE), NULL))").alias("whisker_high"),
    )


# ---------------------------------------------------------------- comparing curves

def best_k(curve: DataFrame, keys: list[str]) -> DataFrame:
    """The k with the highest silhouette, the smallest one on ties."""
    best = F.max(F.struct("silhouette", (-F.col("k")).alias("minus_k")))
    return curve.filter("NOT isnan(silhouette)").groupBy(*keys).agg(best.alias("b")).selectExpr(
        *keys, "-b.minus_k AS k", "b.silhouette AS silhouette")


def published_curve(spark, method: str = "max-k-cut") -> DataFrame:
    rows = ", ".join(f"({k}L, {value!r}D)" for k, value in PUBLISHED[method].items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(k, published)")


def beside_published(curve: DataFrame, method: str = "max-k-cut") -> DataFrame:
    """Measured and published silhouette side by side, joined on k."""
    return published_curve(curve.sparkSession, method).join(curve.select("k", "silhouette"), "k")


def deviation(curve: DataFrame, method: str = "max-k-cut") -> DataFrame:
    """Mean and largest absolute difference from the published curve, and the verdict."""
    return beside_published(curve, method).agg(
        F.expr("avg(abs(silhouette - published))").alias("mean_delta"),
        F.expr("max(abs(silhouette - published))").alias("max_delta"),
    ).selectExpr("*", f"IF(mean_delta < {REPRODUCED_BELOW}D, 'CONFIRMED', 'CHECK') AS verdict")


def method_table(curve: DataFrame, methods: list[str]) -> DataFrame:
    """One row per k (and variable set), one column per method."""
    return curve.groupBy("variables", "k").pivot("method", methods).agg(F.first("silhouette"))
