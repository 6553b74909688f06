"""Does tenure (L) earn its place beside R, F and M? Everything from the cell table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.sources.storage import materialise

AXES = ["r_score", "f_score", "m_score", "l_score"]
RFM_AXES = AXES[:3]
AXIS_PAIRS = [(a, b) for i, a in enumerate(AXES) for b in AXES[i + 1:]]
GAIN_NEEDED = 1.5
REDUNDANCY_SLACK = 0.1


def tenure_cells(mart: DataFrame) -> DataFrame:
    """Cells of all four scores with their customers and the length of tenure inside; stored, as most reports read them more than once."""
    return materialise(mart.groupBy(*AXES).agg(
        F.count("*").alias("cnt"), F.min("length").alias("length_min"),
        F.sum("length").alias("length_sum"), F.max("length").alias("length_max"),
    ), "tenure-cells")


def cell_counts(cells: DataFrame) -> DataFrame:
    """Distinct RFM and LRFM cells and the gain in resolution."""
    return cells.agg(
        F.countDistinct(F.struct(*RFM_AXES)).alias("rfm_cells"),
        F.countDistinct(F.struct(*AXES)).alias("lrfm_cells"),
    ).withColumn("gain", F.col("lrfm_cells").cast("double") / F.col("rfm_cells"))


def spearman_scores(cells: DataFrame) -> DataFrame:
    """Spearman correlation of each pair of scores.

    A rank depends on the score alone, so it follows from the customers per axis and score: windows run over these few rows,
    and the cells, however many, look their ranks up in one row of maps. NULL scores have no rank and add nothing.
    """
    stacked = ", ".join(f"'{a}', {a}" for a in AXES)
    per_score = cells.selectExpr("cnt", f"stack({len(AXES)}, {stacked}) AS (axis, score)").filter("score IS NOT NULL").groupBy("axis", "score").agg(F.sum("cnt").alias("n"))
    places = per_score.selectExpr(
        "axis", "score", "sum(n) OVER (PARTITION BY axis ORDER BY score) - (n - 1) / 2D - (sum(n) OVER (PARTITION BY axis) + 1) / 2D AS off_middle")
    maps = places.groupBy().agg(*[
        F.expr(f"map_from_entries(collect_list(IF(axis = '{a}', struct(score, off_middle), NULL)))").alias(f"of_{a}") for a in AXES])
    ranked = cells.crossJoin(F.broadcast(maps)).select("cnt", *[F.expr(f"of_{a}[{a}]").alias(f"{a}_off") for a in AXES])  # a single row

    def product(a: str, b: str) -> str:
        return f"sum(cnt * {a}_off * {b}_off)"

    values = ranked.selectExpr(*[
        f"{product(a, b)} / nullif(sqrt({product(a, a)} * {product(b, b)}), 0D) AS {a}_{b}" for a, b in AXIS_PAIRS])
    pairs = ", ".join(f"'{a}', '{b}', {a}_{b}" for a, b in AXIS_PAIRS)
    return values.selectExpr(f"stack({len(AXIS_PAIRS)}, {pairs}) AS (first, second, rho)")


def redundancy(cells: DataFrame) -> DataFrame:
    """Largest absolute correlation of L with the others, beside the largest within RFM."""
    return spearman_scores(cells).agg(
        F.max(F.expr("IF(second = 'l_score', abs(rho), NULL)")).alias("l_redundancy"),
        F.max(F.expr("IF(second <> 'l_score', abs(rho), NULL)")).alias("rfm_redundancy"),
    )


def split_cells(cells: DataFrame) -> DataFrame:
    """RFM cells with more than one L score, and the share of customers living in them."""
    by_rfm = cells.groupBy(*RFM_AXES).agg(F.count("*").alias("n_l"), F.sum("cnt").alias("cnt"))
    return by_rfm.agg(
        F.count("*").alias("rfm_cells"),
        F.count_if(F.col("n_l") > 1).alias("split_cells"),
        F.expr("100D * count_if(n_l > 1) / count(*)").alias("split_cells_pct"),
        F.expr("100D * sum(IF(n_l > 1, cnt, 0)) / sum(cnt)").alias("split_customers_pct"),
    )


def largest_split_cell(cells: DataFrame) -> DataFrame:
    """The most populous RFM cell that holds at least two L scores (lowest scores on ties)."""
    return cells.groupBy(*RFM_AXES).agg(
        F.count("*").alias("n_l"), F.sum("cnt").alias("customers"),
    ).filter("n_l >= 2").orderBy(F.desc("customers"), *RFM_AXES).limit(1)


def example_cell(cells: DataFrame) -> DataFrame:
    """Tenure per L score inside that cell."""
    chosen = largest_split_cell(cells).select(*RFM_AXES)
    return cells.join(F.broadcast(chosen), RFM_AXES).select(
        *AXES, F.col("cnt").alias("n"), "length_min",
        (F.col("length_sum").cast("double") / F.col("cnt")).alias("length_mean"), "length_max",
    )


def verdict(cells: DataFrame) -> DataFrame:
    """GO when L adds resolution without being more redundant than RFM already is."""
    gain = cell_counts(cells).select("gain").scalar()
    return redundancy(cells).select("l_redundancy", "rfm_redundancy", gain.alias("gain")).withColumn(
        "verdict",
        F.when(
            (F.col("gain") > GAIN_NEEDED) & (F.col("l_redundancy") <= F.col("rfm_redundancy") + REDUNDANCY_SLACK),
            "GO").otherwise("CAUTION"),
    )
