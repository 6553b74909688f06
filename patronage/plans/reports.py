"""The five named reports over the customer mart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.functions.expressions import churn_band, combined_fm, named_segment, share_where
from patronage.operators.ranking import ROWS_PER_BUCKET, long_form, order_statistics
from patronage.operators.scoring import BINS, ORDINAL, SCORE_COLUMN, bin_of, ntile_starts


def with_segment(mart: DataFrame, half_even: bool = False) -> DataFrame:
    fm = combined_fm(F.col("f_score"), F.col("m_score"), half_even)
    return mart.withColumn("fm", fm).withColumn("segment", named_segment(F.col("r_score"), F.col("fm")))


def _mean(column: str, digits: int) -> Column:
    total = F.sum(column).cast("double")
    return F.round(total / F.count("*"), digits)


def _percent_of_all(aggregate: str, digits: int = 1) -> Column:
    """Share of a per-group total in the sum over all groups (a handful of rows)."""
    value = F.col(aggregate).cast("double")
    whole = F.sum(F.col(aggregate)).over(Window.partitionBy()).cast("double")
    return F.round(F.lit(100.0) * value / whole, digits)


def score_balance(mart: DataFrame) -> DataFrame:
    """Customers per score on each axis: one narrow pass, one aggregation."""
    entries = F.array(*[
        F.struct(F.lit(axis).alias("axis"), F.col(column).cast("bigint").alias("score"))
        for axis, column in SCORE_COLUMN.items()
    ])
    return (
        mart.select(F.explode(entries).alias("e"))
        .groupBy("e.axis", "e.score")
        .agg(F.count("*").alias("customers"))
        .orderBy("axis", "score")
    )


def segment_values(mart: DataFrame) -> DataFrame:
    grouped = with_segment(mart).groupBy("segment").agg(
        F.count("*").alias("customers"),
        _mean("recency", 0).alias("avg_recency"),
        _mean("frequency", 1).alias("avg_frequency"),
        _mean("monetary", 0).alias("avg_monetary"),
        _mean("length", 0).alias("avg_length"),
        F.sum("monetary").alias("revenue"),
    )
    return grouped.select(
        "segment", "customers", _percent_of_all("customers").alias("pct_customers"),
        "avg_recency", "avg_frequency", "avg_monetary", "avg_length",
        F.round(F.col("revenue").cast("double"), 0).alias("total_revenue"),
        _percent_of_all("revenue").alias("pct_revenue"),
    ).orderBy(F.desc("total_revenue"), "segment")


def churn_by_recency(mart: DataFrame) -> DataFrame:
    grouped = mart.groupBy(churn_band(F.col("recency")).alias("churn_band")).agg(
        F.count("*").alias("customers"),
        _mean("frequency", 1).alias("avg_frequency"),
        F.sum("monetary").alias("revenue"),
    )
    return grouped.select(
        "churn_band", "customers", _percent_of_all("customers").alias("pct_customers"), "avg_frequency",
        F.round(F.col("revenue").cast("double"), 0).alias("revenue_at_band"),
        _percent_of_all("revenue").alias("pct_revenue"),
    ).orderBy("churn_band")


def response_proxy(mart: DataFrame) -> DataFrame:
    """Repeat and active rates: engagement, not campaign response."""
    return with_segment(mart).groupBy("segment").agg(
        F.count("*").alias("customers"),
        F.round(F.lit(100.0) * share_where(F.col("frequency") > 1), 1).alias("repeat_rate_pct"),
        F.round(F.lit(100.0) * share_where(F.col("recency") <= 90), 1).alias("active_rate_pct"),
    ).orderBy(F.desc("repeat_rate_pct"), "segment")


def monetary_quintiles(mart: DataFrame, bins: int = BINS, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Append the bin of the descending monetary order (1 = richest)."""
    ordinal = f"-{ORDINAL['M']}"
    found, _ = order_statistics(
        long_form(mart, {"M": ordinal}, "customer_id"), lambda _axis, total: ntile_starts(total, bins), rows_per_bucket)
    borders = [border for _, border in sorted(found.get(("M", ""), {}).items())]
    return mart.withColumn("m_quintile", bin_of(ordinal, "customer_id", borders))


def revenue_concentration(mart: DataFrame) -> DataFrame:
    grouped = monetary_quintiles(mart).groupBy(F.col("m_quintile").cast("bigint").alias("m_quintile")).agg(
        F.count("*").alias("customers"), F.sum("monetary").alias("revenue"))
    return grouped.select(
        "m_quintile", "customers",
        F.round(F.col("revenue").cast("double"), 0).alias("total_revenue"),
        _percent_of_all("revenue").alias("pct_revenue"),
    ).orderBy("m_quintile")


REPORTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "score_balance": ("customers per score on each axis", score_balance),
    "segment_values": ("named segments: size, averages, revenue share", segment_values),
    "churn_by_recency": ("customers and revenue per recency band", churn_by_recency),
    "response_proxy": ("repeat and active rate per segment", response_proxy),
    "revenue_concentration": ("revenue per monetary quintile", revenue_concentration),
}


def run_reports(mart: DataFrame) -> dict[str, DataFrame]:
    """All reports in order, each lazily planned over the same mart."""
    return {name: build(mart) for name, (_, build) in REPORTS.items()}
