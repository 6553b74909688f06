"""Temp views under the warehouse's table names, for reports written as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.functions.expressions import CHURN_BANDS, OTHER_SEGMENT, SEGMENT_GRID
from patronage.operators.warehouse import invoice_totals
from patronage.plans.reports import monetary_quintiles

#: The reports as SQL text over the views, with named parameters.
REPORT_TEXTS = {
    "score_balance": """
        SELECT axis, score, count(*) AS customers
        FROM customer_rfml LATERAL VIEW stack(4, 'R', r_score, 'F', f_score, 'M', m_score, 'L', l_score) s AS axis, score
        GROUP BY axis, score ORDER BY axis, score;""",
    "segment_values": """
        SELECT segment, count(*) AS customers, round(100 * count(*) / sum(count(*)) OVER (), 1) AS pct_customers,
               round(avg(CAST(recency AS DOUBLE)), 0) AS avg_recency, round(avg(CAST(frequency AS DOUBLE)), 1) AS avg_frequency,
               round(CAST(sum(monetary) AS DOUBLE), 0) AS total_revenue
        FROM customer_segments GROUP BY segment ORDER BY total_revenue DESC, segment;""",
    "churn_by_recency": """
        SELECT name AS churn_band, count(*) AS customers, round(CAST(sum(monetary) AS DOUBLE), 0) AS revenue_at_band
        FROM customer_rfml JOIN churn_bands ON recency > above AND recency <= upto
        GROUP BY name ORDER BY name;""",
    "response_proxy": """
        SELECT segment, count(*) AS customers, round(100 * avg(IF(frequency >= :repeat_orders, 1D, 0D)), 1) AS repeat_rate_pct,
               round(100 * avg(IF(recency <= :active_days, 1D, 0D)), 1) AS active_rate_pct
        FROM customer_segments GROUP BY segment ORDER BY repeat_rate_pct DESC, segment;""",
    "revenue_concentration": """
        SELECT m_quintile, count(*) AS customers, round(CAST(sum(monetary) AS DOUBLE), 0) AS total_revenue
        FROM customer_quintiles WHERE m_quintile <= :quintiles GROUP BY m_quintile ORDER BY m_quintile;""",
}
PARAMETERS = {"repeat_orders": 2, "active_days": 90, "quintiles": 5}


def register(tables: dict[str, DataFrame], mart: DataFrame) -> list[str]:
    """Register the four tables, ``v_invoices``, ``customer_rfml``, the customers with their segment and their quintile, and the two lookup
    tables of fixed size that the reports join: ``segment_grid`` and ``churn_bands``. Returns the names."""
    spark = mart.sparkSession
    limits = [limit for limit, _ in CHURN_BANDS[:-1]]
    bands = zip([-1, *limits], [*limits, 2**31 - 1], [name for _, name in CHURN_BANDS])
    grid = [(r, fm, name) for r, row in SEGMENT_GRID.items() for fm, name in enumerate(row, 1)]
    spark.createDataFrame(grid, "r_score INT, fm INT, segment STRING").createOrReplaceTempView("segment_grid")
    spark.createDataFrame(list(bands), "above INT, upto INT, name STRING").createOrReplaceTempView("churn_bands")
    mart.createOrReplaceTempView("customer_rfml")
    frames = {
        **tables,
        "v_invoices": invoice_totals(tables["fact_line"], tables["dim_invoice"]),
        "customer_rfml": mart,
        "customer_quintiles": monetary_quintiles(mart),
        "customer_segments": spark.sql(
            "SELECT c.*, coalesce(segment, :other) AS segment FROM customer_rfml c LEFT JOIN segment_grid g "
            "ON g.r_score = c.r_score AND g.fm = (c.f_score + c.m_score + 1) DIV 2", args={"other": OTHER_SEGMENT}),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return [*frames, "segment_grid", "churn_bands"]


def run_sql(spark: SparkSession, texts: dict[str, str], parameters: dict | None = None) -> dict[str, DataFrame]:
    """Named SQL texts over those views, in order; a closing semicolon is allowed, and ``:name`` stands for a parameter."""
    return {name: spark.sql(text.strip().rstrip(";"), args=parameters) for name, text in texts.items()}
