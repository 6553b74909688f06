"""From raw log to reports and segments, every stage stored below one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.operators import clean as cleaning
from patronage.operators import evaluate, graph, scoring, segment, tenure, warehouse
from patronage.plans.reports import run_reports
from patronage.plans.views import register
from patronage.sources.storage import save_table


def _store(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    save_table(df, path)
    return spark.read.parquet(path)


def full_run(log: DataFrame, folder: str, variable_sets: list[list[str]] | None = None,
             k_values: list[int] | None = None, profile_k: int = 4,
             restarts: int = segment.RESTARTS) -> dict[str, DataFrame]:
    """Clean, normalise, score, report, segment and evaluate; returns scans of the stored tables.

    Tables: ``clean``, the four of the warehouse, ``customer_rfml``, one per report,
    ``tenure``, ``curve`` (objective and silhouette per variable set and k), and per set
    the customer labels, raw profile and loyalty ranking at ``profile_k``.
    """
    spark = log.sparkSession
    out: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        out[name] = _store(spark, df, f"{folder}/{name}")
        return out[name]

    cleaned = keep("clean", cleaning.clean(log))
    tables = warehouse.write_tables(warehouse.build_tables(cleaned), folder)
    out.update(tables)
    mart = keep("customer_rfml", scoring.customer_rfml(warehouse.renamed(cleaned)))
    register(tables, mart)
    for name, report in run_reports(mart).items():
        keep(f"report_{name}", report)
    keep("tenure", tenure.verdict(tenure.tenure_cells(mart)))

    sets = variable_sets or [scoring.RFM, scoring.LRFM]
    curve, labels = segment.sweep(mart, sets, k_values, restarts)
    keep("curve", curve)
    for variables in sets:
        name = "".join(variables)
        chosen = labels[name].filter(f"k = {profile_k}")
        labelled = keep(f"labels_{name}", graph.lift(mart, chosen, variables))
        keep(f"profile_{name}", evaluate.profile_clusters(labelled, variables))
        keep(f"loyalty_{name}", evaluate.loyalty_ranking(labelled, variables))
    return out
