"""Cleaning rules, their decision log, and reconciliation with known figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.functions.expressions import line_amount

# The figures published for the original data set.
ANCHORS = {"line_items": 805_549, "invoices": 79_104, "customers": 5_878}


def with_customer(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["CustomerID"])


def positive_quantity(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Quantity") > 0)


def positive_price(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Price") > 0)


def deduplicate(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows over the given columns, or over all of them.

    Copies fold together before the shuffle, so a row repeated any number of times
    sends one row per task.
    """
    return (df.select(*columns) if columns else df).distinct()


def with_total(df: DataFrame) -> DataFrame:
    return df.withColumn("Total", line_amount(F.col("Quantity"), F.col("Price")))


def clean(log: DataFrame, keep_part: bool = True) -> DataFrame:
    """Rows with a customer, positive quantity and price, no exact copies, plus ``Total``.

    With ``keep_part`` the part tag belongs to the key of a copy, so a line present in
    two parts stays twice. Without it the line counts once and the tag is dropped.
    """
    columns = [c for c in log.columns if keep_part or c != "SourceSheet"]
    kept = positive_price(positive_quantity(with_customer(log)))
    return with_total(deduplicate(kept, columns))


# Names of the rules in the cleaning log.
RULE_NAMES = ["0 raw rows", "1 drop missing CustomerID", "2 drop Quantity<=0", "3 drop Price<=0", "4 drop exact duplicates"]


def _rules() -> list[tuple[str, Column]]:
    """Rule names in order, each with the condition for a row to have survived so far."""
    customer = F.col("CustomerID").isNotNull()
    quantity = customer & F.coalesce(F.col("Quantity") > 0, F.lit(False))
    price = quantity & F.coalesce(F.col("Price") > 0, F.lit(False))
    return list(zip(RULE_NAMES, [F.lit(True), customer, quantity, price]))


def cleaning_log(log: DataFrame) -> DataFrame:
    """Rows left and removed after each ordered rule.

    The row rules are counted where rows are read; only rows that pass them all are folded for the last rule.
    """
    rules = _rules()
    passed = log.agg(*[F.count(F.when(cond, 1)).alias(f"c{i}") for i, (_, cond) in enumerate(rules)])
    distinct = log.filter(rules[-1][1]).distinct().agg(F.count("*").alias(f"c{len(rules)}"))
    counts = passed.crossJoin(distinct)  # one row each
    names = RULE_NAMES
    steps = F.array(*[
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"c{i}").alias("rows_left"),
            (F.col(f"c{max(i - 1, 0)}") - F.col(f"c{i}")).alias("rows_removed"),
        )
        for i, name in enumerate(names)
    ])
    return counts.select(F.explode(steps).alias("s")).select("s.rule", "s.rows_left", "s.rows_removed")


def reconciliation(cleaned: DataFrame) -> DataFrame:
    """Line items, invoices and customers beside the published figures."""
    # one row per invoice first: distinct counts then need no wide expansion
    invoices = cleaned.groupBy("Invoice", "CustomerID").agg(F.count("*").alias("n"))
    counts = invoices.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("line_items"),
        F.countDistinct("Invoice").alias("invoices"),
        F.countDistinct("CustomerID").alias("customers"),
    )
    lines = F.array(*[
        F.struct(
            F.lit(name).alias("measure"),
            F.col(name).cast("bigint").alias("measured"),
            F.lit(published).cast("bigint").alias("published"),
        )
        for name, published in ANCHORS.items()
    ])
    return (
        counts.select(F.explode(lines).alias("l"))
        .select("l.*")
        .withColumn("verdict", F.when(F.col("measured") == F.col("published"), "MATCH").otherwise("CHECK"))
    )
