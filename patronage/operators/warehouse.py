"""Normalised tables, their integrity checks, and the invoice view."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.functions.skew import lookup
from patronage.sources.storage import save_bucketed, save_table

# clean column -> warehouse column
RENAMES = {
    "Invoice": "invoice_id",
    "StockCode": "stock_code",
    "CustomerID": "customer_id",
    "Quantity": "quantity",
    "Price": "price",
    "Description": "description",
    "Country": "country",
    "InvoiceDate": "invoice_date",
}

PRIMARY_KEYS = {
    "dim_customer": "customer_id",
    "dim_product": "stock_code",
    "dim_invoice": "invoice_id",
    "fact_line": "line_id",
}
#: Buckets of stored tables; their number bounds the size of a bucket.
BUCKETS = 32
FOREIGN_KEYS = [
    ("dim_invoice", "customer_id", "dim_customer"),
    ("fact_line", "invoice_id", "dim_invoice"),
    ("fact_line", "stock_code", "dim_product"),
]
REQUIRED = {
    "dim_invoice": ["customer_id", "invoice_date"],
    "fact_line": ["invoice_id", "stock_code", "quantity", "price"],
}


def renamed(cleaned: DataFrame) -> DataFrame:
    return cleaned.withColumnsRenamed(RENAMES)


def most_frequent(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent non-null value per key, the lowest one on ties, NULL if all are null.

    Counting per (key, value) first keeps a hot key's rows spread over its values and
    folds them before the shuffle; the second step sees one row per pair.
    """
    pairs = df.groupBy(key, value).agg(F.count("*").alias("n"))
    rank = F.when(F.col(value).isNotNull(), F.struct((-F.col("n")).alias("order"), F.col(value).alias("value")))
    return pairs.groupBy(key).agg(F.min(rank).getField("value").alias(value))


def dim_customer(lines: DataFrame) -> DataFrame:
    return most_frequent(lines, "customer_id", "country")


def dim_product(lines: DataFrame) -> DataFrame:
    return most_frequent(lines, "stock_code", "description")


def dim_invoice(lines: DataFrame) -> DataFrame:
    """Customer of the earliest line (lowest id on ties) and earliest date per invoice."""
    pairs = lines.groupBy("invoice_id", "customer_id").agg(F.min("invoice_date").alias("invoice_date"))
    return pairs.groupBy("invoice_id").agg(
        F.min(F.struct("invoice_date", "customer_id")).alias("first")
    ).selectExpr("invoice_id", "first.customer_id AS customer_id", "first.invoice_date AS invoice_date")


def fact_line(lines: DataFrame) -> DataFrame:
    """Line grain with a surrogate key.

    The key is unique but not dense: numbering all lines from 1 would need a global
    order that nothing downstream uses.
    """
    return lines.select(
        F.monotonically_increasing_id().alias("line_id"),
        "invoice_id", "stock_code", "quantity", "price",
    )


def build_tables(cleaned: DataFrame) -> dict[str, DataFrame]:
    """The four tables, parents before children."""
    lines = renamed(cleaned)
    return {
        "dim_customer": dim_customer(lines),
        "dim_product": dim_product(lines),
        "dim_invoice": dim_invoice(lines),
        "fact_line": fact_line(lines),
    }


def write_tables(tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Store each table as parquet below ``folder`` and return scans of them."""
    scans = {}
    for name, df in tables.items():
        path = f"{folder}/{name}"
        save_table(df, path)
        scans[name] = df.sparkSession.read.parquet(path)
    return scans


def write_bucketed(tables: dict[str, DataFrame], folder: str, prefix: str, buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """Store lines and invoices in buckets of the invoice, the other tables plainly, and return scans of them.

    The tables of the two are registered as ``<prefix>_fact_line`` and ``<prefix>_dim_invoice``. An invoice that holds a large part of all
    lines would fill one bucket; such a log is served by ``lines_with_invoice`` on plain tables.
    """
    sorted_by = {name: tables[name] for name in ("fact_line", "dim_invoice")}
    scans = write_tables({name: df for name, df in tables.items() if name not in sorted_by}, folder)
    for name, df in sorted_by.items():
        scans[name] = save_bucketed(df, f"{prefix}_{name}", f"{folder}/{name}", "invoice_id", buckets)
    return scans


def bucketed_lines_with_invoice(fact: DataFrame, invoice: DataFrame) -> DataFrame:
    """Inner join at line grain of bucketed tables: buckets meet as they lie."""
    return fact.join(invoice.hint("merge"), "invoice_id").selectExpr("customer_id", "invoice_id", "invoice_date", "stock_code", "quantity * price AS amount")


def invoice_totals(fact: DataFrame, invoice: DataFrame) -> DataFrame:
    """The invoice view: customer, date and rounded total.

    Lines are summed per invoice before the join, so the join sees one row per invoice
    on both sides however many lines an invoice holds.
    """
    totals = fact.groupBy("invoice_id").agg(
        F.round(F.sum(F.col("quantity") * F.col("price")), 2).alias("invoice_total"))
    return invoice.join(totals, "invoice_id").select("invoice_id", "customer_id", "invoice_date", "invoice_total")


def lines_with_invoice(fact: DataFrame, invoice: DataFrame) -> DataFrame:
    """Inner join at line grain, with the computed amount.

    The number of lines per invoice decides how an invoice is served, so one that holds a
    large part of all lines does not end in one task.
    """
    sizes = fact.groupBy("invoice_id").agg(F.count("*").alias("n_lines"))
    sized = invoice.join(sizes, "invoice_id").select("invoice_id", "customer_id", "invoice_date", "n_lines")
    found = lookup(fact, sized, ["invoice_id"], "n_lines", "line_id").filter("customer_id IS NOT NULL")
    return found.selectExpr(
        "customer_id", "invoice_id", "invoice_date", "stock_code", "quantity * price AS amount")


def _orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows per key value that the parent lacks; keys are folded before the join."""
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(
        F.count("*").alias("n_rows"))
    return keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def foreign_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Each foreign key with its violating values and rows, zero where it holds."""
    checks = []
    for child, column, parent in FOREIGN_KEYS:
        orphans = _orphans(tables[child], column, tables[parent], PRIMARY_KEYS[parent])
        checks.append(orphans.agg(
            F.count("*").alias("n_keys"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        ).select(
            F.lit(child).alias("child"), F.lit(column).alias("key_column"), F.lit(parent).alias("parent"),
            "n_keys", "n_rows",
        ))
    return reduce(DataFrame.unionByName, checks)


def key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Repeated primary keys and NULLs in required columns, per table and column."""
    checks = []
    for name, key in PRIMARY_KEYS.items():
        df = tables[name]
        repeated = df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n")).agg(
            F.count_if((F.col("n") > 1) | F.col("key").isNull()).alias("n_violations"))
        checks.append(repeated.select(
            F.lit(name).alias("table_name"), F.lit(key).alias("column_name"),
            F.lit("unique").alias("rule"), "n_violations"))
        required = REQUIRED.get(name, [])
        if required:
            rules = F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.col(f"nulls_{c}").alias("n_violations"))
                for c in required
            ])
            nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in required])
            checks.append(nulls.select(F.explode(rules).alias("r")).select(
                F.lit(name).alias("table_name"), "r.column_name",
                F.lit("not null").alias("rule"), "r.n_violations"))
    return reduce(DataFrame.unionByName, checks)


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    sizes = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, sizes)
