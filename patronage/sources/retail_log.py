"""A raw retail transaction log derived from order, line, customer and part tables.

The base tables hold no nulls, cancellations, free items or repeated lines, so the
log injects them by arithmetic on the keys. Every line of every order is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_COLUMNS = [
    "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate",
    "Price", "CustomerID", "Country", "SourceSheet",
]

SHEET_BORDER = "1998-04-01 00:00:00"
GUEST_OFFSET = 10_000_000_000


# explicit schemas: no footer is read to infer them, and only these columns are scanned
BASE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_returnflag STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
    "part": "p_partkey BIGINT, p_name STRING",
}


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def transaction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, shaped like a two-part retail export.

    Buyers join to orders before lines do, so lines are moved once, by order. The merge
    hint keeps the planner from broadcasting a small line file, its largest table.
    """
    base = {name: read_base(spark, sf_dir, name) for name in BASE_SCHEMAS}
    buyers = base["customer"].join(base["nation"], F.expr("c_nationkey = n_nationkey"))
    sales = base["orders"].join(buyers, F.expr("o_custkey = c_custkey")).select(
        "o_orderkey", "o_custkey", "o_orderdate", "n_name")
    joined = (
        base["lineitem"]
        .join(sales.hint("merge"), F.expr("l_orderkey = o_orderkey"))
        .join(base["part"], F.expr("l_partkey = p_partkey"))
    )
    cancelled = "l_returnflag = 'R' AND o_orderkey % 10 = 0"
    early = f"o_orderdate < TIMESTAMP_NTZ '{SHEET_BORDER}'"
    return joined.selectExpr(
        f"IF({cancelled}, concat('C', CAST(o_orderkey AS STRING)), CAST(o_orderkey AS STRING)) AS Invoice",
        """CASE WHEN l_partkey % 50 = 0 THEN 'POST'
                WHEN l_partkey % 3 = 0 THEN concat(lpad(CAST(l_partkey AS STRING), 5, '0'), 'A')
                ELSE lpad(CAST(l_partkey AS STRING), 5, '0') END AS StockCode""",
        """CASE WHEN l_partkey % 40 = 0 THEN NULL
                WHEN o_orderkey % 43 = 0 THEN 'check'
                WHEN o_orderkey % 47 = 0 THEN 'damaged'
                WHEN o_orderkey % 53 = 0 THEN '?'
                ELSE p_name END AS Description""",
        f"IF({cancelled}, -CAST(l_quantity AS INT), CAST(l_quantity AS INT)) AS Quantity",
        "o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT)) AS InvoiceDate",
        "IF(l_partkey % 97 = 0, CAST(0 AS DECIMAL(12,2)), CAST(l_extendedprice AS DECIMAL(12,2))) AS Price",
        f"""CASE WHEN o_orderkey % 5 = 4 THEN NULL
                 WHEN o_custkey % 16 = 1 THEN o_orderkey + {GUEST_OFFSET}L
                 ELSE o_custkey END AS CustomerID""",
        "IF(o_orderkey % 7 = 0, 'Unspecified', n_name) AS Country",
        f"""explode(CASE WHEN o_orderkey % 30 = 0 AND {early} THEN array('sheet1', 'sheet1')
                         WHEN o_orderkey % 30 = 0 THEN array('sheet2', 'sheet2')
                         WHEN o_orderkey % 36 = 0 THEN array('sheet1', 'sheet2')
                         WHEN {early} THEN array('sheet1')
                         ELSE array('sheet2') END) AS SourceSheet""",
    )
