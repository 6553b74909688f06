"""Multi-part load, header and type normalisation, structure of the raw log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.sources.storage import cached_parts, cached_table

RAW_SCHEMA = T.StructType([
    T.StructField("Invoice", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("Price", T.DecimalType(12, 2)),
    T.StructField("CustomerID", T.LongType()),
    T.StructField("Country", T.StringType()),
])

# header as exported -> type of the column after normalisation
RAW_TYPES = {field.name: field.dataType for field in RAW_SCHEMA.fields}


def normalise_headers(df: DataFrame) -> DataFrame:
    """Trim the column names and drop the spaces inside them."""
    return df.toDF(*[name.strip().replace(" ", "") for name in df.columns])


def normalise_types(df: DataFrame) -> DataFrame:
    """Dates to timestamps, ids with a trailing ``.0`` to integers, mixed columns to text.

    Values that cannot be read become NULL, so the missing-value profile sees them.
    """
    columns = []
    for name in df.columns:
        wanted = RAW_TYPES.get(name)
        column = F.col(name)
        if wanted is None or df.schema[name].dataType == wanted:
            columns.append(column)
        elif isinstance(wanted, T.LongType):
            columns.append(column.try_cast("decimal(20,0)").try_cast("bigint").alias(name))
        else:
            columns.append(column.try_cast(wanted).alias(name))
    return df.select(*columns)


def tag_part(df: DataFrame, name: str) -> DataFrame:
    """Remember which part a row came from."""
    return df.withColumn("SourceSheet", F.lit(name))


def stack_parts(parts: dict[str, DataFrame], tag: bool = True) -> DataFrame:
    """Union the parts by column name, tagged with the part's name if wanted."""
    frames = [
        tag_part(normalise_headers(part), name) if tag else normalise_headers(part)
        for name, part in parts.items()
    ]
    return normalise_types(reduce(DataFrame.unionByName, frames))


def read_parts(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", tag: bool = True) -> DataFrame:
    """Read one file or folder per part (CSV with headers, parquet, ORC, JSON) and stack them."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return stack_parts({name: reader.load(path) for name, path in paths.items()}, tag)


def raw_log(spark: SparkSession, cache_path: str, paths: dict[str, str], fmt: str = "parquet",
            force: bool = False) -> DataFrame:
    """The stacked raw log, built once and then read from its parquet cache."""
    return cached_table(spark, cache_path, lambda: read_parts(spark, paths, fmt), force)


def read_parts_at_once(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """All parts in a single scan, tagged by the path that a row's file lies under (the longest, if one part lies in another).

    For parts of one layout; parts whose headers differ go through ``read_parts``.
    """
    reader = spark.read.format(fmt).option("recursiveFileLookup", True)
    if fmt == "csv":
        reader = reader.option("header", True)
    # a path may come without its scheme, and a file's path comes with it
    under = {name: path.split("://")[-1].rstrip("/") for name, path in paths.items()}
    tag = F.lit(None).cast("string")
    for name, path in sorted(under.items(), key=lambda p: len(p[1])):
        tag = F.when(F.contains(F.col("_metadata.file_path"), F.lit(path + "/")) | F.endswith(F.col("_metadata.file_path"), F.lit(path)), name).otherwise(tag)
    return normalise_types(normalise_headers(reader.load(list(paths.values())).withColumn("SourceSheet", tag)))


def fresh_log(spark: SparkSession, cache_path: str, paths: dict[str, str], fmt: str = "parquet") -> tuple[DataFrame, list[str]]:
    """The stacked raw log from its parquet cache, and the parts that were built for it: those that are new or whose files changed."""
    return cached_parts(spark, cache_path, paths, lambda name, path: read_parts(spark, {name: path}, fmt, tag=False))


def split_parts(log: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    """Undo the stacking: one untagged frame per part."""
    return {
        name: log.filter(F.col("SourceSheet") == name).drop("SourceSheet")
        for name in names
    }


def rows_per_part(log: DataFrame) -> DataFrame:
    return log.groupBy("SourceSheet").agg(F.count("*").alias("n_rows"))


def shared_invoices(log: DataFrame, first: str, second: str) -> DataFrame:
    """Invoice ids that occur in both parts."""
    def keys(name: str) -> DataFrame:
        return log.filter(F.col("SourceSheet") == name).select("Invoice").distinct()

    return keys(first).intersect(keys(second))


def structure(log: DataFrame) -> DataFrame:
    """Rows, number of columns and date range, in one pass."""
    return log.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(log.columns)).cast("bigint").alias("n_columns"),
        F.date_format(F.min("InvoiceDate"), "yyyy-MM-dd HH:mm:ss").alias("first_date"),
        F.date_format(F.max("InvoiceDate"), "yyyy-MM-dd HH:mm:ss").alias("last_date"),
    )


def column_types(log: DataFrame) -> DataFrame:
    """Columns in order with their types and the number of values that are not NULL, in one pass."""
    counted = log.agg(*[F.count(f"`{f.name}`").alias(f"n{i}") for i, f in enumerate(log.schema.fields)])
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type"), F.col(f"n{i}").alias("n_values"))
        for i, f in enumerate(log.schema.fields)])
    return counted.select(F.explode(rows).alias("c")).select("c.*")
