"""Materialised tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a fresh local folder only in local mode."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="patronage-"))
    return context.getCheckpointDir()


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet and return a scan of it.

    Several actions follow on the same customer table (counts, split points, the
    final plan). The written table cuts the lineage, outlives lost executors and
    lets each of those actions read only the columns it needs.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite one table, optionally laid out by partition columns."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def cached_table(spark: SparkSession, path: str, build, force: bool = False) -> DataFrame:
    """The table at ``path``, built if it cannot be read or if ``force`` asks for it.

    What is stored is taken as it is; a caller whose source has changed passes ``force``.
    """
    if not force:
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            pass  # not there, or without a file that tells its schema
    save_table(build(), path)
    return spark.read.parquet(path)


def source_digest(spark: SparkSession, path: str) -> str:
    """What tells one state of a file or folder from another: its files' names, sizes and times, folded to one value."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    n, size, names = files.agg(F.count("*"), F.sum("length"), F.expr("bit_xor(xxhash64(path, length, modificationTime))")).first()
    return f"{n}-{size}-{names}"


def cached_parts(spark: SparkSession, folder: str, sources: dict[str, str], build, tag: str = "SourceSheet") -> tuple[DataFrame, list[str]]:
    """The stored table of all parts, and the names of those that had to be built.

    Each part is kept below ``folder`` beside a manifest of the source files it came from. A part whose source
    has changed, or that is new, is built again by ``build(name, path)``; the others are read as they are. A part that is no longer
    among the sources is not read. The manifest is written after the part, so a build that was cut off is repeated.
    """
    built = []
    for name, path in sources.items():
        digest = source_digest(spark, path)
        part, manifest = (f"{folder}/{kind}/{tag}={quote(name, safe='')}" for kind in ("data", "manifest"))
        try:
            known = spark.read.schema("digest string").parquet(manifest).first()
        except AnalysisException:
            known = None  # not built yet
        if known is None or known["digest"] != digest:
            built.append(name)
            build(name, path).write.mode("overwrite").parquet(part)
            spark.createDataFrame([(digest,)], "digest string").coalesce(1).write.mode("overwrite").parquet(manifest)
    paths = [f"{folder}/data/{tag}={quote(name, safe='')}" for name in sources]
    return spark.read.option("basePath", f"{folder}/data").parquet(*paths), built


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` as table ``name`` at ``path`` in buckets of ``key``, sorted inside, and return its scan.

    Tables in equally many buckets of a key are joined and grouped on it without an exchange. One task writes one bucket.
    """
    writer = df.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
