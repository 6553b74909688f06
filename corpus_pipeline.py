"""From raw documents to token ids, in five stages; each is written as Parquet and read again as the next one's input.

In every stage null ids stay null, an empty table stays empty, and other columns are carried along whatever their names (the last stage leaves
them out). A null or empty text is judged as an empty passage by the first stage; a later one finds no copies, benchmark items or secrets in it and gives it no ids.
Rows that repeat an id: those whose id stays all stay, those whose id goes as a near copy all go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from patronage.llm import jaccard, passages, pieces, queries, secretscan, tiling
from patronage.sources.storage import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is fitted on the labels of the documents at hand."""
    return passages.accepted(docs, passages.fit(docs, queries.table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return tiling.decontaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in their texts."""
    return secretscan.redacted(docs, secretscan.train(secretscan.sample(docs)))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    return pieces.encoded(docs, queries.PIECE_MODEL)


STAGES = [
    ("quality_classifier", quality),
    ("near_duplicates", near_copies),
    ("decontamination", decontamination),
    ("secret_scan", secrets),
    ("sentencepiece", token_ids),
]

#: SQL can express neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
