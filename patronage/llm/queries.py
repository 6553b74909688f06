"""Queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from patronage.llm import alignment, bitpack, bpecount, chatformat, divergence, jaccard, languages, packing, passages, pieces, secretscan, spelling, tiling
from patronage.llm.oracle import ORACLES  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD_VOCABULARY, END_ID = 49_408, 1
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Documents that language identification does not learn from.
LANGUAGE_HELD_OUT = "pmod(crc32(CAST(doc_id AS STRING)), 4) = 2"


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_ngram_jaccard_join(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secretscan.secrets(docs, secretscan.train(secretscan.sample(docs)))


@query
def op4_sentencepiece(spark, sf_dir):
    return pieces.encoded(table(spark, sf_dir, "documents"), PIECE_MODEL)


@query
def op5_packed_ids(spark, sf_dir):
    return bitpack.read(bitpack.write(table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID, WORD_VOCABULARY))


@query
def op6_vector_packing(spark, sf_dir):
    return packing.assign(table(spark, sf_dir, "documents"))


@query
def op7_token_counts(spark, sf_dir):
    return bpecount.token_counts(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


@query
def op8_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return passages.scores(docs, passages.fit(docs, table(spark, sf_dir, "labels")))


@query
def op10_decontamination(spark, sf_dir):
    return tiling.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query
def op1_distribution_divergence(spark, sf_dir):
    return divergence.judged(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


@query
def op9_chat_windows(spark, sf_dir):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(1).selectExpr("-1L AS conv_id", f"explode(array(struct(0L AS turn, 'user' AS role, '{said}' AS text), struct(1L AS turn, 'assistant' AS role, '{said}' AS text))) AS t")
    return chatformat.digests(chatformat.windows(rows.union(more.select("conv_id", "t.*"))))


@query
def op11_language_filters(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = languages.predicted(docs, languages.fit(docs, LANGUAGE_HELD_OUT))
    return found.selectExpr("doc_id", f"coalesce({LANGUAGE_HELD_OUT}, false) AS held_out", "lang_pred", "score")


@query
def op12_token_alignment(spark, sf_dir):
    return alignment.aligned(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, PIECE_MODEL)


@query
def op13_spelling_variants(spark, sf_dir):
    return spelling.variant_groups(table(spark, sf_dir, "documents"))
