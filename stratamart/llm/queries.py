"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm import embedding_dedup
from stratamart.llm.host_rules import judge_by_host
from stratamart.llm.jaccard_join import near_copies
from stratamart.llm.language_id import identify_languages
from stratamart.llm.line_dedup import remove_repeated_lines
from stratamart.llm.mixing import Mix, domains_of, rate_documents
from stratamart.llm.nn_descent import nearest
from stratamart.llm.packing import pack
from stratamart.llm.phrases import collocations
from stratamart.llm.quality_cotrain import score_quality
from stratamart.llm.secret_scan import find_secrets, secret_digests
from stratamart.llm.spelling import spelling_variants
from stratamart.llm.substring_dedup import remove_repeated_passages
from stratamart.session import tune

TOKENIZER_FILE = public_tokenizers.path("word_bpe_49k.json")
#: The wanted shares of tokens by domain.
TARGETS = {"en": 0.45, "de": 0.19, "fr": 0.19, "es": 0.14, "junk": 0.02, "toxic": 0.01}

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus; few rows per Arrow batch, since texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_copies(table(spark, sf_dir, "embeddings"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(find_secrets(table(spark, sf_dir, "documents")))


def op4_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    domains = domains_of(docs, table(spark, sf_dir, "labels"))
    rated = rate_documents(docs, domains, Mix(TARGETS))
    return rated.select("doc_id", "n_tokens", "domain", "chance", "rate")


def op5_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    scored = score_quality(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", "text_score", "meta_score", "score", "kept")


def op6_string_kernel_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_passages(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), TOKENIZER_FILE)
    crc32 = F.crc32("ids").alias("ids_crc32")
    rest = ["doc_tokens", "sequence_id", "offset"]
    return pieces.select("doc_id", "start", "length", crc32, *rest)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


def op10_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_by_host(table(spark, sf_dir, "documents"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_nn_descent_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def queries() -> dict[str, Query]:
    found = (
        op1_embedding_near_dedup,
        op2_line_dedup,
        op3_secret_scan,
        op4_soft_membership_mixing,
        op5_quality_cotraining,
        op6_string_kernel_language_id,
        op7_substring_dedup,
        op8_sum_of_squares_packing,
        op9_ngram_jaccard_join,
        op10_host_quality_rules,
        op11_phrase_collocations,
        op12_spelling_variants,
        op13_nn_descent_search,
    )
    return {f.__name__: f for f in found}
