"""From raw documents to packed training sequences: five stages, each written before the next.

Every stage takes (spark, docs, sf_dir) with docs in the columns of the documents table, and all but
the last return these columns. ``labels`` is read from sf_dir.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.jaccard_join import near_copies
from stratamart.llm.line_dedup import remove_repeated_lines
from stratamart.llm.marks import keyed, with_marks
from stratamart.llm.mixing import Mix, domains_of, rate_documents, times_used
from stratamart.llm.packing import pack
from stratamart.llm.quality_cotrain import score_quality
from stratamart.llm.queries import table
from stratamart.llm.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: The wanted shares of tokens by language.
LANGUAGES = {"en": 0.52, "de": 0.18, "fr": 0.18, "es": 0.12}


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of both views accepts; rejected ones go."""
    scored = score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that nearly repeat an earlier one.

    A document all of whose words go is dropped; n_chars follows the text where lines went.
    """
    kept = remove_repeated_lines(docs, carry=("lang", "source", "n_chars"))
    left = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    changed = F.col("n_removed") > 0
    kept = kept.where(~changed | left)
    size = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", size).select(*COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id.

    Repeated rows of that doc_id become one. Rows without doc_id or words are in no group and stay.
    """
    groups = near_copies(docs).where("doc_id is not null and n_shingles > 0")
    fates = groups.groupBy("doc_id").agg(
        F.min("component_id").alias("head"), F.count(F.lit(1)).alias("rows")
    )
    fate = F.when(F.col("head") != F.col("doc_id"), "goes").when(F.col("rows") > 1, "once")
    fates = fates.select("doc_id", fate.alias("fate")).where("fate is not null")
    marked = with_marks(docs.select(*COLUMNS), stage(fates, "fates"), "fate", on=("doc_id",))
    plain = marked.where("fate is null").select(*COLUMNS)
    rest = F.min(F.struct(*COLUMNS[1:])).alias("row")
    once = marked.where("fate = 'once'").groupBy("doc_id").agg(rest).select("doc_id", "row.*")
    return plain.union(once.select(*COLUMNS))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Languages brought to their target shares by repeating documents; none is dropped.

    A row comes floor(rate) times, and once more with the probability of the fraction.
    """
    domains = domains_of(docs, table(spark, sf_dir, "labels"), languages_only=True)
    rated = rate_documents(docs, domains, Mix(LANGUAGES, tokens="most", least=1.0))
    times = rated.where("doc_id is not null and n_tokens > 0").groupBy("doc_id", "rh")
    times = times.agg(F.max("rate").alias("rate"))
    times = times.select("doc_id", "rh", times_used(F.col("rate"), "doc_id", "rh").alias("times"))
    times = stage(times.where("times <> 1"), "times")
    marked = with_marks(keyed(docs.select(*COLUMNS)), times, "times")
    copies = F.sequence(F.lit(1), F.coalesce("times", F.lit(1)))
    return marked.withColumn("copy", F.explode(copies)).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences with their ids."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_words=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", jaccard_join),
    ("mixing_to_targets", mix_to_targets),
    ("packing", packing),
]

#: SQL cannot express the trained classifiers; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
