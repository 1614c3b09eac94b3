"""From raw documents to packed sequences: five stages, each written and read again.

Rows with odd values have a place in every stage: a null or empty text has no
language and goes in the first one; a null id or language doesn't matter there;
rows that repeat an id are judged each by its own text, and of those whose
texts are near one another one stays. Empty tables go through. All stages but
the last keep the columns of their input, with whatever names these have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitmark.llm import language_id, near_duplicates, packing, quality, secrets
from pitmark.llm.common import small_batches, table
from pitmark.operators.scratch import materialise


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is found; texts that are null or without a letter go. Null languages teach nothing."""
    small_batches(spark)
    return language_id.keep_identified(docs, language_id.fit(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the classifier, trained on their labels, doesn't reject. A null text is judged as an empty one; without labels or text every score is 0.5 and all stay."""
    small_batches(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (five words, 0.8), the one with the smallest id, and one row of it; texts without words and rows without an id stay."""
    small_batches(spark)
    return near_duplicates.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Overwrite credentials that few owners have; n_chars follows the text. Every row stays; a null source or language is one owner or part of its own."""
    text = secrets.redact(docs, secrets.secret_spans(docs))
    return text.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else text


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens; a null text is one closing id."""
    small_batches(spark)
    pieces = packing.pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near duplicates", one_of_each),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: The models and the tokenizer can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
