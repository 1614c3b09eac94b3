"""The registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitmark.llm import ann, conversation_repair, embedding_dedup, html_text, language_id, licenses, near_duplicates, packing, periodic_runs, quality, secrets, sentence_pieces, token_counts
from pitmark.llm.common import fold, small_batches, table
from pitmark.llm.oracles import ORACLES  # noqa: F401


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), where=fold("id", 5) != 0)
    return quality.score(docs, model, held_out=fold("doc_id", 5) == 0)


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), factor=0.95)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(fold("doc_id", 4) != 2))
    return language_id.identify(docs, model, held_out=fold("doc_id", 4) == 2)


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), size=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    both = sentence_pieces.round_trip(table(spark, sf_dir, "documents"))
    said = [c for way in ("path", "merge") for c in ((F.octet_length(f"{way}_ids") / 4).cast("long").alias(f"{way}_pieces"), F.crc32(f"{way}_ids").alias(f"{way}_crc32"), f"{way}_same")]
    return both.select("doc_id", *said)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.secret_spans(table(spark, sf_dir, "documents")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after runs of digits and of marks are edited out of the texts."""
    small_batches(spark)
    return token_counts.count_edited(table(spark, sf_dir, "documents"), "[0-9]{4,}|[%&$#*|]+", "")


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_duplicates(table(spark, sf_dir, "embeddings"))


def planted_period(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order in which the contract reads a text of n words: every tenth id repeats its words from some place on."""
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words, most of them planted; digests of all runs and of the text without their repetitions."""
    small_batches(spark)
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), reading=planted_period)
    # runs are by start, then period, so the first of the greatest exponents stays
    best = F.expr("aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), runs[0], (a, x) -> if(x.length * a.period > a.length * x.period, x, a))")
    lines = F.array_join(F.transform("runs", lambda x: F.concat(x.start, F.lit(","), x.length, F.lit(","), x.period, F.lit("\n"))), "")
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.encode(lines, "utf-8"), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed", "utf-8"), 256).alias("collapsed_sha256"), "n_words",
    )


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.license_spans(table(spark, sf_dir, "documents")))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with the faults of the contract; dropped rows are marked ``gone``. Nulls in the key, role and text are one space."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), (F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20).alias("fault"))
    is_ = lambda k: F.col("fault") == k
    text = F.when(is_(1), "").when(is_(2), F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(is_(4), "user").otherwise(F.col("role")).alias("role"), text.alias("text"), is_(0).alias("gone"), "fault")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(0), is_(3).cast("int")))).drop("copy", "fault")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return conversation_repair.repair_report(damaged(table(spark, sf_dir, "conversations")), gone=F.col("gone"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_nearest, op3_html_text, op4_language_id, op5_minhash, op6_sentence_pieces, op7_secrets, op8_packing, op9_token_counts, op10_embedding_dedup, op11_periodic_runs, op12_licenses, op13_conversation_repair)}
