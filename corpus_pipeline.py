"""The corpus pipeline: language, near-duplicates, benchmark leaks, secrets, pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlark.llm import decontaminate, language, pieces, secret_scan, simhash
from postlark.llm.common import folds, fresh, id_and_text, prepared, shared_folder
from postlark.llm.queries import PIECE_MODEL


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without a letter, or of no clear language, go."""
    prepared(spark)
    model = language.train_language(docs.filter(folds(F.col("doc_id"), 3) != 1))
    lang = fresh("found_lang", docs.columns)
    score = fresh("found_score", docs.columns)
    found = language.identify_language(docs, model, lang_as=lang, score_as=score)
    return found.filter(language.accepted(F.col(lang), F.col(score))).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each SimHash component."""
    prepared(spark)
    return simhash.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepared(spark)
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets replaced and ``n_chars`` counted anew."""
    prepared(spark)
    masked = secret_scan.mask_live(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, piece ids with the end id, and their number."""
    prepared(spark)
    encoded = pieces.encode_pieces(id_and_text(docs), public_tokenizers.path(PIECE_MODEL))
    return encoded.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("language", detect_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("pieces", encode_pieces),
]

# learned scores, XXH64 and a tokenizer: SQL cannot express the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is stored in the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
