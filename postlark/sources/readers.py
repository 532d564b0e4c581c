"""Typed scans. Files with newlines in quotes are read block by block (``records``)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schema
from .records import read_multiline_csv

# The five stopword languages and their files.
STOPWORD_FILES = {
    "en": "english_stopwords",
    "de": "deutsch_stopwords",
    "fr": "french_stopwords",
    "pt": "portuguese_stopwords",
    "it": "italian_stopwords",
}


def _read_csv(spark: SparkSession, path: str, wanted: StructType, **options) -> DataFrame:
    """The columns of ``wanted`` by header name; others may stand among them in any order.

    A missing column is an error, and so is a file whose header differs from the first one's.
    """
    names = spark.read.csv(path, header=True, **options).columns
    kinds = {f.name.lower(): f for f in wanted}
    missing = sorted(kinds.keys() - {n.lower() for n in names})
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    found = StructType([kinds.get(n.lower(), StructField(n, StringType())) for n in names])
    if options.pop("multiLine", False):
        return read_multiline_csv(spark, path, found, options["sep"], options["quote"]).select(*wanted.names)
    rows = spark.read.schema(found).csv(path, header=True, enforceSchema=False, **options)
    return rows.select(*wanted.names)


def read_tweets(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schema.TWEETS, sep=",", multiLine=True, quote='"', escape='"')


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, schema.USERS, sep=",")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_translations(spark: SparkSession, path: str) -> DataFrame:
    """Supplied translations, one per post."""
    return spark.read.schema(schema.TRANSLATIONS).parquet(path)


def read_video_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Supplied video metadata as delivered; ``operators.video`` types it."""
    return _read_csv(
        spark, path, schema.RAW_VIDEO_METADATA, sep=",", multiLine=True, quote='"', escape='"'
    )


def read_stopwords(
    spark: SparkSession, path: str, languages: Sequence[str] = tuple(STOPWORD_FILES)
) -> DataFrame:
    """``(lang, word)`` from one file per language, one word per line."""
    parts = [
        spark.read.text(f"{path}/{STOPWORD_FILES[lang]}").select(
            F.lit(lang).alias("lang"), F.col("value").alias("word")
        )
        for lang in languages
    ]
    return reduce(DataFrame.unionByName, parts)
