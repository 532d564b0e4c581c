"""Batch jobs from raw posts to stored tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDAModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.literals import parse_literals
from ..functions.text import clean_text, tokenize
from ..functions.topics import vector_columns
from ..operators import cohort as co
from ..operators import corpus as cp
from ..operators import topics as tp
from ..operators.graph import Graph
from ..operators.sentiment import attach_sentiment, score_posts
from ..schema import EXPANDED_URLS, STRINGS, TOPICS
from ..session import checkpointed
from ..sources.readers import read_tweets
from ..sources.writers import write_table


def parse_posts(raw: DataFrame, on_bad: str = "null", others: str = "bad") -> DataFrame:
    """Raw posts with their four list columns parsed, in the JVM alone unless ``others`` is ``python``."""
    lists = {"hashtag": STRINGS, "mentionsn": STRINGS, "mentionid": STRINGS}
    return parse_literals(raw, {**lists, "urls_list": EXPANDED_URLS}, on_bad, others)


def ingest_posts(spark: SparkSession, csv_path: str, path: str, on_bad: str = "null") -> DataFrame:
    """Collector CSV to parsed parquet, once. Every other job reads the parquet."""
    write_table(parse_posts(read_tweets(spark, csv_path), on_bad, "python"), path)
    return spark.read.parquet(path)


@dataclass(frozen=True)
class TopicResult:
    """``left_out`` terms were too rare for the vocabulary."""

    topics: DataFrame
    terms: DataFrame
    vocabulary: CountVectorizerModel
    model: LDAModel
    left_out: int


def topic_job(
    tweets: DataFrame,
    stopwords: DataFrame,
    k: int = TOPICS,
    max_iter: int = tp.MAX_ITERATIONS,
    seed: int = 42,
    languages: list[str] | None = None,
    path: str | None = None,
    tokens: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> TopicResult:
    """Clean, tokenise, fit topics, score every post; write the scores if ``path`` is given.

    The tokens are stored once, and so are the vectors: the fit and the scores read them.
    ``tokens`` (``tweetid, tokens``) and their ``counts`` are stored ones of an earlier step for the same tweets.
    """
    if languages is not None:
        stopwords = stopwords.filter(F.col("lang").isin(list(languages)))
    if tokens is None:
        own = tokenize(clean_text(F.col("text"), "topics"))
        tokens = checkpointed(tweets.select("tweetid", own.alias("tokens")))
    if counts is None:
        counts = checkpointed(tp.term_counts(tokens))
    vocabulary = tp.fit_vocabulary(counts, stopwords)
    features = checkpointed(vocabulary.model.transform(tokens).select("tweetid", "features"))
    model = tp.fit_topics(features, k, max_iter, seed)
    topics = tp.score_topics(model, features)
    if path is not None:
        write_table(topics, path)
        topics = tweets.sparkSession.read.parquet(path)
    terms = tp.topic_terms(model, vocabulary.model)
    return TopicResult(topics, terms, vocabulary.model, model, vocabulary.left_out)


def topic_probabilities(topics: DataFrame, k: int = TOPICS) -> DataFrame:
    """Stored topic vectors as one double column per topic."""
    return topics.select("tweetid", *vector_columns("topicDistribution", k))


def build_cohort(
    tweets: DataFrame, users: DataFrame, topics: DataFrame, ranking: DataFrame
) -> DataFrame:
    """Posts of the ranked users with counts, profile and topics; ``ranking`` is from ``rank_users``."""
    scored = co.with_topics(co.restrict_to(tweets, ranking), topics)
    return co.normalise_dates(co.enrich_profiles(scored, users))


def sentiment_job(
    graph: Graph, model: PipelineModel, translations: DataFrame | None = None
) -> Graph:
    """Score every posted post and write the scores to the post nodes."""
    scores = score_posts(graph, model, translations)
    return replace(graph, tweets=attach_sentiment(graph.tweets, scores))


def summary_job(texts: DataFrame, keys, order, max_words: int = cp.SUMMARY_WORDS) -> DataFrame:
    """Gate each corpus to a bounded text, then summarise it: ``keys, n_chars, sampled, text, summary, n_words``."""
    return cp.extractive_summary(cp.gate(texts, keys, order), keys, max_words)


def topic_summaries(graph: Graph, max_words: int = cp.SUMMARY_WORDS) -> DataFrame:
    return summary_job(cp.topic_texts(graph), cp.TOPIC_KEYS, cp.TOPIC_ORDER, max_words)


def moderated_summaries(
    shares: DataFrame, metadata: DataFrame, max_words: int = cp.SUMMARY_WORDS
) -> DataFrame:
    """Summaries of every user's posts about videos that are gone."""
    texts = cp.moderated_texts(shares, metadata)
    return summary_job(texts, cp.VIDEO_KEYS, cp.VIDEO_ORDER, max_words)
