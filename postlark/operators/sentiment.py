"""Sentiment scoring and its statistics.

The scorer is a Spark ML classifier trained on labelled posts and applied in bulk.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, tokenize
from ..functions.topics import strict_topic_index, topic_columns
from ..functions.values import ratio, round_half_even
from ..schema import TOPICS
from .graph import Graph, posted_text

# Class order of the scorer.
LABELS = ("negative", "neutral", "positive")
SCORES = ("sa_positive_score", "sa_neutral_score", "sa_negative_score")
FEATURES = 1 << 16


def _with_tokens(df: DataFrame, cleaned: bool = False) -> DataFrame:
    """Tokens of the cleaned text, in training as in scoring."""
    text = F.col("text") if cleaned else clean_text(F.col("text"), "sentiment")
    return df.withColumn("_tokens", tokenize(text))


def fit_sentiment(
    labelled: DataFrame, max_iter: int = 20, reg_param: float = 0.01
) -> PipelineModel:
    """Train on ``(text, label)`` with the labels negative, neutral and positive.

    The texts are read once: every later pass over them reads their kept term counts.
    """
    index = F.array_position(F.array(*[F.lit(x) for x in LABELS]), F.col("label")) - 1
    training = _with_tokens(labelled.select("text", index.cast("double").alias("_class")))
    counting = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=FEATURES)
    weighting = IDF(inputCol="_tf", outputCol="_features")
    classifier = LogisticRegression(
        featuresCol="_features",
        labelCol="_class",
        probabilityCol="_probability",
        rawPredictionCol="_raw",
        predictionCol="_prediction",
        family="multinomial",
        maxIter=max_iter,
        regParam=reg_param,
    )
    counted = counting.transform(training).select("_tf", "_class").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weights = weighting.fit(counted)
        fitted = classifier.fit(weights.transform(counted))
    finally:
        counted.unpersist()
    return PipelineModel(stages=[counting, weights, fitted])


def score_sentiment(model: PipelineModel, df: DataFrame, cleaned: bool = False) -> DataFrame:
    """Add the three scores, softmax probabilities with four decimals. ``cleaned`` texts are taken as they are."""
    scored = model.transform(_with_tokens(df, cleaned))
    values = vector_to_array(F.col("_probability"))
    return scored.select(
        *df.columns,
        *[
            round_half_even(values.getItem(LABELS.index(name.split("_")[1])), 4).alias(name)
            for name in SCORES
        ],
    )


def needs_translation(lang: Column, text: Column) -> Column:
    """Anything but English or undetermined, and not empty. A missing language counts."""
    foreign = ~lang.eqNullSafe("en") & ~lang.eqNullSafe("und")
    return F.coalesce(foreign & (text != ""), F.lit(False))


def apply_translations(df: DataFrame, translations: DataFrame) -> DataFrame:
    """Replace the text of posts that need it by their supplied translation, if there is one."""
    supplied = translations.groupBy("tweetid").agg(F.min("translation").alias("_translation"))
    routed = F.when(needs_translation(F.col("lang"), F.col("text")), F.col("_translation"))
    return (
        df.join(supplied, "tweetid", "left")
        .withColumn("text", F.coalesce(routed, F.col("text")))
        .select(*df.columns)
    )


def attach_sentiment(tweets: DataFrame, scores: DataFrame) -> DataFrame:
    """Write scores to the matching posts; the others keep what they have."""
    written = scores.select(
        "tweetid", F.struct(*SCORES).alias("_scores"), F.lit(True).alias("_matched")
    )
    joined = tweets.join(written, "tweetid", "left")
    new = {}
    for name in SCORES:
        old = F.col(name) if name in tweets.columns else F.lit(None).cast("double")
        new[name] = F.when(F.col("_matched"), F.col(f"_scores.{name}")).otherwise(old)
    return joined.withColumns(new).drop("_scores", "_matched")


def sentiment_series(
    user_tweets: DataFrame, k: int = TOPICS, variant: str = "correct", ordered: bool = True
) -> DataFrame:
    """Scores over time per user and strictly dominant topic; all topics in one pass.

    ``variant="literal"`` drops what the source study's topic-3 rule dropped.
    """
    topic = strict_topic_index([F.col(c) for c in topic_columns(k)], variant)
    series = (
        user_tweets.withColumn("topic", topic)
        .filter(F.col("topic").isNotNull())
        .select("userid", "topic", "date", "tweetid", *SCORES)
    )
    return series.orderBy("userid", "topic", "date", "tweetid") if ordered else series


def sentiment_summary(series: DataFrame) -> DataFrame:
    """Percent and mean per user and topic from one aggregate.

    The sum skips missing scores but the divisor is all rows, so an unscored post
    counts as zero.
    """
    sums = series.groupBy("userid", "topic").agg(
        F.count("*").alias("n_tweets"), *[F.sum(c).alias(c) for c in SCORES]
    )
    measures = []
    for name in SCORES:
        mean = ratio(F.coalesce(F.col(name), F.lit(0.0)), F.col("n_tweets"))
        label = name.split("_")[1]
        measures.append(round_half_even(mean * 100, 2).alias(f"{label}_percent"))
        measures.append(round_half_even(mean, 2).alias(f"{label}_mean"))
    return sums.select("userid", "topic", "n_tweets", *measures)


def sentiment_percent(series: DataFrame) -> DataFrame:
    names = [f"{c.split('_')[1]}_percent" for c in SCORES]
    return sentiment_summary(series).select("userid", "topic", *names)


def sentiment_mean(series: DataFrame) -> DataFrame:
    names = [f"{c.split('_')[1]}_mean" for c in SCORES]
    return sentiment_summary(series).select("userid", "topic", *names)


def prepare_text(
    texts: DataFrame, translations: DataFrame | None = None, emoji: str = "intended"
) -> DataFrame:
    """Clean the posted texts, then swap in translations, which are cleaned too."""
    cleaned = texts.withColumn("text", clean_text(F.col("text"), "sentiment", emoji))
    if translations is None:
        return cleaned
    supplied = translations.withColumn("translation", clean_text(F.col("translation"), "sentiment", emoji))
    return apply_translations(cleaned, supplied)


def score_posts(
    graph: Graph, model: PipelineModel, translations: DataFrame | None = None
) -> DataFrame:
    """``(tweetid, scores)``, one row per posted post.

    A post with several known authors goes by the language of the one with the smallest id.
    """
    known = graph.posts.join(graph.users.select("userid"), "userid", "left_semi")
    first = known.groupBy("tweetid").agg(F.min("userid").alias("userid"))
    texts = prepare_text(posted_text(replace(graph, posts=first)), translations)
    return score_sentiment(model, texts, cleaned=True).select("tweetid", *SCORES)
