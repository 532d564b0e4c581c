"""How good the fitted models are: coherence of topics, likelihood and accuracy on held-out rows."""

from __future__ import annotations

import itertools
import math
from functools import reduce

from pyspark.ml.clustering import LDAModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sentiment import LABELS, SCORES, fit_sentiment, score_sentiment

# terms of all topics that travel to the tasks
MOST_TERMS = 1_000


def topic_coherence(terms: DataFrame, texts: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``(topic, n_terms, coherence)``: how often the terms of a topic stand in the same text.

    ``terms`` are the ``(topic, rank, term)`` of ``topic_terms``. For two terms, the
    better ranked one in n texts and both in m, the value is log((m + 1) / n); a topic
    has the mean over its pairs; pairs whose better term is in no text do not count. Each text is looked at once and gives at most the pairs of
    the listed terms, which add up map-side.
    """
    listed = terms.select("topic", "rank", "term").orderBy("topic", "rank").limit(MOST_TERMS + 1).collect()
    if len(listed) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms")
    spark = terms.sparkSession
    by_topic: dict[int, list] = {}
    for r in listed:
        by_topic.setdefault(r["topic"], []).append((r["rank"], r["term"]))
    words = F.array(*[F.lit(w) for w in sorted({r["term"] for r in listed})]).cast("array<string>")
    held = texts.select(F.array_intersect(tokens, words).alias("_held")).filter(F.size("_held") > 0)

    def pairs_of(topic: int, own: list) -> Column:
        """Each term that a text holds with itself, which counts its texts, and with those ranked below."""
        terms = F.array(*[F.struct(F.lit(rank).alias("rank"), F.lit(term).alias("term")) for rank, term in own])
        hits = F.transform(F.filter(terms, lambda t: F.array_contains("_held", t["term"])), lambda t: t["rank"])
        return F.flatten(
            F.transform(
                hits,
                lambda a: F.transform(
                    F.filter(hits, lambda b: b >= a),
                    lambda b: F.struct(F.lit(topic).alias("topic"), a.alias("first"), b.alias("second")),
                ),
            )
        )

    none = F.array().cast("array<struct<topic:int,first:int,second:int>>")
    every = F.concat(none, *[pairs_of(topic, own) for topic, own in by_topic.items()])
    counts = held.select(F.inline_outer(every)).filter(F.col("topic").isNotNull())
    counts = counts.groupBy("topic", "first", "second").agg(F.count("*").alias("n"))
    # topics x terms x terms / 2 rows at most; the rest is arithmetic on the listed terms
    found = {(r["topic"], r["first"], r["second"]): r["n"] for r in counts.collect()}
    rows = []
    for topic, own in by_topic.items():
        ranks = [rank for rank, _ in own]
        values = [
            math.log((found.get((topic, a, b), 0) + 1) / found[topic, a, a])
            for a, b in itertools.combinations(ranks, 2)
            if (topic, a, a) in found
        ]
        rows.append((topic, len(own), sum(values) / len(values) if values else None))
    return spark.createDataFrame(rows, "topic int, n_terms int, coherence double")


def held_out(key: str, folds: int, fold: int) -> Column:
    """Whether a row is in the given one of ``folds`` parts, by a hash of its key."""
    return F.pmod(F.xxhash64(key), F.lit(folds)) == fold


def perplexity(model: LDAModel, features: DataFrame) -> float:
    """Bound on the log perplexity per token of texts that the model has not seen; smaller is better."""
    return model.logPerplexity(features.select("features"))


def cross_validated(labelled: DataFrame, key: str, folds: int = 3, **fit) -> DataFrame:
    """``(fold, n, n_right, n_most_common)``: each part scored by a model of the others.

    ``n_most_common`` is what the most frequent label of the other parts gets right.
    """
    parts = []
    for fold in range(folds):
        there = held_out(key, folds, fold)
        train, test = labelled.filter(~there), labelled.filter(there)
        model = fit_sentiment(train, **fit)
        counts = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
        common = max(sorted(counts), key=counts.get)  # of at most three labels
        scored = score_sentiment(model, test)
        names = {name.split("_")[1]: F.col(name) for name in SCORES}
        best = F.greatest(*names.values())
        label = F.coalesce(*[F.when(names[x] == best, F.lit(x)) for x in LABELS])
        right = scored.withColumn("_right", label == F.col("label"))
        parts.append(
            right.agg(
                F.lit(fold).alias("fold"),
                F.count("*").alias("n"),
                F.count_if("_right").alias("n_right"),
                F.count_if(F.col("label") == common).alias("n_most_common"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
