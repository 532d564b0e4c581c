"""Rules over topic probabilities and score vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import TOPICS

# The five topic labels of the source study, by topic index.
TOPIC_LABELS = (
    "Presidenza di Trump",
    "Campagna presidenziale",
    "Confronto elettorale",
    "Impatto delle elezioni",
    "Caso Georgia",
)


def topic_columns(k: int = TOPICS) -> list[str]:
    return [f"topic_{i}_prob" for i in range(k)]


def probabilities(k: int = TOPICS) -> Column:
    return F.array(*topic_columns(k))


def strict_topic(probs: Sequence[Column], k: int, variant: str = "correct") -> Column:
    """True where topic ``k`` beats every other topic; a tie belongs to none.

    ``variant="literal"`` keeps a slip of the source study in topic 3: it compares
    topic 2, not topic 3, with topic 0, which loses some true matches.
    """
    if variant not in ("correct", "literal"):
        raise ValueError(f"unknown variant {variant!r}")
    wins = F.lit(True)
    for other in range(len(probs)):
        if other == k:
            continue
        left = probs[2] if variant == "literal" and k == 3 and other == 0 else probs[k]
        wins = wins & (left > probs[other])
    return wins


def strict_topic_index(probs: Sequence[Column], variant: str = "correct") -> Column:
    """Index of the strictly dominant topic, or null. At most one topic qualifies.

    Same rule as ``strict_topic`` for all topics in one go: the maximum, where it
    occurs once and no probability is missing.
    """
    if variant not in ("correct", "literal"):
        raise ValueError(f"unknown variant {variant!r}")
    values = F.array(*probs)
    ranked = F.sort_array(values, asc=False)
    alone = (F.get(ranked, F.lit(0)) > F.get(ranked, F.lit(1))) & F.get(
        ranked, F.lit(len(probs) - 1)
    ).isNotNull()
    index = argmax_topic(values)
    if variant == "literal":
        alone = alone & ((index != 3) | (probs[2] > probs[0]))
    return F.when(alone, index)


def argmax_topic(probs: Column) -> Column:
    """Index of the first maximum; an all-zero vector gives 0."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def vector_columns(vector: str, k: int = TOPICS) -> list[Column]:
    """Vector column to ``k`` double columns."""
    values = vector_to_array(F.col(vector))
    return [values.getItem(i).alias(name) for i, name in enumerate(topic_columns(k))]


def label_topics(
    df: DataFrame, labels: Sequence[str] | Mapping[int, str] = TOPIC_LABELS, topic: str = "topic"
) -> DataFrame:
    pairs = labels.items() if isinstance(labels, Mapping) else enumerate(labels)
    named = F.create_map(*[F.lit(part) for pair in pairs for part in pair])
    return df.withColumn("topic_label", F.try_element_at(named, F.col(topic)))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, not once per array element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def softmax(logits: Column) -> Column:
    """Array of logits to array of probabilities, shifted by the maximum."""
    exps = _bound(
        F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp(x - top))
    )

    def scaled(values):
        total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
        return _bound(total, lambda t: F.transform(values, lambda x: x / t))

    return _bound(exps, scaled)


def rank_labels(scores: Mapping[str, Column]) -> Column:
    """Labels with their scores, best first; equal scores in reverse label order."""
    pairs = F.array(
        *[F.struct(col.alias("score"), F.lit(name).alias("label")) for name, col in scores.items()]
    )
    return F.reverse(F.array_sort(pairs))
