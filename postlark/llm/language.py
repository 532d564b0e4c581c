"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed 1- to 3-grams of every labelled text, sums them by
language in Spark, and broadcasts one matrix of log probabilities of fixed size
(languages x buckets). Scoring gathers matrix rows for the n-grams of a batch in
numpy and sums them by document.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
without any training text every prediction is ``und``; ties go to the language
that sorts first; a null label never trains; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.llm.common import fresh, slices, travels, with_fields

travels(__name__)

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
SLICE_CHARS = 1_000_000
# the broadcast matrix has 8 * BUCKETS bytes a language: 512 languages are 134 MB
MOST_LANGUAGES = 512
SMOOTHING = 0.5


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def gram_buckets(codes: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each code point but the last n - 1."""
    size = len(codes) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    h = codes[:size] * np.uint32(0x9E3779B1) + np.uint32(n)
    for k in range(1, n):
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA77) + codes[k : k + size]
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0xC2B2AE3D)
    return (h >> np.uint32(32 - 15)).astype(np.int64)


def gram_rows(texts: list[str]):
    """For each order: buckets of all n-grams of the texts, ``BUCKETS`` for one that crosses a border; starts."""
    wrapped = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(wrapped).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(w) for w in wrapped])))
    for n in ORDERS:
        buckets = np.full(len(codes), BUCKETS, np.int64)
        found = gram_buckets(codes, n)
        buckets[: len(found)] = found
        for k in range(1, n):
            buckets[starts[1:] - k] = BUCKETS
        yield buckets, starts


def _count(batches):
    counts: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            total = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            documents[lang] = documents.get(lang, 0) + len(texts)
            for a, b in slices(np.array([len(t) for t in texts]), SLICE_CHARS):
                for buckets, _ in gram_rows(texts[a:b]):
                    total += np.bincount(buckets, minlength=BUCKETS + 1)
    for lang, total in counts.items():
        total[BUCKETS] = documents[lang]  # the last bucket carries the number of documents
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
            ["lang", "bucket", "n"],
        )


def train_language(labelled: DataFrame, *, text_col="text", lang_col="lang") -> tuple[list[str], np.ndarray]:
    """The languages, and their log probabilities: one column each, the prior in the last row."""
    rows = labelled.select(
        labelled[text_col].alias("text"), labelled[lang_col].cast("string").alias("lang")
    ).filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counted = rows.mapInArrow(_count, "lang string, bucket int, n bigint")
    # at most BUCKETS + 1 rows a language reach the driver
    summed = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = summed.toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"{len(langs)} languages; the broadcast matrix is bounded by {MOST_LANGUAGES}")
    counts = np.zeros((BUCKETS + 1, len(langs)))
    if langs:
        at = np.searchsorted(np.array(langs, object), np.array(found["lang"].to_pylist(), object))
        counts[found["bucket"].to_numpy(), at] = found["n"].to_numpy()
    return langs, log_matrix(counts)


def log_matrix(counts: np.ndarray) -> np.ndarray:
    grams, documents = counts[:BUCKETS] + SMOOTHING, counts[BUCKETS:]
    out = np.zeros((BUCKETS + 1, counts.shape[1]))
    if counts.shape[1]:
        out[:BUCKETS] = np.log(grams) - np.log(grams.sum(axis=0))
        out[BUCKETS] = np.log(documents[0] / documents.sum())
    return out


def predict(texts: list[str | None], langs: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Most probable language of each text and its posterior probability."""
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    rows = [i for i, t in enumerate(texts) if langs and has_letter(t)]
    columns = []
    for column in matrix.T:  # contiguous, and nothing for an n-gram across a border
        own = column.copy()
        own[BUCKETS] = 0
        columns.append(own)
    for a, b in slices(np.array([len(texts[i]) for i in rows]), SLICE_CHARS):
        total = np.tile(matrix[BUCKETS], (b - a, 1))
        for buckets, starts in gram_rows([texts[i] for i in rows[a:b]]):
            for k, own in enumerate(columns):
                total[:, k] += np.add.reduceat(own[buckets], starts[:-1])
        total -= total.max(axis=1, keepdims=True)
        best = total.argmax(axis=1)
        posterior = 1 / np.exp(total).sum(axis=1)
        for i, k, p in zip(rows[a:b], best.tolist(), posterior.tolist()):
            names[i], scores[i] = langs[k], min(1.0, p)
    return names, scores


def _predict(text: str, names: tuple[str, str], model):
    def apply(batches):
        langs, matrix = model.value
        for batch in batches:
            found, scores = predict(batch.column(batch.schema.get_field_index(text)).to_pylist(), langs, matrix)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, *names],
            )

    return apply


def identify_language(docs: DataFrame, model, *, text_col="text", lang_as="lang_pred", score_as="score") -> DataFrame:
    """``docs`` with the predicted language and its probability; ``model`` comes from `train_language`."""
    lang_as, score_as = fresh(lang_as, docs.columns), fresh(score_as, docs.columns)
    schema = with_fields(docs.schema, f"{lang_as} string, {score_as} double")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_predict(text_col, (lang_as, score_as), shared), schema)


def accepted(lang: Column, score: Column, least: float = 0.5) -> Column:
    """A document stays if a language was found that is more probable than all others together."""
    return (lang != "und") & (score >= least)
