"""Text corpora per group: order, clean, pack into batches, sample, summarise.

A corpus is the texts of a group in time order, one after the other with a newline
between, cleaned as one text. One group may hold a third of all rows, so texts are
ordered once by range partitions that split a hot group into chunks, and that layout
is stored. What depends on a whole group (where it begins and ends, which marks cross
from text to text, how full a batch is) is a scan over its chunks: each says what it
does, a fold over the statements tells each what it starts with. A corpus becomes one
string only where it is known to be short (``gate``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernels
from ..functions.emoji import emoji_regex, remove_emoji
from ..functions.text import (
    LINK_MARK_CHARACTERS,
    MIN_TOKEN_LENGTH,
    RETWEET_MARK,
    TOKEN_CHARACTERS,
    python_pattern,
    remove_links,
    remove_retweet_mark,
    remove_short_links,
    text_lines,
)
from ..functions.topics import argmax_topic, probabilities
from ..schema import TOPICS
from ..session import checkpointed
from .graph import Graph, user_edges
from .video import moderated_shares

# The study's corpus settings and summary length.
GATE_CHARS, BATCH_CHARS, BATCHES_SAMPLED = 12_000, 1_000, 12
SUMMARY_LEAST, SUMMARY_WORDS = 100, 150


# --- which texts form which corpus -------------------------------------------------


def topic_texts(graph: Graph, k: int = TOPICS) -> DataFrame:
    """Texts by user and first-argmax topic, for posts and mentions alike.

    ``edge`` tells a post from a mention, so that ``(date, tweetid, edge)`` orders
    a corpus without ties.
    """
    edges = (
        user_edges(graph, "posted").withColumn("edge", F.lit(0)).unionByName(
            graph.mentions.select("userid", "tweetid", F.lit(1).alias("edge"))
        )
    )
    topic = argmax_topic(probabilities(k)).alias("topic")
    tweets = graph.tweets.filter(F.col("text").isNotNull()).select("tweetid", "date", "text", topic)
    return edges.join(tweets, "tweetid").select(
        "userid", "topic", "date", "tweetid", "edge", "text"
    )


def moderated_texts(shares: DataFrame, metadata: DataFrame) -> DataFrame:
    """Texts of posts that share a video which is gone, by user; once per link."""
    return moderated_shares(shares, metadata).select(
        "userid",
        F.col("tweet_sharing_date").alias("date"),
        "tweetid",
        "video_url",
        F.col("tweet_text").alias("text"),
    )


TOPIC_KEYS, TOPIC_ORDER = ("userid", "topic"), ("date", "tweetid", "edge")
VIDEO_KEYS, VIDEO_ORDER = ("userid",), ("date", "tweetid", "video_url")


# --- one ordered, stored layout ----------------------------------------------------


def _in_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], then: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Sort by key and order into range partitions, numbered ``_chunk``; ``_group`` names the key.

    The order is unique, so a hot group spreads over many chunks. The result is
    checkpointed: a second run of the range partitioner may cut elsewhere. What ``then``
    adds to the ordered rows is computed once; what stands before them runs twice, as the
    partitioner samples it first.
    """
    ordered = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    named = ordered.withColumn("_group", F.to_json(F.struct(*keys))).withColumn("_chunk", F.spark_partition_id())
    return checkpointed(then(named))


def corpus_sizes(texts: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per group: number of texts and characters before cleaning."""
    return texts.filter(F.col("text").isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n_texts"),
        (F.sum(F.length("text")) + F.count("*") - 1).alias("raw_chars"),
    )


# A mark is ``RT``, one whitespace, ``@name``; the newline between two texts is whitespace.
_NAME = "^@[A-Za-z]+[A-Za-z0-9_-]+"


def _border_mark(text: Column) -> Column:
    """What a text does to a mark that may reach into it or out of it, as bits.

    An ``RT`` at the end opens a mark unless a mark within the text has used it, which
    may depend on whether the name at the start is already part of a mark.
    """
    ends = text.endswith("RT")

    def opens(own: Column) -> Column:
        return ends & F.regexp_replace(own, RETWEET_MARK, " ").endswith("RT")

    bits = {
        kernels.JOINS: text.rlike(_NAME),
        kernels.OPENS: F.when(ends, opens(text)),
        kernels.OPENS_CUT: F.when(ends, opens(F.regexp_replace(text, _NAME, " "))),
        kernels.JOINS_LAST: F.rtrim(text, F.lit(LINK_MARK_CHARACTERS)).rlike(_NAME),
    }
    mark = F.lit(0)
    for bit, found in bits.items():
        mark = mark + F.when(found, bit).otherwise(0)
    return mark.cast("tinyint")


def _ordered_texts(texts: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All texts of all groups in order, stored once; every later step reads this layout chunk by chunk.

    Links end at whitespace, so removing them per text is removing them from the corpus.
    """

    def unlinked(rows: DataFrame) -> DataFrame:
        plain = rows.withColumn("text", remove_short_links(remove_links(F.col("text"))))
        marked = plain.withColumn("_mark", _border_mark(F.col("text")))
        return marked.select(*keys, *order, "text", "_mark", "_group", "_chunk")

    present = texts.filter(F.col("text").isNotNull()).select(*keys, *order, "text")
    return _in_chunks(present, keys, order, unlinked)


def _cleaner() -> kernels.Cleaner:
    return kernels.Cleaner(_NAME, python_pattern(RETWEET_MARK), LINK_MARK_CHARACTERS, python_pattern(emoji_regex()))


_MARKS = (
    "_group string, _chunk int, _first int, _single boolean, _after array<boolean>, "
    "_stray array<string>, _whole boolean"
)
_CARRIES = (
    "_group string, _chunk int, _open boolean, _earlier boolean, _later boolean, "
    "_next_joins boolean, _append string"
)


def _placed_texts(ordered: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Texts with ``_place``: whether a corpus begins or ends with them, and which marks cross their borders.

    Each chunk says of its first and last group how a mark passes through; a fold over
    those statements (at most two per chunk) tells each chunk what it begins in.
    """
    head = F.when(F.col("_mark").bitwiseAND(kernels.JOINS) != 0, F.col("text")).alias("_head")
    marks = ordered.select("_group", "_chunk", "_mark", head).mapInArrow(kernels.border_marks(_cleaner()), _MARKS)
    carries = F.broadcast(marks.groupBy("_group").applyInPandas(kernels.fold_marks, _CARRIES))
    started = ordered.join(carries, ["_group", "_chunk"], "left")
    kept = [*keys, *order, "text", "_group", "_chunk", "_append"]
    fields = [started.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField("_place", T.ByteType())])
    return started.select(*kept, "_mark", *kernels.CARRIED).mapInArrow(kernels.place_texts(kept), schema)


def _chunk_lines(ordered: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Pieces of cleaned lines in order, with ``_more`` where a removed mark joins two of them.

    The link mark is stripped at the two ends of a corpus only.
    """

    def at(bit: int) -> Column:
        return F.col("_place").bitwiseAND(bit) != 0

    text = F.col("text")
    mark = F.lit(LINK_MARK_CHARACTERS)
    text = F.when(at(kernels.FIRST), F.ltrim(text, mark)).otherwise(text)
    text = F.when(at(kernels.LAST), F.rtrim(text, mark)).otherwise(text)
    text = F.when(at(kernels.HEAD_CUT), F.regexp_replace(text, _NAME, "")).otherwise(text)
    cleaned = _placed_texts(ordered, keys, order).withColumn("_clean", remove_retweet_mark(text))
    whole = F.col("_clean")
    cut = F.substring(whole, F.lit(1), F.length(whole) - 2)
    cleaned = cleaned.withColumn("_clean", F.when(at(kernels.TAIL_CUT), cut).otherwise(whole))
    cleaned = cleaned.withColumn("_lines", F.when(at(kernels.TAIL_CUT), F.size(text_lines(F.col("_clean")))))
    # outer, since a plain explode evaluates the cleaning once more to drop empty arrays
    pieces = cleaned.select(
        *keys, *order, "_group", "_chunk", "_append", "_place", "_lines",
        F.posexplode_outer(text_lines(F.col("_clean"))).alias("line_no", "line"),
    )
    continues = at(kernels.HEAD_CUT) & (F.col("line_no") == 0)
    opens = F.coalesce(F.col("line_no") == F.col("_lines") - 1, F.lit(False))
    more = F.when(continues, kernels.CONTINUES).otherwise(0) + F.when(opens, kernels.OPEN).otherwise(0)
    joined = pieces.withColumn("_more", more.cast("tinyint"))
    # a piece loses its emoji when its line is whole
    line = F.when(F.col("_more") == 0, remove_emoji(F.col("line"))).otherwise(F.col("line"))
    return joined.withColumn("line", line).drop("_place", "_lines")


def _line_columns(keys: Sequence[str], order: Sequence[str]) -> list[str]:
    return [*keys, *order, "line_no", "line", "_group", "_chunk"]


# --- corpora as lines --------------------------------------------------------------


def corpus_lines(texts: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every line of every cleaned corpus: ``keys, order, line_no, line``.

    A line that a mark across texts joined belongs to the first of them.
    """
    pieces = _chunk_lines(_ordered_texts(texts, keys, order), keys, order)
    columns = _line_columns(keys, order)
    schema = T.StructType([pieces.schema[c] for c in columns])
    return pieces.mapInArrow(kernels.merge_lines(_cleaner(), columns), schema).drop("_group", "_chunk")


def corpus_lengths(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines and characters of each cleaned corpus."""
    return lines.groupBy(*keys).agg(
        F.count("*").alias("n_lines"),
        (F.sum(F.length("line")) + F.count("*") - 1).alias("n_chars"),
    )


def topic_corpus(graph: Graph) -> DataFrame:
    """Lines of the corpus of every user and first-argmax topic."""
    return corpus_lines(topic_texts(graph), TOPIC_KEYS, TOPIC_ORDER)


def moderated_corpus(shares: DataFrame, metadata: DataFrame) -> DataFrame:
    """Lines of the corpus of every user's posts about videos that are gone."""
    return corpus_lines(moderated_texts(shares, metadata), VIDEO_KEYS, VIDEO_ORDER)


# --- packing lines into batches ----------------------------------------------------


_SUMMARY = (
    "_group string, _chunk int, _size bigint, _batches bigint, "
    "_pieces array<struct<from_fill:bigint,fill:bigint,batches:bigint>>"
)
_STARTS = (
    "_group string, _chunk int, _fill bigint, _batch bigint, _total bigint, _batches bigint, _head boolean"
)


def _starts(summaries: DataFrame, limit: int) -> DataFrame:
    """Fill and number of the batch in which each chunk starts its first and last group.

    Packing is sequential, but what a chunk of lines does depends only on how full
    the batch is that it meets. Each chunk says that for every fill at once; a fold
    over the chunks of a group gives each its start, and the group its total.
    """
    borders = summaries.filter(F.col("_pieces").isNotNull())
    return borders.groupBy("_group").applyInPandas(kernels.fold_chunks(limit), _STARTS)


def _with_starts(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """Lines with the start of their chunk and group; at most two rows per chunk are broadcast."""
    carried = starts.select("_group", "_chunk", "_fill", "_batch")
    return lines.join(F.broadcast(carried), ["_group", "_chunk"], "left")


def pack_lines(
    lines: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_size: int = BATCH_CHARS,
    text: str = "line",
) -> DataFrame:
    """Add ``batch_no``: greedy packing of each group's lines, exact for a group of any size.

    ``packed_corpora`` does it for the lines of corpora without another ordering.
    """
    columns = lines.columns
    sized = lines.withColumn("_size", (F.length(text) + 1).cast("bigint"))
    chunks = _in_chunks(sized, keys, order)
    narrow = chunks.select("_group", "_chunk", "_size")
    summaries = narrow.mapInArrow(kernels.group_summaries(max_size), _SUMMARY)
    started = _with_starts(chunks, _starts(summaries, max_size))
    schema = T.StructType([*lines.schema.fields, T.StructField("batch_no", T.LongType())])
    return started.mapInArrow(kernels.number_lines(max_size, columns), schema)


@dataclass(frozen=True)
class PackedCorpora:
    """``groups``: keys, ``n_chars``, ``n_batches``. ``fragments``: keys, ``batch_no`` and parts of its text.

    A batch is one fragment, or several in the order of ``(_chunk, _part)``.
    """

    groups: DataFrame
    fragments: DataFrame


def packed_corpora(
    texts: DataFrame, keys: Sequence[str], order: Sequence[str], max_size: int = BATCH_CHARS
) -> PackedCorpora:
    """Clean every corpus and pack its lines greedily, reading the ordered texts twice.

    The first reading tells the size of every group and where each chunk starts, the
    second cuts the batches. An overlong first line leaves batch 0 empty, which then has
    no fragment.
    """
    pieces = _chunk_lines(_ordered_texts(texts, keys, order), keys, order)
    columns = _line_columns(keys, order)
    merge = kernels.merge_lines(_cleaner(), columns)
    summarise = kernels.chained(merge, kernels.with_sizes, kernels.group_summaries(max_size))
    summaries = checkpointed(pieces.mapInArrow(summarise, _SUMMARY))
    starts = checkpointed(_starts(summaries, max_size))

    inner = summaries.filter(F.col("_pieces").isNull()).select("_group", "_size", "_batches")
    totals = inner.unionByName(starts.filter("_head").select("_group", F.col("_total").alias("_size"), "_batches"))
    key_schema = T.StructType([pieces.schema[k] for k in keys])
    groups = totals.withColumn("_key", F.from_json("_group", key_schema)).select(
        "_key.*", (F.col("_size") - 1).alias("n_chars"), F.col("_batches").alias("n_batches")
    )

    numbered = [*columns, "_size"]
    cut = kernels.chained(
        kernels.merge_lines(_cleaner(), [*columns, "_fill", "_batch"]),
        kernels.with_sizes,
        kernels.number_lines(max_size, numbered),
        kernels.batch_fragments(keys),
    )
    fields = [pieces.schema[k] for k in keys]
    more = T.StructType.fromDDL("batch_no bigint, _chunk int, _part bigint, _chars bigint, _text string")
    fragments = _with_starts(pieces, starts).mapInArrow(cut, T.StructType([*fields, *more.fields]))
    return PackedCorpora(groups, fragments)


def corpus_batches(packed: PackedCorpora, keys: Sequence[str]) -> DataFrame:
    """``keys, batch_no, batch``: every batch with the newline behind each line, the empty ones too."""
    rows = F.sort_array(F.collect_list(F.struct("_chunk", "_part", "_text")))
    text = F.array_join(F.transform(rows, lambda r: r["_text"]), "")
    found = packed.fragments.groupBy(*keys, "batch_no").agg(text.alias("batch"))
    first = packed.fragments.groupBy(*keys).agg(F.min("batch_no").alias("_least")).filter(F.col("_least") > 0)
    empty = first.select(*keys, F.lit(0).cast("bigint").alias("batch_no"), F.lit("").alias("batch"))
    return found.unionByName(empty)


def _numbers(groups: DataFrame) -> DataFrame:
    """Groups once for every batch: ``batch_no``."""
    numbers = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_batches") - 1))
    return groups.withColumn("batch_no", numbers)


def batch_sizes(packed: DataFrame, keys: Sequence[str], text: str = "line") -> DataFrame:
    """Characters of every batch, with the empty batch an overlong first line leaves."""
    sizes = packed.groupBy(*keys, "batch_no").agg(F.sum(F.length(text) + 1).alias("batch_chars"))
    empty = (
        sizes.groupBy(*keys)
        .agg(F.min("batch_no").alias("_least"))
        .filter(F.col("_least") > 0)
        .select(*keys, F.lit(0).cast("bigint").alias("batch_no"), F.lit(0).cast("bigint").alias("batch_chars"))
    )
    return sizes.unionByName(empty)


def batch_texts(packed: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Text of every batch; a batch is short by construction, or one line.

    The empty batch that an overlong first line leaves is among them.
    """
    rows = F.sort_array(F.collect_list(F.struct(F.struct(*order).alias("at"), "line")))
    text = F.concat(F.array_join(F.transform(rows, lambda r: r["line"]), "\n"), F.lit("\n"))
    batches = packed.groupBy(*keys, "batch_no").agg(text.alias("batch"))
    first = packed.groupBy(*keys).agg(F.min("batch_no").alias("_least")).filter(F.col("_least") > 0)
    empty = first.select(*keys, F.lit(0).cast("bigint").alias("batch_no"), F.lit("").alias("batch"))
    return batches.unionByName(empty)


def sample_batches(
    batches: DataFrame, keys: Sequence[str], n: int = BATCHES_SAMPLED, seed: int = 42
) -> DataFrame:
    """``n`` batches per group in random order, without replacement; all if fewer.

    The draw is a hash of seed, key and batch number, so a rerun draws the same.
    """
    draw = F.md5(
        F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys], "batch_no")
    )
    by_draw = Window.partitionBy(*keys).orderBy("_draw")
    return (
        batches.withColumn("_draw", draw)
        .withColumn("pick", F.row_number().over(by_draw))
        .filter(F.col("pick") <= n)
        .drop("_draw")
    )


def sampled_texts(
    packed: PackedCorpora, keys: Sequence[str], n: int = BATCHES_SAMPLED, seed: int = 42
) -> DataFrame:
    """``keys, pick, batch``: the sampled batches of every group with their texts."""
    drawn = sample_batches(_numbers(packed.groups), keys, n, seed).select(*keys, "batch_no", "pick")
    rows = F.sort_array(F.collect_list(F.struct("_chunk", "_part", F.coalesce("_text", F.lit("")).alias("_text"))))
    joined = drawn.join(packed.fragments, [*keys, "batch_no"], "left").groupBy(*keys, "pick").agg(rows.alias("_rows"))
    return joined.select(*keys, "pick", F.array_join(F.transform("_rows", lambda r: r["_text"]), "").alias("batch"))


def _chosen_text(chosen: DataFrame, packed: PackedCorpora, keys: Sequence[str], between: Column) -> DataFrame:
    """One text per group of its ``chosen`` batches in the order of ``pick``; ``between`` stands between two."""
    named = chosen.columns
    joined = chosen.join(packed.fragments, [*keys, "batch_no"], "left")
    part = F.struct("pick", "_chunk", "_part", F.coalesce("_text", F.lit("")).alias("text"))
    kept = [c for c in named if c not in ("batch_no", "pick")]
    rows = joined.groupBy(*kept).agg(F.sort_array(F.collect_list(part)).alias("_rows"))

    def with_border(row: Column, i: Column) -> Column:
        begins = (i > 0) & (F.get("_rows", i - 1)["pick"] != row["pick"])
        return F.concat(F.when(begins, between).otherwise(""), row["text"])

    return rows.select(*kept, F.array_join(F.transform("_rows", with_border), "").alias("text"))


# --- the gate ----------------------------------------------------------------------


def gate(
    texts: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    limit: int = GATE_CHARS,
    max_size: int = BATCH_CHARS,
    n: int = BATCHES_SAMPLED,
    seed: int = 42,
) -> DataFrame:
    """One bounded text per group: the whole corpus, or a sample of its batches.

    ``keys, n_chars, sampled, text``. The sizes of the packed groups decide which
    batches are wanted; only their texts are put together.
    """
    packed = packed_corpora(texts, keys, order, max_size)
    groups = packed.groups.withColumn("sampled", F.col("n_chars") > limit)
    whole = _numbers(groups.filter(~F.col("sampled"))).withColumn("pick", F.col("batch_no").cast("int"))
    drawn = sample_batches(_numbers(groups.filter("sampled")), keys, n, seed)
    chosen = whole.unionByName(drawn).drop("n_batches")
    joined = _chosen_text(chosen, packed, keys, F.when(F.col("sampled"), "\n").otherwise(""))
    text = F.col("text")
    # a whole corpus has no newline behind its last line
    return joined.withColumn(
        "text", F.when(F.col("sampled"), text).otherwise(F.substring(text, F.lit(1), F.length(text) - 1))
    )


# --- extractive summary ------------------------------------------------------------


def extractive_summary(
    texts: DataFrame, keys: Sequence[str], max_words: int = SUMMARY_WORDS, min_words: int = SUMMARY_LEAST
) -> DataFrame:
    """Add ``summary`` and ``n_words``: the best lines of each gated, so short, ``text`` in their order.

    Lines are chosen greedily by the weight of their new tokens per word, until none
    fits into ``max_words``. A text with ``min_words`` words in lines with a token has
    at least as many in its summary; a text without such a line has an empty one.
    """
    rows = texts.select(*keys, *[c for c in texts.columns if c not in keys])
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("summary string, n_words bigint").fields])
    token = f"{TOKEN_CHARACTERS}{{{MIN_TOKEN_LENGTH},}}"
    return rows.mapInArrow(kernels.summaries(token, max_words, min_words), schema)
