"""Source divergence audit with hash-consed segment trees over term ids.

Every (language, source) group has a count for each kept term of its language; two
groups differ by the sum of a price over all terms. The counts of a group are the
leaves of a segment tree over term ids in which equal subtrees are one node, among
all groups: ranges where two groups count alike are the same node. Two trees are
walked together from their roots, and what is due for a pair of nodes is worked
out once, however often the pair occurs.

1. Tasks count the terms of their texts by group, with the number of documents, and
   add up what they can before they send the counts, packed, to the bucket of their
   term. Buckets are sized by the bytes of all texts. Common terms are kept.
2. The term ids of a language are dealt to shards, each an aligned range and so a
   subtree of its own: sums over shards are sums over the whole tree. Groups of a
   shard are dealt out in blocks of sources where a language has very many.
3. A task builds the nodes of its groups, walks all pairs and finds the largest
   terms; sums over shards and ranks are Spark aggregates and windows.

Defined results: null texts, languages and sources are empty strings; every row is
a document, repeated rows too; a group without terms takes part in pairs; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlark.llm.common import mixed, powers, slices, text_buffer, travels

travels(__name__)

MIN_DOCS, TOP_TERMS = 10, 10
SCALE_STEPS = (1000, 1000, 1000)  # their product is the scale of a share
# text counted at once; rows that a task adds up before it sends them on
SLICE_BYTES, HELD_ROWS = 2_000_000, 400_000
# text whose counts one bucket of terms adds up; terms of one shard, sources of one block
BUCKET_BYTES, SHARD_TERMS, BLOCK_SOURCES = 16 << 20, 1 << 14, 48

TERM = np.zeros(256, bool)
TERM[ord("A") : ord("Z") + 1] = TERM[ord("a") : ord("z") + 1] = TERM[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

COUNTS = ("group", "term", "n", "n_docs")
PACKED = pa.schema(
    [
        ("bucket", pa.int64()),
        ("langs", pa.list_(pa.string())),
        ("sources", pa.list_(pa.string())),
        ("terms", pa.string()),
        ("groups", pa.binary()),
        ("n", pa.binary()),
        ("n_docs", pa.binary()),
    ]
)
KEPT = pa.schema(
    [
        ("lang", pa.string()),
        ("source", pa.string()),
        ("term", pa.string()),
        ("n", pa.int64()),
        ("lang_n", pa.int64()),
        ("first", pa.bool_()),
    ]
)


# --- terms -----------------------------------------------------------------------------


def terms_of(data: np.ndarray, starts: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All terms of a buffer, encoded, and the row of each."""
    inside = TERM[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = starts[(starts > 0) & (starts < len(data))]
    begins[borders] |= inside[borders]
    first = np.flatnonzero(begins)
    sizes = np.bincount(np.cumsum(begins, dtype=np.int32)[inside] - 1, minlength=len(first))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    kind = pa.large_string() if offsets[-1] >= 1 << 31 else pa.string()
    offsets = offsets.astype(np.int64 if kind == pa.large_string() else np.int32)
    terms = pa.Array.from_buffers(kind, len(first), [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[data[inside]])])
    return terms.dictionary_encode(), np.searchsorted(starts, first, "right") - 1


def count_terms(data: np.ndarray, starts: np.ndarray, group: np.ndarray):
    """Counts by group and term of some rows: the dictionary, and group, code, occurrences and documents."""
    terms, row = terms_of(data, starts)
    codes = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(len(terms.dictionary), 1)
    pairs, n = np.unique(row * width + codes, return_counts=True)  # documents and terms
    keys, at = np.unique(group[pairs // width] * width + pairs % width, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, n)
    return terms.dictionary, keys // width, keys % width, total, np.bincount(at, minlength=len(keys))


def _added(tables: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(tables)
    summed = table.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n_docs", "sum")])
    return summed.rename_columns(COUNTS).combine_chunks()


def _bytes_hashes(texts: pa.Array) -> np.ndarray:
    """Hash of the bytes of every (not empty) string."""
    data, starts = text_buffer(texts)
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return mixed((sums[starts[1:]] - sums[starts[:-1]]) * down[starts[:-1]])


def _packed(table: pa.Table, pairs: list[tuple[str, str]], buckets: int) -> Iterator[pa.RecordBatch]:
    """Counts dealt to the bucket of their term: one row for each bucket, numbers and terms packed."""
    words = table["term"].combine_chunks()
    bucket = (_bytes_hashes(words) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, words = bucket[order], words.take(pa.array(order))
    group, n, n_docs = (table[c].to_numpy()[order] for c in ("group", "n", "n_docs"))
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), words), "\n")
    rows = []
    for k, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        used, own = np.unique(group[a:b], return_inverse=True)
        langs, sources = zip(*(pairs[i] for i in used.tolist()))
        numbers = [x.tobytes() for x in (own.astype(np.int32), n[a:b], n_docs[a:b])]
        rows.append((int(bucket[a]), langs, sources, joined[k].as_py(), *numbers))
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PACKED)], schema=PACKED)


def _count(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        numbers: dict[tuple[str, str], int] = {}
        for batch in batches:
            data, starts = text_buffer(batch["text"])
            own = zip(batch["lang"].to_pylist(), batch["source"].to_pylist())
            group = np.fromiter((numbers.setdefault(pair, len(numbers)) for pair in own), np.int64, len(batch))
            for a, b in slices(np.diff(starts), SLICE_BYTES):
                part, at = data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
                words, of, code, n, n_docs = count_terms(part, at, group[a:b])
                columns = [pa.array(of, pa.int32()), words.take(pa.array(code)).cast(pa.string()), pa.array(n), pa.array(n_docs)]
                held.append(pa.table(columns, names=COUNTS))
                rows += len(n)
            if rows > HELD_ROWS:
                held = [_added(held)]
                rows = len(held[0])
                if rows > HELD_ROWS // 2:
                    yield from _packed(held[0], list(numbers), buckets)
                    held, rows = [], 0
        if rows:
            yield from _packed(_added(held), list(numbers), buckets)

    return count


def _keep(min_docs: int):
    """Add up the counts of a bucket of terms and keep the common ones."""

    def keep(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        numbers: dict[tuple[str, str], int] = {}
        groups = []
        for langs, sources, packed in zip(*(table[c].to_pylist() for c in ("langs", "sources", "groups"))):
            own = np.array([numbers.setdefault(pair, len(numbers)) for pair in zip(langs, sources)], np.int64)
            groups.append(own[np.frombuffer(packed, np.int32)])
        group = np.concatenate(groups)
        n, n_docs = (np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table[c]]) for c in ("n", "n_docs"))
        words = pc.split_pattern(table["terms"].combine_chunks(), "\n").flatten().dictionary_encode()
        term, width = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
        names = sorted({lang for lang, _ in numbers})
        lang_of = np.array([names.index(lang) for lang, _ in numbers], np.int64)
        in_lang = lang_of[group] * width + term
        lang_docs, lang_n = np.zeros(len(names) * width, np.int64), np.zeros(len(names) * width, np.int64)
        np.add.at(lang_docs, in_lang, n_docs)
        np.add.at(lang_n, in_lang, n)
        common = lang_docs[in_lang] >= min_docs
        # a term's groups side by side, each language's together
        order = np.argsort(lang_of, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        keys, at = np.unique(term[common] * len(order) + rank[group[common]], return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, n[common])
        term, own = keys // len(order), order[keys % len(order)]
        lang = lang_of[own]
        first = np.ones(len(keys), bool)
        first[1:] = (term[1:] != term[:-1]) | (lang[1:] != lang[:-1])
        pairs = list(numbers)
        columns = [
            pa.array([p[0] for p in pairs], pa.string()).take(pa.array(own)),
            pa.array([p[1] for p in pairs], pa.string()).take(pa.array(own)),
            words.dictionary.take(pa.array(term)).cast(pa.string()),
            pa.array(total),
            pa.array(lang_n[lang * width + term]),
            pa.array(first),
        ]
        return pa.table(columns, schema=KEPT)

    return keep


# --- trees -----------------------------------------------------------------------------


def shares(counts: np.ndarray, total: int, n_terms: int) -> np.ndarray:
    """1 + floor(scale * (count + 2) / (total + 2 * n_terms)), exact: long division in steps."""
    over = total + 2 * n_terms
    rest, out = counts + 2, np.zeros(len(counts), np.int64)
    whole, rest = rest // over, rest % over
    out = whole
    for step in SCALE_STEPS:
        rest = rest * step
        out, rest = out * step + rest // over, rest % over
    return out + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Forest:
    """Segment trees of the rows of ``counts``; equal subtrees of all rows are one node.

    A level numbers its distinct nodes; a node above is a pair of them. Leaves are
    counts; -1 fills up to a power of two and costs nothing.
    """

    def __init__(self, counts: np.ndarray):
        rows, width = counts.shape
        size = 1 << max(width - 1, 0).bit_length()
        leaves = np.full((rows, size), -1, np.int64)
        leaves[:, :width] = counts
        self.leaves, ids = np.unique(leaves, return_inverse=True)
        ids = ids.reshape(rows, size)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # children of each node
        n = len(self.leaves)
        while ids.shape[1] > 1:
            codes, up = np.unique(ids[:, ::2] * n + ids[:, 1::2], return_inverse=True)
            self.levels.append((codes // n, codes % n))
            ids, n = up.reshape(rows, -1), len(codes)
        self.roots = ids[:, 0]

    def leaf_pairs(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs of leaves that the trees of two rows hold side by side, and how often.

        Both trees are walked level by level; a pair of nodes is opened once and carries its number.
        """
        one, two, times = (np.array([x], np.int64) for x in (self.roots[a], self.roots[b], 1))
        for left, right in reversed(self.levels):
            one, two = np.concatenate((left[one], right[one])), np.concatenate((left[two], right[two]))
            n, weights = int(two.max()) + 1, np.concatenate((times, times))
            codes, space = one * n + two, (int(one.max()) + 1) * n
            if space <= 4 * len(codes):  # few nodes: count without sorting
                each = np.zeros(space, np.int64)
                np.add.at(each, codes, weights)
                pairs = np.flatnonzero(each)
                each = each[pairs]
            else:
                pairs, at = np.unique(codes, return_inverse=True)
                each = np.zeros(len(pairs), np.int64)
                np.add.at(each, at, weights)
            one, two, times = pairs // n, pairs % n, each
        return one, two, times


def _divergences(top_terms: int):
    schema = pa.schema(
        [("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())]
    )

    def measure(entries: pa.Table, groups: pa.Table) -> pa.Table:
        if not len(groups):
            return schema.empty_table()
        lang, n_terms, here = (groups[c][0].as_py() for c in ("lang", "n_terms", "shard_terms"))
        low, high, lang_total = (groups[c][0].as_py() for c in ("low", "high", "lang_total"))
        sources, totals = groups["source"].to_pylist(), groups["total"].to_pylist()
        side = groups["block"].to_numpy()
        # terms by falling count of the language, so that rare ones stand together; absent ones behind them
        kinds = entries.group_by("term").aggregate([("lang_n", "min")])
        kinds = kinds.sort_by([("lang_n_min", "descending"), ("term", "ascending")])
        counts = np.zeros((len(sources), max(here, 1)), np.int64)
        number = {s: k for k, s in enumerate(sources)}
        row = np.fromiter((number[s] for s in entries["source"].to_pylist()), np.int64, len(entries))
        place = pc.index_in(entries["term"].combine_chunks(), kinds["term"].combine_chunks()).to_numpy(zero_copy_only=False)
        counts[row, place.astype(np.int64)] = entries["n"].to_numpy()
        rows: list[tuple] = []
        forest = Forest(counts)
        leaf = forest.leaves
        if n_terms:
            p = [shares(np.maximum(leaf, 0), t, n_terms) for t in totals]
        for a in range(len(sources)):
            for b in range(a + 1, len(sources)):
                if low != high and side[a] == side[b]:
                    continue  # the task of that block has the pair
                value = 0
                if n_terms and here:
                    one, two, times = forest.leaf_pairs(a, b)
                    real = leaf[one] >= 0
                    one, two, times = one[real], two[real], times[real]
                    value = int((price(p[a][one], p[b][two]) * times).sum())
                rows += [(lang, sources[a], "pair", sources[b], value), (lang, sources[b], "pair", sources[a], value)]
        if low == high and n_terms and len(kinds):
            # a group's nonzero leaves against the language's
            terms, whole = kinds["term"].to_pylist(), shares(kinds["lang_n_min"].to_numpy(), lang_total, n_terms)
            for a in range(len(sources)):
                at = np.flatnonzero(counts[a, : len(terms)])
                own = shares(counts[a, at], totals[a], n_terms)
                more = own > whole[at]
                at, own = at[more], own[more]
                value = price(own, whole[at])
                if len(at) > top_terms:  # all that may be among the first, ties included
                    least = np.partition(value, len(at) - top_terms)[len(at) - top_terms]
                    at, value = at[value >= least], value[value >= least]
                best = sorted(zip((-value).tolist(), (terms[k].encode() for k in at.tolist())))[:top_terms]
                rows += [(lang, sources[a], "term", t.decode(), -v) for v, t in best]
        columns = list(zip(*rows)) if rows else [[] for _ in schema]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return measure


# --- the audit ---------------------------------------------------------------------------


def common_terms(docs: DataFrame, min_docs: int, bucket_bytes: int) -> DataFrame:
    """``lang, source, term, n, lang_n, first`` of the terms in at least ``min_docs`` documents of their language.

    ``docs`` has ``text, lang, source`` without nulls. ``first`` marks one row of each
    language and term.
    """
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets = size // bucket_bytes + 1
    ddl = "bucket bigint, langs array<string>, sources array<string>, terms string, groups binary, n binary, n_docs binary"
    packed = docs.mapInArrow(_count(buckets), ddl)
    kept = "lang string, source string, term string, n bigint, lang_n bigint, first boolean"
    return packed.groupBy("bucket").applyInArrow(_keep(min_docs), kept)


def audit_sources(
    docs: DataFrame,
    folder: str,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    shard_terms: int = SHARD_TERMS,
    block_sources: int = BLOCK_SOURCES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` of all groups of ``docs``.

    Part ``pair`` prices every other source of the language, part ``term`` the
    ``top_terms`` terms that the group has more often than its language. The kept
    counts are stored below ``folder``, which all executors reach.
    """
    spark = docs.sparkSession
    columns = {"text": text_col, "lang": lang_col, "source": source_col}
    rows = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for n, c in columns.items()])
    common_terms(rows, min_docs, bucket_bytes).write.parquet(f"{folder}/kept")
    # read twice, so that both sides of the last step have columns of their own
    entries, again = (spark.read.parquet(f"{folder}/kept") for _ in range(2))
    occurring = rows.select("lang", "source").distinct()
    counted = again.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    totals = occurring.join(counted, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    terms = entries.filter("first")
    langs = (
        totals.groupBy("lang")
        .agg(F.sum("total").alias("lang_total"), F.count("*").alias("n_sources"))
        .join(terms.groupBy("lang").agg(F.count("*").alias("n_terms")), "lang", "left")
        .withColumn("n_terms", F.coalesce("n_terms", F.lit(0)))
    )
    # all languages are dealt alike, so that no step joins on a language
    most = langs.agg(F.max("n_terms").alias("terms"), F.max("n_sources").alias("sources")).first()
    shards = (most["terms"] or 0) // shard_terms + 1
    blocks = -(-(most["sources"] or 1) // block_sources)

    def dealt(rows: DataFrame) -> DataFrame:
        """Rows of a source once for every pair of blocks that its block is in."""
        block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))) if blocks > 1 else F.lit(0)
        each = rows.withColumn("block", block).withColumn("other", other)
        return each.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})

    shard = F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int")
    sized = terms.groupBy("lang", shard.alias("shard")).agg(F.count("*").alias("shard_terms"))
    # a language without a kept term has one empty shard
    spread = langs.join(sized, "lang", "left").select(
        "lang",
        "lang_total",
        "n_terms",
        F.coalesce("shard", F.lit(0)).alias("shard"),
        F.coalesce("shard_terms", F.lit(0)).alias("shard_terms"),
    )
    keys = ["lang", "shard", "low", "high"]
    groups = dealt(totals.join(spread, "lang")).drop("other")
    placed = dealt(entries.withColumn("shard", shard)).select(*keys, "source", "term", "n", "lang_n")
    found = (
        placed.groupBy(*keys)
        .cogroup(groups.groupBy(*keys))
        .applyInArrow(_divergences(top_terms), "lang string, source string, part string, item string, value bigint")
    )
    summed = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = summed.withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top_terms))
