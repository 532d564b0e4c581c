"""SimHash near-duplicates: BK-trees over shards of fingerprints, and their components.

Documents of one fingerprint collapse to one node. Two fingerprints within the
radius of r bits agree wholly on one of r + 1 bit blocks, so each node goes to
one shard per block; a shard of many nodes is cut again by the blocks of the
remaining bits, by the same argument without loss. Every task grows BK-trees,
one per shard, with children keyed by the distance to their parent, and each
node walks only the edges within the radius. A task hands out one link per node
to the smallest of its local component, never pairs, and the components of those
links are joined by alternating large and small stars.

Defined results: a text without a word has fingerprint zero, linked like any
other; repeated rows and texts share their fingerprint and component; a row
without an id has a fingerprint and a null component unless others share it; an
empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlark.llm.common import fresh, id_and_text, travels
from postlark.session import checkpointed

travels(__name__)

SHINGLE, RADIUS = 4, 4
# a shard of more nodes than this is cut by the remaining bits
SHARD_NODES = 20_000
CUTS = 3
FRONTIER = 400_000
SEED = 42


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingles' XXH64; text is UTF-8, words are split at ASCII white space."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(line, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    bounds = zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in bounds], np.uint64)
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a : a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(shingle: int):
    def apply(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "bits"]
            )

    return apply


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, bits`` of ``docs`` (``doc_id, text``); bits are a signed 64-bit integer."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprints(shingle), f"doc_id {kind}, bits bigint")


# --- BK-trees ------------------------------------------------------------------------


def grow(shards: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One BK-tree per shard, all at once, level by level.

    Returns the root of each row's shard, and every edge as a sorted key
    (65 * parent + distance) with the child it leads to.
    """
    roots = np.zeros(len(values), np.int64)
    keys, children = [], []
    pending, slots, first = np.arange(len(values)), shards.astype(np.int64), True
    while len(pending):
        order = np.argsort(slots, kind="stable")
        pending, slots = pending[order], slots[order]
        head = np.concatenate(([True], slots[1:] != slots[:-1]))
        tops = pending[head][np.cumsum(head) - 1]
        if first:
            roots[pending] = tops
        else:
            keys.append(slots[head])
            children.append(pending[head])
        first = False
        rest = ~head
        distance = np.bitwise_count(values[pending[rest]] ^ values[tops[rest]]).astype(np.int64)
        pending, slots = pending[rest], tops[rest] * 65 + distance
    keys = np.concatenate([np.zeros(0, np.int64), *keys])
    children = np.concatenate([np.zeros(0, np.int64), *children])
    order = np.argsort(keys)
    return roots, keys[order], children[order]


def walk(roots, keys, children, values, radius: int):
    """Pairs of rows within ``radius``, in pieces; only edges within the radius are followed."""
    stack = [
        (np.arange(a, min(a + FRONTIER // 8, len(values))),) for a in range(0, len(values), FRONTIER // 8)
    ]
    stack = [(q, roots[q]) for (q,) in stack]
    while stack:
        queries, nodes = stack.pop()
        if len(queries) > FRONTIER:
            half = len(queries) // 2
            stack += [(queries[:half], nodes[:half]), (queries[half:], nodes[half:])]
            continue
        distance = np.bitwise_count(values[queries] ^ values[nodes]).astype(np.int64)
        near = (distance <= radius) & (queries < nodes)
        if near.any():
            yield queries[near], nodes[near]
        low = np.searchsorted(keys, nodes * 65 + np.maximum(distance - radius, 0), "left")
        high = np.searchsorted(keys, nodes * 65 + np.minimum(distance + radius, 64), "right")
        counts = high - low
        total = int(counts.sum())
        if total:
            within = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
            stack.append((np.repeat(queries, counts), children[np.repeat(low, counts) + within]))


def unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels in which the rows ``a`` and ``b`` of every pair share the smallest."""
    while len(a):
        low = np.minimum(labels[a], labels[b])
        np.minimum.at(labels, labels[a], low)
        np.minimum.at(labels, labels[b], low)
        while not np.array_equal(labels, labels[labels]):
            labels = labels[labels]
        open_ = labels[a] != labels[b]
        a, b = a[open_], b[open_]
    return labels


def _links(radius: int):
    def links(batches):
        tables = [b for b in batches if len(b)]
        if not tables:
            return
        mask, bits, node = (
            np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in tables]) for i in range(3)
        )
        # the smallest id of a local component is the row with the smallest number
        order = np.argsort(node, kind="stable")
        mask, values, node = mask[order], bits[order].view(np.uint64), node[order]
        shards = np.unique(np.stack([mask, bits[order] & mask]), axis=1, return_inverse=True)[1].reshape(-1)
        labels = np.arange(len(node))
        for a, b in walk(*grow(shards, values), values, radius):
            labels = unite(labels, a, b)
        # one node stands in several shards of a task; its copies are joined by the stars
        linked = np.flatnonzero(labels != np.arange(len(node)))
        pairs = np.unique(np.stack([node[linked], node[labels[linked]]]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    return links


def parts(mask: int, n: int) -> list[int]:
    """The bits outside ``mask`` in ``n`` blocks of nearly equal size, each with ``mask`` itself."""
    free = [i for i in range(64) if not mask >> i & 1]
    cuts = [len(free) * k // n for k in range(n + 1)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def shards(nodes: DataFrame, radius: int, most: int = SHARD_NODES) -> DataFrame:
    """``mask, bits, node``: every node once per shard it belongs to."""
    level = {0: parts(0, radius + 1)}
    first = F.explode(F.array(*[F.lit(signed(m)) for m in level[0]]))
    rows = nodes.select(first.alias("mask"), "bits", "node")
    done = None
    for _ in range(CUTS):
        key = [F.col("mask"), F.col("bits").bitwiseAND(F.col("mask")).alias("part")]
        large = rows.groupBy(*key).agg(F.count("*").alias("n")).filter(F.col("n") > most).drop("n")
        large = checkpointed(large)
        if large.isEmpty():
            break
        keyed = rows.withColumn("part", key[1])
        cold = keyed.join(large, ["mask", "part"], "left_anti").select(*rows.columns)
        done = cold if done is None else done.unionByName(cold)
        masks = {signed(m): m for m in sum(level.values(), [])}
        level = {m: parts(m, radius + 1) for m in masks.values()}
        deeper = F.create_map(
            *[x for m, finer in level.items() for x in (F.lit(signed(m)), F.array(*[F.lit(signed(f)) for f in finer]))]
        )
        hot = keyed.join(large, ["mask", "part"], "left_semi")
        rows = hot.select(F.explode(deeper[F.col("mask")]).alias("mask"), "bits", "node")
    return rows if done is None else done.unionByName(rows)


# --- components ----------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """``node, root`` (the smallest of its component) for every node of ``links`` (``a, b``) that is no root.

    Large and small stars in turn until nothing changes; a star is an aggregate
    and a join on the node, both of which a hot node leaves balanced.
    """
    edges = checkpointed(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        edges = checkpointed(small.filter("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs`` (``doc_id, text``)."""
    prints = checkpointed(fingerprints(docs, shingle))
    classes = checkpointed(prints.groupBy("bits").agg(F.min("doc_id").alias("node")))
    cut = shards(classes.filter(F.col("node").isNotNull()).select("bits", "node"), radius, shard_nodes)
    dealt = cut.select("mask", "bits", "node", F.col("bits").bitwiseAND(F.col("mask")).alias("part"))
    links = dealt.repartition("mask", "part").select("mask", "bits", "node").mapInArrow(
        _links(radius), "a bigint, b bigint"
    )
    roots = components(links)
    found = classes.join(roots, "node", "left").select(
        "bits", F.coalesce("root", "node").alias("component_id")
    )
    return prints.join(found, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stand for their group: one with its smallest id.

    Of rows that share that id one stays, the one with the smallest text hash.
    Rows without an id have no group and stay.
    """
    groups = near_duplicates(id_and_text(docs), shingle=shingle, radius=radius)
    kept = groups.filter(F.col("component_id") == F.col("doc_id")).select("doc_id").distinct()
    number = fresh("copy_number", docs.columns)
    copies = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    stays = docs.join(kept, "doc_id", "left_semi").withColumn(number, F.row_number().over(copies))
    stays = stays.filter(F.col(number) == 1).select(*docs.columns)
    return stays.unionByName(docs.filter(F.col("doc_id").isNull()))
