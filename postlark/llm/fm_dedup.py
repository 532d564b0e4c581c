"""Exact removal of repeated word windows with one compressed FM-index per shard.

A word goes if a window of ``window`` words that covers it also starts earlier
(in a document with a smaller id, or earlier in its own). Windows that can be
equal meet in one shard; texts stay in their block:

1. Documents are blocked by a hash of their id. Among the hashes of the runs of
   ``anchor`` words in a window the smallest is its anchor, so equal windows share
   it. Blocks send their distinct anchors, packed, and learn which others hold.
2. A segment is the words that the windows of one anchor place span. Segments of
   shared anchors become rows, equal ones one row with their earliest place, by a
   Spark aggregate that combines before it shuffles. An anchor of very many blocks
   is dealt out by whole windows, so that it does not fill one shard.
3. A shard indexes its segments: suffix order, Burrows-Wheeler transform, wavelet
   tree. Every window is streamed through the index by backward search; one whose
   interval narrows to a single suffix matches nowhere else and stops. The others
   end in the interval of all their occurrences, of which the earliest stays.
4. The places that stay go back to their block; all other windows of shared
   anchors are cut out there.

Defined results: a null, empty or short text loses nothing; rows that share an id
are one document, its texts in ascending order; a row without an id loses nothing
and removes nothing; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.llm.common import BASE, id_and_text, mixed, powers, text_buffer, travels

travels(__name__)

WINDOW, ANCHOR = 20, 8
# texts of one block, and text whose windows one shard indexes at most
BLOCK_BYTES, SHARD_BYTES = 4 << 20, 8 << 20
# an anchor in so many blocks is dealt out by whole windows
HOT_BLOCKS = 512
# bytes hashed, windows ranked and windows searched at once
PIECE_BYTES, RANKED, SEARCHED = 1 << 21, 1 << 20, 1 << 16

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


# --- words and anchors ---------------------------------------------------------------


class Words(NamedTuple):
    """The words of a block, each with one blank behind it."""

    line: np.ndarray
    at: np.ndarray  # where each word begins, and where the last ends
    per_row: np.ndarray  # words before each row, and all


def words_of(data: np.ndarray, starts: np.ndarray) -> Words:
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = starts[(starts > 0) & (starts < len(data))]
    begins[borders] |= inside[borders]
    word = np.cumsum(begins, dtype=np.int32)[inside] - 1
    first = np.flatnonzero(begins)
    sizes = np.bincount(word, minlength=len(first))
    at = np.concatenate(([0], np.cumsum(sizes + 1)))
    line = np.full(at[-1], 32, np.uint8)
    line[np.arange(len(word)) + word] = data[inside]
    return Words(line, at, np.searchsorted(first, starts, "left"))


def word_hashes(words: Words) -> np.ndarray:
    cuts = np.searchsorted(words.at, np.arange(0, words.at[-1], PIECE_BYTES))
    cuts = np.unique(np.append(cuts, len(words.at) - 1))
    parts = [np.zeros(0, np.uint64)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        piece = words.line[words.at[a] : words.at[b]]
        up, down = powers(len(piece))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece + np.uint64(1)) * up[: len(piece)], dtype=np.uint64, out=sums[1:])
        at = words.at[a : b + 1] - words.at[a]
        parts.append(mixed((sums[at[1:]] - sums[at[:-1]]) * down[at[:-1]]))
    return np.concatenate(parts)


def run_keys(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the run of ``size`` words at each place that has one."""
    n = max(len(hashes) - size + 1, 0)
    total = hashes[:n].copy()
    for k in range(1, size):
        total = total * np.uint64(BASE) + hashes[k : k + n]
    return mixed(total)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each run of ``width`` values."""
    n, size = len(values) - width + 1, 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size : width - size + n])


def segments(hashes: np.ndarray, per_row: np.ndarray, window: int, anchor: int):
    """Anchor, first and last window of every segment; windows do not cross rows."""
    n = len(hashes) - window + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return np.zeros(0, np.uint64), none, none
    keys = run_keys(hashes, anchor)
    width = window - anchor + 1
    low = np.uint64((RANKED << 1) - 1)
    chosen = np.empty(n, np.int64)
    for c in range(0, n, RANKED):
        # the smallest hash, the first place among equal ones
        own = keys[c : c + RANKED + width - 1]
        ranked = (own & ~low) | np.arange(len(own), dtype=np.uint64)
        chosen[c : c + RANKED] = (least(ranked, width) & low).astype(np.int64) + c
    ends = np.repeat(per_row[1:], np.diff(per_row))[:n]
    windows = np.flatnonzero(np.arange(n) + window <= ends)
    if not len(windows):
        return np.zeros(0, np.uint64), none, none
    place = chosen[windows]
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)))
    heads = np.flatnonzero(new)
    return keys[place[heads]], windows[heads], windows[np.append(heads[1:] - 1, len(windows) - 1)]


def each_window(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All windows of the runs, run by run."""
    counts = last - first + 1
    return np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of every run of equal values."""
    if not len(values):
        return []
    cuts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1], [True]))).tolist()
    return list(zip(cuts[:-1], cuts[1:]))


# --- the index -----------------------------------------------------------------------


class WaveletTree:
    """Rank of any symbol before any place: one bit vector for each bit of the symbols, high bits first.

    A bit vector is packed, with the ones before every 64 bits beside it. Each
    level holds the symbols in the order of the bits above, zeros first.
    """

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = []
        for bit in range(max(n_symbols - 1, 1).bit_length() - 1, -1, -1):
            ones = (symbols >> bit) & 1 == 1
            packed = np.zeros((len(ones) // 64 + 1) * 8, np.uint8)
            bits = np.packbits(ones, bitorder="little")
            packed[: len(bits)] = bits
            packed = packed.view("<u8")
            before = np.zeros(len(packed), np.uint32)
            np.cumsum(np.bitwise_count(packed)[:-1], dtype=np.uint32, out=before[1:])
            self.levels.append((bit, packed, before, len(ones) - int(ones.sum())))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))
        every = np.arange(n_symbols)
        self.begin = self._down(every, np.zeros(n_symbols, np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for bit, packed, before, zeros in self.levels:
            word, rest = places >> 6, (places & 63).astype(np.uint64)
            ones = before[word] + np.bitwise_count(packed[word] & ((np.uint64(1) << rest) - np.uint64(1)))
            places = np.where((symbols >> bit) & 1 == 1, zeros + ones.astype(np.int64), places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self._down(symbols, places) - self.begin[symbols]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order by doubling; zeros are separators, each smaller than the next and than all else."""
    split = text == 0
    rank = np.where(split, np.cumsum(split) - 1, text + split.sum())
    size = 1
    while True:
        second = np.zeros(len(text), np.int64)
        second[:-size] = rank[size:] + 1
        code = rank * (int(rank.max()) + 2) + second
        order = np.argsort(code, kind="stable")
        code = code[order]
        new = np.concatenate(([0], np.cumsum(code[1:] != code[:-1])))
        if new[-1] == len(text) - 1:
            return order
        rank[order] = new
        size *= 2


class FMIndex:
    """Backward search over the Burrows-Wheeler transform of ``text`` (ids from 1, zeros apart)."""

    def __init__(self, text: np.ndarray):
        n_symbols = int(text.max()) + 1
        self.below = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n_symbols))))
        order = suffix_order(text)
        self.tree = WaveletTree(text[order - 1], n_symbols)

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray):
        """The intervals of the strings with one more symbol in front."""
        both = self.tree.rank(np.concatenate((symbols, symbols)), np.concatenate((low, high)))
        base = self.below[symbols]
        return base + both[: len(low)], base + both[len(low) :]

    def shared(self, text: np.ndarray, begins: np.ndarray, length: int) -> np.ndarray:
        """Interval start of each string of ``length`` symbols that has other occurrences, else -1.

        All strings are in the index, so an interval of one suffix is the string itself.
        """
        found = np.full(len(begins), -1, np.int64)
        for c in range(0, len(begins), SEARCHED):
            own = np.arange(c, min(c + SEARCHED, len(begins)))
            symbols = text[begins[own] + length - 1]
            low, high = self.below[symbols], self.below[symbols + 1]
            for k in range(length - 2, -1, -1):
                many = high - low > 1
                own, low, high = own[many], low[many], high[many]
                if not len(own):
                    break
                low, high = self.extend(text[begins[own] + k], low, high)
            many = high - low > 1
            found[own[many]] = low[many]
        return found


def earliest_windows(texts: pa.Array, doc: np.ndarray, place: np.ndarray, window: int):
    """For distinct segments: the segment and offset of each window, and whether it is the earliest of its kind.

    ``doc`` and ``place`` say where the first occurrence of a segment begins.
    """
    lists = pc.split_pattern(texts, " ")
    codes = lists.values.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    sizes = np.diff(lists.offsets.to_numpy())
    begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    text[np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes)] = codes
    counts = sizes - window + 1
    owner = np.repeat(np.arange(len(sizes)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    kind = FMIndex(text).shared(text, begins[owner] + offset, window)
    stays = kind < 0
    at = np.flatnonzero(~stays)
    rank = at[np.lexsort((place[owner[at]] + offset[at], doc[owner[at]], kind[at]))]
    if len(rank):
        stays[rank[np.concatenate(([True], kind[rank][1:] != kind[rank][:-1]))]] = True
    return owner, offset, stays


# --- steps -----------------------------------------------------------------------------

KEYS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary())])
ASKED = pa.schema([("block", pa.int64()), ("shared", pa.binary()), ("hot", pa.binary()), ("stays", pa.binary())])
ROWS = pa.schema(
    [("bucket", pa.int64()), ("segment", pa.string()), ("doc", pa.int64()), ("place", pa.int64()), ("block", pa.int64())]
)
CUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.string()),
    ]
)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _numbers(column, dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *[np.frombuffer(x.as_py(), dtype) for x in column if x.is_valid]])


class Block:
    """Documents of a block in id order, and their segments."""

    def __init__(self, table: pa.Table, window: int, anchor: int):
        table = table.take(pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")]))
        self.number = table["block"][0].as_py()
        self.ids = table["doc_id"].to_numpy()
        self.words = words_of(*text_buffer(table["text"]))
        self.hashes = word_hashes(self.words)
        self.keys, self.first, self.last = segments(self.hashes, self.words.per_row, window, anchor)
        # words before the first row of each id
        self.base = self.words.per_row[np.searchsorted(self.ids, self.ids, "left")]

    def asked_for(self, asked: pa.Table) -> np.ndarray:
        """Segments whose anchor other places share."""
        own, counts = np.unique(self.keys, return_counts=True)
        return np.isin(self.keys, np.concatenate((_numbers(asked["shared"], np.uint64), own[counts > 1])))


def _send_keys(buckets: int, window: int, anchor: int):
    def send(table: pa.Table) -> pa.Table:
        block = Block(table, window, anchor)
        keys = np.unique(block.keys)
        bucket = (keys % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        keys, bucket = keys[order], bucket[order]
        return _table([(int(bucket[a]), block.number, keys[a:b].tobytes()) for a, b in runs(bucket)], KEYS)

    return send


def _answer_keys(hot_blocks: int):
    def answer(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(k.as_py(), np.uint64) for k in table["keys"]]
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        shared, hot = keys[counts > 1], keys[counts > hot_blocks]
        rows = []
        for block, own in zip(table["block"].to_pylist(), parts):
            both = own[np.isin(own, shared, assume_unique=True)]
            if len(both):
                rows.append((block, both.tobytes(), both[np.isin(both, hot, assume_unique=True)].tobytes(), None))
        return _table(rows, ASKED)

    return answer


def _send_segments(buckets: int, window: int, anchor: int):
    def send(docs: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(docs):
            return _table([], ROWS)
        block = Block(docs, window, anchor)
        picked = block.asked_for(asked)
        keys, first, last = block.keys[picked], block.first[picked], block.last[picked]
        apart = np.isin(keys, _numbers(asked["hot"], np.uint64))
        if apart.any():
            single = each_window(first[apart], last[apart])
            keys = np.concatenate((keys[~apart], run_keys(block.hashes, window)[single]))
            first, last = np.concatenate((first[~apart], single)), np.concatenate((last[~apart], single))
            order = np.argsort(first, kind="stable")
            keys, first, last = keys[order], first[order], last[order]
        line, at = block.words.line.tobytes(), block.words.at
        places: dict[bytes, int] = {}
        for i, (a, b) in enumerate(zip(at[first].tolist(), (at[last + window] - 1).tolist())):
            places.setdefault(line[a:b], i)
        own = np.fromiter(places.values(), np.int64, len(places))
        row = np.searchsorted(block.words.per_row, first[own], "right") - 1
        return pa.table(
            [
                pa.array((keys[own] % np.uint64(buckets)).astype(np.int64)),
                pa.array(list(places), pa.binary()).cast(pa.string()),
                pa.array(block.ids[row], pa.int64()),
                pa.array(first[own] - block.base[row], pa.int64()),
                pa.array(np.full(len(own), block.number, np.int64)),
            ],
            schema=ROWS,
        )

    return send


def _search(window: int):
    def search(table: pa.Table) -> pa.Table:
        texts, doc, place, block = (table[n].combine_chunks() for n in ("segment", "doc", "place", "block"))
        doc, place, block = doc.to_numpy(), place.to_numpy(), block.to_numpy()
        owner, offset, stays = earliest_windows(texts, doc, place, window)
        owner, offset = owner[stays], offset[stays]
        # runs of windows that stay, as document, first window, number of windows
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)
        heads = np.flatnonzero(new)
        own = owner[heads]
        found = np.stack([doc[own], place[own] + offset[heads], np.diff(np.append(heads, len(owner)))], axis=1)
        order = np.argsort(block[own], kind="stable")
        found, to = found[order].astype(np.int64), block[own][order]
        return _table([(int(to[a]), None, None, found[a:b].tobytes()) for a, b in runs(to)], ASKED)

    return search


def _cut_out(window: int, anchor: int):
    def cut(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return _table([], CUT)
        block = Block(docs, window, anchor)
        line, at, per_row = block.words
        picked = block.asked_for(answers)
        gone = np.zeros(len(at) + 1, bool)
        gone[each_window(block.first[picked], block.last[picked])] = True
        stays = _numbers(answers["stays"], np.int64).reshape(-1, 3)
        first = block.base[np.searchsorted(block.ids, stays[:, 0], "left")] + stays[:, 1]
        gone[each_window(first, first + stays[:, 2] - 1)] = False
        change = np.zeros(len(at) + window, np.int32)
        begins = np.flatnonzero(gone)
        change[begins] += 1
        change[begins + window] -= 1
        removed = np.cumsum(change)[: len(at) - 1] > 0
        before = np.concatenate(([0], np.cumsum(removed)))
        # maximal runs of removed words, cut where a row begins
        heads, tails = removed.copy(), removed.copy()
        heads[1:] &= ~removed[:-1]
        tails[:-1] &= ~removed[1:]
        borders = per_row[(per_row > 0) & (per_row < len(removed))]
        heads[borders] |= removed[borders]
        tails[borders - 1] |= removed[borders - 1]
        heads, tails = np.flatnonzero(heads), np.flatnonzero(tails) + 1
        spans = np.searchsorted(heads, per_row, "left").astype(np.int32)
        base = np.repeat(per_row[:-1], np.diff(spans))
        kept = line[np.repeat(~removed, np.diff(at))].tobytes()
        ends = np.concatenate(([0], np.cumsum(np.where(removed, 0, np.diff(at)))))[per_row].tolist()
        return pa.table(
            [
                pa.array(block.ids, pa.int64()),
                pa.array(np.diff(per_row).astype(np.int64)),
                pa.array((before[per_row[1:]] - before[per_row[:-1]]).astype(np.int64)),
                pa.ListArray.from_arrays(
                    pa.array(spans),
                    pa.StructArray.from_arrays([pa.array(heads - base), pa.array(tails - base)], ["start", "end"]),
                ),
                pa.array([kept[a : max(a, b - 1)] for a, b in zip(ends[:-1], ends[1:])], pa.binary()).cast(pa.string()),
            ],
            schema=CUT,
        )

    return cut


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {kinds.get(f.type, 'array<struct<start:bigint,end:bigint>>')}" for f in schema)


def remove_repeated_windows(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
    hot_blocks: int = HOT_BLOCKS,
) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept`` of every row of ``docs``.

    ``spans`` are the maximal removed runs in words, ``kept`` the words that stay
    with one blank between. Blocks and shards are sized by the bytes of all texts,
    which one pass counts; the ids are longs.
    """
    rows = id_and_text(docs, id_col=id_col, text_col=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks, buckets = size // block_bytes + 1, size // shard_bytes + 1
    named = rows.filter("doc_id is not null").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
    named = named.repartition("block")
    by_block = named.groupBy("block")
    keys = by_block.applyInArrow(_send_keys(buckets, window, anchor), _ddl(KEYS))
    asked = keys.groupBy("bucket").applyInArrow(_answer_keys(hot_blocks), _ddl(ASKED))
    sent = by_block.cogroup(asked.groupBy("block")).applyInArrow(_send_segments(buckets, window, anchor), _ddl(ROWS))
    # a document sends each of its segments once, so the places of the smallest id are one place
    distinct = sent.groupBy("bucket", "segment").agg(
        F.min("doc").alias("doc"), F.min_by("place", "doc").alias("place"), F.min_by("block", "doc").alias("block")
    )
    stays = distinct.groupBy("bucket").applyInArrow(_search(window), _ddl(ASKED))
    answers = asked.select(*ASKED.names).unionByName(stays)
    cut = by_block.cogroup(answers.groupBy("block")).applyInArrow(_cut_out(window, anchor), _ddl(CUT))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"))
    alone = rows.filter("doc_id is null").select(
        "doc_id",
        F.size(words).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
        F.array_join(words, " ").alias("kept"),
    )
    return cut.unionByName(alone)
