"""Benchmark decontamination: MinHash containment search by item size, then an exact check.

A text is its set of five-word shingles. A document that holds at least a share
t of an item's n shingles misses at most n - ceil(t n) of them, so it holds one
of the n - ceil(t n) + 1 shingles with the smallest hashes: that MinHash sketch,
whose length follows from the size of the item, finds every document, however
long. Items are partitioned by size class; a class shares its sketch length and
skips the documents too short for it. Candidates are verified by counting the
item's own shingles, as strings, in the document.

The benchmark is broadcast in blocks of bounded bytes, as plain lists and arrays;
every block meets all documents, and no document is shuffled.

Words are maximal runs of letters and digits in lower case. Defined results: an item
of fewer than five words is held by a document that has all of them in a row; a
document of fewer than five words holds only such items; an item or
document without a word, or a null one, matches nothing; repeated documents give
their rows each, repeated items (same id and text) count once; empty tables give
no row; ids may be null.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.llm.common import mixed, run_hashes, slices, text_buffer, travels, with_fields

travels(__name__)

WORDS, THRESHOLD = 5, 0.8
BLOCK_BYTES = 16_000_000
SLICE_BYTES = 2_000_000
FILTER_BITS = 20
# word characters after lower case: ASCII letters and digits, and all beyond Latin-1
# signs and general punctuation
WORD = re.compile("[a-z0-9À-῿⁀-\U0010ffff]+")
WORD_FACTORS = (0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 1)


def words_in(lowered: str) -> list[str]:
    return WORD.findall(lowered)


def words_of(text: str) -> list[str]:
    return words_in(pc.utf8_lower(pa.scalar(text)).as_py())


def shingles(words: list[str]) -> set[str]:
    if len(words) < WORDS:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + WORDS]) for i in range(len(words) - WORDS + 1)}


# --- hashes of all words of a buffer ---------------------------------------------------


def word_mask(data: np.ndarray) -> np.ndarray:
    """Which bytes of lower-case UTF-8 belong to a word."""
    inside = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
    latin = np.flatnonzero(data == 0xC2)  # U+0080 to U+00BF
    inside[latin] = False
    inside[latin + 1] = False
    general = np.flatnonzero(data == 0xE2)  # U+2000 to U+203F
    general = general[data[general + 1] == 0x80]
    for k in range(3):
        inside[general + k] = False
    return inside


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of words before each document (one more at the end)."""
    return run_hashes(data, word_mask(data), starts)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of each run of five words; the caller drops runs across a border."""
    n = len(words) - WORDS + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k, factor in enumerate(WORD_FACTORS):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[k : k + n] * np.uint64(factor)
    return mixed(total)


def _hash_shingle(shingle: str) -> int:
    data = np.frombuffer(shingle.encode(), np.uint8)
    words, _ = word_hashes(data, np.array([0, len(data)]))
    return int(shingle_hashes(words)[0])


# --- index of one block of items -------------------------------------------------------


class Sketches(NamedTuple):
    """Sketch hashes of one block of items and the shingles to verify with; plain values, so that it can be broadcast.

    ``items`` are key and shingles, ``least`` the shared shingles that make a document
    hold an item, ``short`` the items of fewer than five words by their words, and
    ``classes`` the sketch hashes by size class.
    """

    items: list
    least: list
    short: dict
    classes: list


def sketches_of(items: list[tuple]) -> Sketches:
    kept = [(key, found) for key, text in items if (found := shingles(words_of(text)))]
    least = [math.ceil(THRESHOLD * len(found) - 1e-9) for _, found in kept]
    short: dict[int, dict[str, list[int]]] = {}
    classes: dict[int, list[int]] = {}
    for i, (_, found) in enumerate(kept):
        only = next(iter(found))
        if len(found) == 1 and only.count(" ") < WORDS - 1:
            short.setdefault(only.count(" ") + 1, {}).setdefault(only, []).append(i)
        else:
            classes.setdefault(len(found).bit_length(), []).append(i)
    return Sketches(kept, least, short, [_class(kept, least, c, rows) for c, rows in sorted(classes.items())])


def _class(items: list, least: list, size_class: int, rows: list[int]):
    """Fewest shingles a document must have, sorted sketch hashes, the item of each, and a bit filter."""
    biggest = (1 << size_class) - 1
    length = biggest - math.ceil(THRESHOLD * biggest - 1e-9) + 1
    pairs = []
    for i in rows:
        hashed = sorted(_hash_shingle(s) for s in items[i][1])
        pairs += [(h, i) for h in hashed[:length]]
    pairs.sort()
    hashes = np.array([h for h, _ in pairs], np.uint64)
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return min(least[i] for i in rows), hashes, np.array([i for _, i in pairs]), bits


def _candidates(classes: list, words: np.ndarray, before: np.ndarray) -> set[tuple[int, int]]:
    """Pairs of document and item that share a sketch hash."""
    hashed = shingle_hashes(words)
    found = set()
    for least, hashes, items, bits in classes:
        at = np.flatnonzero(bits[(hashed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        low = np.searchsorted(hashes, hashed[at], "left")
        high = np.searchsorted(hashes, hashed[at], "right")
        hit = high > low
        at, low, high = at[hit], low[hit], high[hit]
        doc = np.searchsorted(before, at, "right") - 1
        whole = (at + WORDS <= before[doc + 1]) & (before[doc + 1] - before[doc] - WORDS + 1 >= least)
        for d, a, b in zip(doc[whole].tolist(), low[whole].tolist(), high[whole].tolist()):
            found.update((d, int(i)) for i in items[a:b])
    return found


def _held_short(short: dict, words: list[str]) -> set[int]:
    """Items of fewer than five words that stand in a row somewhere among the words."""
    found: set[int] = set()
    for n, items in short.items():
        for k in range(len(words) - n + 1):
            found.update(items.get(" ".join(words[k : k + n]), ()))
    return found


def matches(sketches: Sketches, column: pa.Array) -> Iterator[tuple[int, int, int]]:
    """Row, item and number of shared shingles of all rows that hold an item."""
    lowered = pc.utf8_lower(pc.fill_null(column, ""))
    data, starts = text_buffer(lowered)
    firsts = {only.split(" ")[0] for items in sketches.short.values() for only in items}
    near_short = re.compile("|".join(map(re.escape, sorted(firsts)))) if firsts else None
    for a, b in slices(np.diff(starts), SLICE_BYTES):
        words, before = word_hashes(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
        pairs = _candidates(sketches.classes, words, before)
        row, own = -1, []
        for doc, i in sorted(pairs):
            if doc != row:
                row, found = doc, shingles(words_in(lowered[a + doc].as_py()))
            shared = len(sketches.items[i][1] & found)
            if shared >= sketches.least[i]:
                yield a + doc, i, shared
        for doc in range(a, b) if near_short else ():
            text = lowered[doc].as_py()
            if near_short.search(text):
                own = words_in(text)
                for i in sorted(_held_short(sketches.short, own)):
                    yield doc, i, 1


def _search(text: str, index, kept: list[str]):
    def search(batches):
        sketches = index.value
        for batch in batches:
            rows, items, shared = [], [], []
            for row, i, n in matches(Sketches(*sketches), batch.column(batch.schema.get_field_index(text))):
                rows.append(row)
                items.append(i)
                shared.append(n)
            taken = batch.select(kept).take(pa.array(rows, pa.int64()))
            keys = [sketches[0][i][0] for i in items]
            sizes = [len(sketches[0][i][1]) for i in items]
            yield pa.RecordBatch.from_arrays(
                [
                    *taken.columns,
                    pa.array(keys, pa.int64()),
                    pa.array(shared, pa.int64()),
                    pa.array(sizes, pa.int64()),
                ],
                [*kept, "item_id", "n_shared", "n_item"],
            )

    return search


def item_blocks(items: DataFrame, *, id_col="item_id", text_col="text") -> Iterator[list[tuple]]:
    """Items in blocks of bounded bytes, one block on the driver at a time."""
    rows = items.select(items[id_col].cast("bigint"), items[text_col]).filter(items[text_col].isNotNull())
    block, size = [], 0
    for key, text in rows.distinct().toLocalIterator():
        block.append((key, text))
        size += len(text)
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    yield block


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item`` for each document of ``docs`` that holds an item of ``items``.

    ``docs`` has ``doc_id, text``; ``items`` has ``item_id, text``.
    """
    narrow = docs.select("doc_id", "text")
    out = None
    schema = with_fields(docs.select("doc_id").schema, "item_id bigint, n_shared bigint, n_item bigint")
    for block in item_blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(tuple(sketches_of(block)))
        found = narrow.mapInArrow(_search("text", shared, ["doc_id"]), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _flag(text: str, index):
    def flag(batches):
        sketches = index.value
        for batch in batches:
            hit = np.zeros(len(batch), bool)
            for row, _, _ in matches(Sketches(*sketches), batch.column(batch.schema.get_field_index(text))):
                hit[row] = True
            yield batch.filter(pa.array(~hit))

    return flag


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; nothing is shuffled."""
    for block in item_blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(tuple(sketches_of(block)))
        docs = docs.mapInArrow(_flag("text", shared), docs.schema)
    return docs
