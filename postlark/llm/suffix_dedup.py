"""Exact substring removal with a logarithmic family of suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller id. The work is dealt out in three steps, and no text
leaves its block of documents but where a repeat is possible:

1. Documents are blocked by id. Among the hashes of all ``anchor``-byte strings
   each window of ``length`` bytes keeps its smallest (its anchor), so equal
   windows share their anchor. A block sends its distinct anchor hashes, packed,
   to the task of their bucket, which answers with those that other blocks hold.
2. For those anchors a block sends the strings that their windows span. A bucket
   reads them in ascending block order. A string seen whole in an earlier block is
   a repeat throughout. Else its windows are suffixes of a new batch: the batch
   gets a suffix array, is merge-scanned against the levels of the family for
   equal windows of earlier blocks, and becomes a level itself; levels of equal
   size merge, so that there are logarithmically many.
3. The repeats go back to their block, which cuts them out.

Repeats between documents of one block are found by the same family inside the
block. The windows of an anchor in very many blocks are dealt out in two halves,
each by the anchor and the bytes on the side where all of its windows go on, so
that one hot string with many contexts does not fill one task.

Messages are small: keys travel with 32 bits and are answered with one bit each,
numbers travel byte by byte, spans as maximal runs. Along with its keys a block sends
128-bit digests of its segments, runs of anchors that end where the text says so. A
segment that an earlier block holds is a repeat throughout, and sends no strings: the
first block that holds it has all of its windows.

Defined results: a null or short text loses nothing; documents that share an id
do not count as earlier for each other; a row without an id loses nothing and
removes nothing; an empty table gives no row.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlark.llm.common import BASE, mixed, slices, text_buffer, travels

travels(__name__)

LENGTH, ANCHOR = 50, 24
BLOCK_DOCS = 1024
# the windows of an anchor in so many blocks are dealt out in halves
HOT_BLOCKS = 512
BATCH_STRINGS = 4096
# a segment ends before one in so many anchors, by bits that do not decide what is an anchor
SEGMENT_ANCHORS, DIGEST_BYTES = 16, 16
# of a string's key so many bytes travel: keys only spare work, strings decide
KEY_BYTES = 3
SLICE_BYTES = 1_000_000
# a longer document is cut for its anchors, whose places have 24 bits
LONG_BYTES = 1 << 22


# --- anchors -------------------------------------------------------------------------


def string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of the string of ``length`` bytes at each position that has one."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, done, level, size, factor = None, 0, data.astype(np.uint64) + np.uint64(1), 1, BASE
    rest = length
    while rest:  # powers of two, joined into the length
        if rest & 1:
            part = level[done : done + n]
            total = part.copy() if total is None else total * np.uint64(factor) + part
            done += size
        rest >>= 1
        if rest:
            level = level[:-size] * np.uint64(factor) + level[size:]
            factor = factor * factor % (1 << 64)
            size *= 2
    return mixed(total)


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each run of ``width`` values."""
    n = len(values) - width + 1
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:n], values[width - size : width - size + n])


def at_hashes(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """`string_hashes` at some positions only."""
    factors = np.array([pow(BASE, length - 1 - i, 1 << 64) for i in range(length)], np.uint64)
    total = np.zeros(len(at), np.uint64)
    for i, factor in enumerate(factors):
        total += (data[at + i] + np.uint64(1)) * factor
    return mixed(total)


def anchors(data: np.ndarray, starts: np.ndarray, length: int, anchor: int):
    """Anchors of all windows within documents: their hashes and places, and first and last window of each.

    ``data`` holds the documents end to end, fewer than 2^24 bytes in all.
    """
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return np.zeros(0, np.uint64), none, none, none
    hashes = string_hashes(data, anchor)
    low = np.uint64((1 << 24) - 1)
    # the smallest hash, the first position among equal ones
    ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    chosen = (smallest(ranked, length - anchor + 1) & low).astype(np.int64)
    window = np.arange(n)
    doc = np.searchsorted(starts, window, "right") - 1
    whole = window + length <= starts[doc + 1]
    window, chosen, doc = window[whole], chosen[whole], doc[whole]
    if not len(window):
        return np.zeros(0, np.uint64), none, none, none
    new = np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)))
    first = window[new]
    last = window[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(window) - 1]))]
    return hashes[chosen[new]], chosen[new], first, last


def block_anchors(data: np.ndarray, starts: np.ndarray, length: int, anchor: int):
    """Hashes of the anchors of a whole block, and first and last window of each."""
    keys, _, first, last = placed_anchors(data, starts, length, anchor)
    return keys, first, last


def placed_anchors(data: np.ndarray, starts: np.ndarray, length: int, anchor: int):
    """`anchors` of a whole block, in slices of whole documents; long documents in pieces."""
    keys = [np.zeros(0, np.uint64)]
    place, first, last = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    pieces = []
    for a, b in slices(np.diff(starts), SLICE_BYTES):
        begin, end = int(starts[a]), int(starts[b])
        if end - begin <= LONG_BYTES:
            pieces.append((begin, end, starts[a : b + 1] - begin))
            continue
        # a slice this long holds a long document, perhaps among empty ones: pieces that share all but one byte of a window
        for begin, end in zip(starts[a:b].tolist(), starts[a + 1 : b + 1].tolist()):
            for p in range(begin, end - length + 1, LONG_BYTES):
                q = min(end, p + LONG_BYTES + length - 1)
                pieces.append((p, q, np.array([0, q - p])))
    for begin, end, own in pieces:
        k, p, f, t = anchors(data[begin:end], own, length, anchor)
        keys.append(k)
        place.append(p + begin)
        first.append(f + begin)
        last.append(t + begin)
    return np.concatenate(keys), np.concatenate(place), np.concatenate(first), np.concatenate(last)


def halves(data, place, first, last, length: int, anchor: int):
    """The windows of each anchor in two halves: key, first and last window, and the anchor's number.

    A window that begins at least ``reach`` bytes before its anchor holds all of these bytes,
    another one the bytes behind the anchor that the first half may lack. Equal windows are of
    the same half, and share its key.
    """
    reach = (length - anchor) // 2
    middle = place - reach  # the last window of the first half
    left, right = np.flatnonzero(first <= middle), np.flatnonzero(last > middle)
    keys = (
        at_hashes(data, middle[left], anchor + reach),
        at_hashes(data, place[right], length - reach + 1),
    )
    begin = (first[left], np.maximum(first, middle + 1)[right])
    end = (np.minimum(last, middle)[left], last[right])
    return tuple(map(np.concatenate, (keys, begin, end, (left, right))))


# --- the family ------------------------------------------------------------------------


class Family:
    """Sorted windows of earlier batches in levels whose sizes double; equal sizes merge."""

    def __init__(self, length: int):
        self.kind = f"S{length}"
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def scan(self, windows: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Which of the sorted ``windows`` some level holds from a smaller ``order``."""
        found = np.zeros(len(windows), bool)
        for held, least in self.levels:
            at = np.minimum(np.searchsorted(held, windows), len(held) - 1)
            found |= (held[at] == windows) & (least[at] < order)
        return found

    def add(self, windows: np.ndarray, order: np.ndarray) -> None:
        """Put a suffix array behind the levels; ``windows`` sorted, equal ones by ``order``."""
        level = _distinct(windows, order)
        while self.levels and len(self.levels[-1][0]) <= 2 * len(level[0]):
            held = self.levels.pop()
            joined, least = np.concatenate((held[0], level[0])), np.concatenate((held[1], level[1]))
            rank = np.lexsort((least, joined))
            level = _distinct(joined[rank], least[rank])
        self.levels.append(level)


def _distinct(windows: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.ones(len(windows), bool)
    new[1:] = windows[1:] != windows[:-1]
    return windows[new], order[new]


def windows_of(strings: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the strings as one array, and the string of each."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    data = np.frombuffer(b"".join(strings), np.uint8)
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(strings)), counts)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    at += np.repeat(np.cumsum(sizes) - sizes, counts)
    rows = np.lib.stride_tricks.sliding_window_view(data, length)[at] if len(at) else np.zeros((0, length), np.uint8)
    return np.ascontiguousarray(rows).view(f"S{length}").reshape(-1), owner


def repeats(strings: list[bytes], keys: np.ndarray, order: np.ndarray, length: int):
    """Windows that an earlier string holds, as string number, first and last window.

    ``order`` ascends; a string is earlier than another if its order is smaller.
    Only strings that share their key can share a window.
    """
    seen: dict[bytes, int] = {}
    whole, fresh = [], []
    for i, s in enumerate(strings):
        if seen.setdefault(s, int(order[i])) < order[i]:
            whole.append(i)
        else:
            fresh.append(i)
    out = [(i, 0, len(strings[i]) - length) for i in whole]
    # a key with one distinct string has no other place to match
    distinct: dict[int, bytes] = {}
    several = set()
    for i in fresh:
        key = int(keys[i])
        if distinct.setdefault(key, strings[i]) != strings[i]:
            several.add(key)
    fresh = [i for i in fresh if int(keys[i]) in several]
    family = Family(length)
    at = 0
    while at < len(fresh):
        end = min(at + BATCH_STRINGS, len(fresh))
        while end < len(fresh) and order[fresh[end]] == order[fresh[end - 1]]:
            end += 1
        batch = np.array(fresh[at:end])
        windows, owner = windows_of([strings[i] for i in batch], length)
        rank = np.lexsort((order[batch][owner], windows))
        windows, at_order = windows[rank], order[batch][owner][rank]
        found = family.scan(windows, at_order)
        # within the batch: the smallest order of equal windows stands first
        new = np.ones(len(windows), bool)
        new[1:] = windows[1:] != windows[:-1]
        least = at_order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(new) else at_order
        found |= least < at_order
        family.add(windows, at_order)
        hit = np.zeros(len(windows), bool)
        hit[rank] = found
        out += _runs(hit, owner, batch)
        at = end
    return out


def _runs(hit: np.ndarray, owner: np.ndarray, batch: np.ndarray):
    """Runs of hit windows of each string."""
    if not hit.any():
        return []
    position = np.arange(len(owner)) - np.searchsorted(owner, owner, "left")
    at = np.flatnonzero(hit)
    new = np.concatenate(([True], (owner[at][1:] != owner[at][:-1]) | (at[1:] != at[:-1] + 1)))
    first = at[new]
    last = at[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(at) - 1]))]
    return list(zip(batch[owner[first]].tolist(), position[first].tolist(), position[last].tolist()))


# --- steps on a block ------------------------------------------------------------------


def _ordered(table: pa.Table) -> pa.Table:
    """The rows of a block in the one order that every step uses."""
    return table.take(pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")]))


def _block(table: pa.Table):
    table = _ordered(table)
    data, starts = text_buffer(table["text"])
    ids = table["doc_id"].to_numpy()
    return table, data, starts, ids


def _packed(rows: list[tuple], names: list[str], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, schema.field(n).type) for c, n in zip(columns, names)], names)


KEYS_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("segments", pa.binary())]
)
ASKED_SCHEMA = pa.schema(
    [
        ("block", pa.int64()),
        ("bucket", pa.int32()),
        ("shared", pa.binary()),
        ("hot", pa.binary()),
        ("earlier", pa.binary()),
    ]
)
STRINGS_SCHEMA = pa.schema(
    [
        ("bucket", pa.int32()),
        ("block", pa.int64()),
        ("local", pa.bool_()),
        ("n", pa.int32()),
        ("keys", pa.binary()),
        ("numbers", pa.binary()),
        ("strings", pa.binary()),
    ]
)
SPANS_SCHEMA = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("spans", pa.binary())])


def short_keys(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key, and in the low half 32 bits that tell keys of a bucket apart.

    Two keys with the same bits are dealt out as one, which costs work but no result:
    strings decide.
    """
    rest = (keys // np.uint64(buckets)) & np.uint64((1 << 32) - 1)
    return (keys % np.uint64(buckets)) << np.uint64(32) | rest


def bucket_cuts(short: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted short keys, and where the last ends."""
    borders = np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)
    return np.searchsorted(short, borders)


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of small numbers of one length, byte by byte, so that equal high bytes cost little."""
    planes = np.stack(columns).astype("<u8").view(np.uint8).reshape(len(columns), -1, 8)
    return pa.Codec("zstd", 1).compress(np.ascontiguousarray(planes.transpose(0, 2, 1)), asbytes=True)


def spread(packed: bytes, n_columns: int, n: int) -> np.ndarray:
    """The columns that were `squeezed`, as rows of an array."""
    planes = pa.decompress(packed, n_columns * n * 8, codec="zstd", asbytes=True)
    planes = np.frombuffer(planes, np.uint8).reshape(n_columns, 8, n).transpose(0, 2, 1)
    return np.ascontiguousarray(planes).view("<u8").reshape(n_columns, n).astype(np.int64)


def packed_spans(begins: np.ndarray, ends: np.ndarray) -> tuple[int, bytes]:
    """Number and bytes of the maximal runs that the spans cover: the gap before each, and its length."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], begins[1:] > ends[:-1]))
    begins, ends = begins[new], ends[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(ends) - 1]))]
    return len(begins), squeezed(begins - np.concatenate(([0], ends[:-1])), ends - begins)


def spans_of(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs in rows of `packed_spans`."""
    begins, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n, packed in zip(found["n"].to_pylist(), found["spans"].to_pylist()):
        gaps, sizes = spread(packed, 2, n)
        stops = np.cumsum(gaps + sizes)
        begins.append(stops - sizes)
        ends.append(stops)
    return np.concatenate(begins), np.concatenate(ends)


def segments(data: np.ndarray, keys, first, last, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The first anchor of each segment of a block (one more at the end), and the digests of all."""
    if not len(keys):
        return np.zeros(1, np.int64), np.zeros(0, f"S{DIGEST_BYTES}")
    ends = (keys[1:] % np.uint64(SEGMENT_ANCHORS) == 0) | (first[1:] != last[:-1] + 1)
    cuts = np.concatenate(([0], np.flatnonzero(ends) + 1, [len(keys)]))
    text = memoryview(np.ascontiguousarray(data))
    digests = [
        blake2b(text[a : b + length], digest_size=DIGEST_BYTES).digest()
        for a, b in zip(first[cuts[:-1]].tolist(), last[cuts[1:] - 1].tolist())
    ]
    return cuts, np.frombuffer(b"".join(digests), f"S{DIGEST_BYTES}")


def dealt_digests(digests: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct digests by bucket, the place of each digest among them, and where each bucket begins."""
    some, number = np.unique(digests, return_inverse=True)
    bucket = some.view("<u8").reshape(-1, DIGEST_BYTES // 8)[:, 0] % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(some), np.int64)
    place[order] = np.arange(len(some))
    return some[order], place[number], np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


def _send_keys(buckets: int, length: int, anchor: int):
    def send(table: pa.Table) -> pa.Table:
        table, data, starts, _ = _block(table)
        block = table["block"][0].as_py()
        keys, first, last = block_anchors(data, starts, length, anchor)
        digests, _, ends = dealt_digests(segments(data, keys, first, last, length)[1], buckets)
        short = np.unique(short_keys(keys, buckets))
        cuts = bucket_cuts(short, buckets)
        keys = short.astype(np.uint32)
        rows = [
            (k, block, keys[cuts[k] : cuts[k + 1]].tobytes(), digests[ends[k] : ends[k + 1]].tobytes())
            for k in range(buckets)
            if cuts[k] < cuts[k + 1] or ends[k] < ends[k + 1]
        ]
        return _packed(rows, KEYS_SCHEMA.names, KEYS_SCHEMA)

    return send


def _answer_keys(hot_blocks: int):
    def answer(table: pa.Table) -> pa.Table:
        blocks = table["block"].to_pylist()
        bucket = table["bucket"][0].as_py()
        parts = [np.frombuffer(k.as_py(), np.uint32) for k in table["keys"]]
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        digests = [np.frombuffer(d.as_py(), f"S{DIGEST_BYTES}") for d in table["segments"]]
        some, number = np.unique(np.concatenate(digests), return_inverse=True)
        holder = np.repeat(np.array(blocks, np.int64), list(map(len, digests)))
        least = np.full(len(some), np.iinfo(np.int64).max)
        np.minimum.at(least, number, holder)
        earlier = np.split(least[number] < holder, np.cumsum(list(map(len, digests)))[:-1])

        def bits(flags: np.ndarray) -> bytes:
            return np.packbits(flags).tobytes() if flags.any() else b""

        rows = []
        for block, own, before in zip(blocks, parts, earlier):  # one bit for each in the order in which the block has them
            held = counts[np.searchsorted(keys, own)]
            shared, hot = held > 1, held > hot_blocks
            if shared.any() or before.any():
                rows.append((block, bucket, bits(shared), bits(hot), bits(before)))
        return _packed(rows, ASKED_SCHEMA.names, ASKED_SCHEMA)

    return answer


def _answered(asked: pa.Table, name: str, cuts: np.ndarray) -> np.ndarray:
    """The bits that the buckets answered for what a block has in each, bucket by bucket."""
    flags = np.zeros(cuts[-1], bool)
    for bucket, own in zip(asked["bucket"].to_pylist(), asked[name].to_pylist()):
        if own:
            a, b = cuts[bucket], cuts[bucket + 1]
            flags[a:b] = np.unpackbits(np.frombuffer(own, np.uint8), count=b - a)
    return flags


def _send_strings(buckets: int, length: int, anchor: int):
    def send(docs: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(docs):
            return _packed([], STRINGS_SCHEMA.names, STRINGS_SCHEMA)
        docs, data, starts, ids = _block(docs)
        block = docs["block"][0].as_py()
        keys, anchored, first, last = placed_anchors(data, starts, length, anchor)
        text = data.tobytes()
        doc = ids[np.searchsorted(starts, first, "right") - 1]
        rows = []
        # segments that an earlier block holds: repeats throughout, whose windows need no other place
        cuts, digests = segments(data, keys, first, last, length)
        _, place, ends = dealt_digests(digests, buckets)
        gone = _answered(asked, "earlier", ends)[place]
        begins, stops = first[cuts[:-1]][gone], last[cuts[1:] - 1][gone] + length
        kept = np.repeat(~gone, np.diff(cuts))
        short, number = np.unique(short_keys(keys, buckets), return_inverse=True)
        cuts = bucket_cuts(short, buckets)
        shared, hot = (_answered(asked, name, cuts)[number][kept] for name in ("shared", "hot"))
        keys, anchored, first, last, doc = (x[kept] for x in (keys, anchored, first, last, doc))
        # repeats inside the block: anchors of several documents
        order = np.lexsort((doc, keys))
        same = np.zeros(len(keys), bool)
        if len(keys):
            ranked = keys[order]
            new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
            group = np.cumsum(new) - 1
            heads, tails = np.flatnonzero(new), np.concatenate((np.flatnonzero(new)[1:] - 1, [len(keys) - 1]))
            same[order] = (doc[order][heads] != doc[order][tails])[group]
        at = np.flatnonzero(same)  # anchors ascend with the documents
        strings = [text[a : b + length] for a, b in zip(first[at].tolist(), last[at].tolist())]
        found = repeats(strings, keys[at], doc[at], length)
        if found:
            number, a, b = (np.array(x, np.int64) for x in zip(*found))
            begins = np.concatenate((begins, first[at][number] + a))
            stops = np.concatenate((stops, first[at][number] + b + length))
        if len(begins):
            n, spans = packed_spans(begins, stops)
            rows.append((block % buckets, block, True, n, b"", spans, b""))
        # repeats of earlier blocks: one copy of each string, where its first document has it
        at = np.flatnonzero(shared)
        apart = hot[at]
        cold, at = at[~apart], at[apart]
        key, begin, end, owner = halves(data, anchored[at], first[at], last[at], length, anchor)
        key, owner = np.concatenate((keys[cold], key)), np.concatenate((cold, at[owner]))
        begin, end = np.concatenate((first[cold], begin)), np.concatenate((last[cold], end))
        order = np.argsort(begin, kind="stable")
        key, begin, end, owner = key[order], begin[order], end[order], doc[owner[order]]
        sent: dict[bytes, int] = {}
        kept, strings = [], []
        for i, (a, b, who) in enumerate(zip(begin.tolist(), end.tolist(), owner.tolist())):
            string = text[a : b + length]
            if sent.setdefault(string, who) == who:
                kept.append(i)
                strings.append(string)
        if kept:
            key, place = short_keys(key[kept], buckets), begin[kept]
            bucket = key >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")  # places ascend within a bucket
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            marks = key.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :KEY_BYTES]
            codec = pa.Codec("zstd", 3)
            for k in range(buckets):
                own = order[cuts[k] : cuts[k + 1]]
                if len(own):
                    some = [strings[i] for i in own.tolist()]
                    sizes = np.fromiter(map(len, some), np.int64, len(some))
                    numbers = squeezed(np.diff(place[own], prepend=0), sizes)
                    joined = codec.compress(b"".join(some), asbytes=True)
                    rows.append((k, block, False, len(own), marks[own].tobytes(), numbers, joined))
        return _packed(rows, STRINGS_SCHEMA.names, STRINGS_SCHEMA)

    return send


def _find_repeats(length: int):
    def find(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        strings, keys, places, blocks, rows = [], [], [], [], []
        for row in range(len(table)):
            block, local, n, key, numbers, joined = (
                table[c][row].as_py() for c in ("block", "local", "n", "keys", "numbers", "strings")
            )
            if local:
                rows.append((block, n, numbers))
                continue
            gaps, sizes = spread(numbers, 2, n)
            ends = np.cumsum(sizes)
            joined = pa.decompress(joined, int(ends[-1]), codec="zstd", asbytes=True)
            strings += [joined[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            marks = np.zeros((n, 4), np.uint8)
            marks[:, :KEY_BYTES] = np.frombuffer(key, np.uint8).reshape(n, KEY_BYTES)
            keys.append(marks.view("<u4").reshape(-1))
            places.append(np.cumsum(gaps))
            blocks.append(np.full(n, block, np.int64))
        if strings:
            order = np.concatenate(blocks)
            found = repeats(strings, np.concatenate(keys), order, length)
            if found:
                number, a, b = (np.array(x, np.int64) for x in zip(*found))
                place = np.concatenate(places)[number]
                owner = order[number]
                rank = np.argsort(owner, kind="stable")
                begins, ends, owner = (place + a)[rank], (place + b + length)[rank], owner[rank]
                cuts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True])))
                rows += [(int(owner[a]), *packed_spans(begins[a:b], ends[a:b])) for a, b in zip(cuts, cuts[1:])]
        return _packed(rows, SPANS_SCHEMA.names, SPANS_SCHEMA)

    return find


def _cut_out(docs: pa.Table, found: pa.Table) -> pa.Table:
    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    if not len(docs):
        return pa.table([pa.array([], t) for t in CUT_TYPES], names)
    docs, data, starts, _ = _block(docs)
    span_begins, span_ends = spans_of(found)
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, span_begins, 1)
    np.add.at(change, span_ends, -1)
    gone = np.cumsum(change[:-1]) > 0
    sizes = np.diff(starts)
    removed = np.concatenate(([0], np.cumsum(gone)))
    n_removed = removed[starts[1:]] - removed[starts[:-1]]
    # maximal runs: they begin where a byte goes after one that stays, or at a document's start
    begins, ends = gone.copy(), gone.copy()
    begins[1:] &= ~gone[:-1]
    ends[:-1] &= ~gone[1:]
    borders = starts[(starts > 0) & (starts < len(data))]
    begins[borders] |= gone[borders]
    ends[borders - 1] |= gone[borders - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    per_doc = np.searchsorted(first, starts, "left").astype(np.int32)
    base = np.repeat(starts[:-1], np.diff(per_doc))
    runs = pa.StructArray.from_arrays([pa.array(first - base), pa.array(last - base)], ["start", "end"])
    kept = data[~gone].tobytes()
    kept_starts = starts - removed[starts]
    texts = [kept[a:b] for a, b in zip(kept_starts[:-1].tolist(), kept_starts[1:].tolist())]
    return pa.table(
        [
            docs["doc_id"].combine_chunks(),
            pa.array(sizes),
            pa.array(n_removed),
            pa.ListArray.from_arrays(pa.array(per_doc), runs),
            pa.array(texts, pa.binary()),
        ],
        names,
    )


CUT_TYPES = [
    pa.int64(),
    pa.int64(),
    pa.int64(),
    pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
    pa.binary(),
]


def remove_repeats(
    docs: DataFrame,
    *,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    block_docs: int = BLOCK_DOCS,
    hot_blocks: int = HOT_BLOCKS,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` of ``docs`` (``doc_id bigint, text``).

    ``spans`` are the maximal removed runs in bytes and ``kept`` the bytes that
    stay. Blocks hold ``block_docs`` successive ids.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.filter("doc_id is not null").select(
        "doc_id", "text", F.floor(F.col("doc_id") / block_docs).cast("bigint").alias("block")
    )
    blocks = named.repartition("block")
    keys = blocks.groupBy("block").applyInArrow(
        _send_keys(buckets, length, anchor), "bucket int, block bigint, keys binary, segments binary"
    )
    asked = keys.groupBy("bucket").applyInArrow(
        _answer_keys(hot_blocks), "block bigint, bucket int, shared binary, hot binary, earlier binary"
    )
    strings = blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        _send_strings(buckets, length, anchor),
        "bucket int, block bigint, local boolean, n int, keys binary, numbers binary, strings binary",
    )
    found = strings.groupBy("bucket").applyInArrow(_find_repeats(length), "block bigint, n int, spans binary")
    cut = blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        _cut_out,
        "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary",
    )
    size = F.octet_length("text").cast("bigint")
    alone = docs.filter("doc_id is null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        size.alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
        F.col("text").cast("binary").alias("kept"),
    )
    return cut.unionByName(alone)
