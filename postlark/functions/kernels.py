"""What runs in Python inside a task: scans over ordered chunks, and the literal fallback.

The module travels with its functions, so executors need numpy, pandas and pyarrow
but no copy of this package.
"""

from __future__ import annotations

import ast
import csv
import io
import json
import math
import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def literals_to_json(raw: pd.Series) -> pd.Series:
    """Python list literals as JSON text; null for anything else."""

    def convert(text):
        if text is None:
            return None
        try:
            value = ast.literal_eval(text)
            # bytes and sets have no JSON form
            return json.dumps(value) if isinstance(value, list) else None
        except (SyntaxError, ValueError, TypeError, MemoryError, RecursionError):
            return None

    return raw if raw.isna().all() else raw.map(convert)


# tokens that are counted at once
TOKENS_AT_ONCE = 1 << 20


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``term, n_occurrences, n_documents`` of lists of tokens, added up over some documents at a time."""
    for batch in batches:
        lists = batch.column(0)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        begin = 0
        while begin < len(sizes):
            so_far = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, so_far + TOKENS_AT_ONCE, "right")))
            tokens = lists.slice(begin, end - begin).flatten()
            document = np.repeat(np.arange(end - begin), sizes[begin:end])
            if tokens.null_count:
                there = tokens.is_valid()
                tokens, document = tokens.filter(there), document[there.to_numpy(zero_copy_only=False)]
            coded = tokens.dictionary_encode()
            codes, terms = coded.indices.to_numpy(), coded.dictionary.cast(pa.string())
            pairs = np.sort(document * len(terms) + codes)
            first = pairs[np.diff(pairs, prepend=-1) != 0]
            yield pa.RecordBatch.from_arrays(
                [
                    terms,
                    pa.array(np.bincount(codes, minlength=len(terms)), pa.int64()),
                    pa.array(np.bincount(first % max(1, len(terms)), minlength=len(terms)), pa.int64()),
                ],
                names=["term", "n_occurrences", "n_documents"],
            )
            begin = end


def _pieces(sizes: np.ndarray, limit: int) -> list[dict]:
    """What a run of lines does to the batch it meets, as a step function.

    For a batch already filled to ``from_fill`` or more: how full the last batch is
    after the run, and how many batches were started. ``fill`` is null where the
    whole run fits and so just adds up.
    """
    n = len(sizes)
    total = np.concatenate(([0], np.cumsum(sizes)))
    after = np.searchsorted(total, total[:-1] + limit, side="right") - 1
    after = np.maximum(after, np.arange(1, n + 1)).tolist()
    fill, started = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        j = after[i]
        if j >= n:
            fill[i], started[i] = int(total[n] - total[i]), 1
        else:
            fill[i], started[i] = fill[j], started[j] + 1
    pieces = []
    if total[n] <= limit:
        pieces.append({"from_fill": 0, "fill": None, "batches": 0})
    # the first line that does not fit, from the last possible one down to line 0
    last = min(n, int(np.searchsorted(total, limit, side="right"))) - 1
    for first in range(last, -1, -1):
        piece = {
            "from_fill": max(0, int(limit - total[first + 1] + 1)),
            "fill": fill[first],
            "batches": started[first],
        }
        if not pieces or (pieces[-1]["fill"], pieces[-1]["batches"]) != (
            piece["fill"],
            piece["batches"],
        ):
            pieces.append(piece)
    return pieces


def _assign(sizes: np.ndarray, limit: int, fill: int, batch: int) -> tuple[np.ndarray, int, int]:
    """Batch number of each line, given the batch the run starts in."""
    n = len(sizes)
    total = np.concatenate(([0], np.cumsum(sizes)))
    numbers = np.empty(n, dtype=np.int64)
    i = 0
    while i < n:
        j = max(i, int(np.searchsorted(total, total[i] + limit - fill, side="right")) - 1)
        numbers[i:j] = batch
        fill += int(total[j] - total[i])
        i = j
        if i < n:
            batch += 1
            numbers[i] = batch
            fill = int(sizes[i])
            i += 1
    return numbers, fill, batch


def _runs(labels: pa.Array) -> Iterator[tuple[str, int, int]]:
    encoded = pc.run_end_encode(labels)
    start = 0
    for label, end in zip(encoded.values.to_pylist(), encoded.run_ends.to_pylist()):
        yield label, start, end
        start = end


# --- texts in order: which marks reach across a border ------------------------------------

# what a text does at its borders
JOINS, OPENS, OPENS_CUT, JOINS_LAST = 1, 2, 4, 8
# what a text is in its corpus
FIRST, LAST, HEAD_CUT, TAIL_CUT = 1, 2, 4, 8
# what a line does: it goes on with the line before, the line behind goes on with it
CONTINUES, OPEN = 1, 2


def _bit(marks: np.ndarray, bit: int) -> np.ndarray:
    return (marks & bit) != 0


def _open_after(marks: np.ndarray, state: bool) -> np.ndarray:
    """Whether a mark is open behind each text, if ``state`` says so for the first.

    A text that ends alike with and without its head settles the state; the others
    keep it or turn it over.
    """
    plain = _bit(marks, OPENS)
    cut = np.where(_bit(marks, JOINS), _bit(marks, OPENS_CUT), plain)
    at = np.arange(len(marks))
    settled = np.maximum.accumulate(np.where(plain == cut, at, -1))
    turns = np.concatenate(([0], np.cumsum(plain & ~cut)))
    base = np.where(settled >= 0, plain[settled], state)
    return base ^ ((turns[1:] - turns[settled + 1]) % 2 == 1)


class Cleaner:
    """The rules for the few texts that a mark across a border touches, as compiled patterns."""

    def __init__(self, name: str, mark: str, strip: str, emoji: str):
        self.name, self.mark, self.strip = re.compile(name), re.compile(mark), strip
        self.emoji = re.compile(emoji)

    def stray(self, marks: np.ndarray, heads: list, last: bool) -> tuple[str, bool]:
        """What the first texts of a chunk add to a line that began before, and whether all of them do.

        ``heads`` are the texts that begin with a name. ``last``: the group ends here.
        """
        line, n = "", len(marks)
        for k in range(n):
            ends = last and k == n - 1
            text = heads[k].rstrip(self.strip) if ends else heads[k]
            text = self.mark.sub("", self.name.sub("", text, count=1))
            head, newline, _ = text.partition("\n")
            if newline:
                return line + head, False
            if k == n - 1:
                return line + text, True
            joins = JOINS_LAST if last and k == n - 2 else JOINS
            if not marks[k] & OPENS_CUT or not marks[k + 1] & joins:
                return line + text, False
            line += text[:-2]
        return line, False


MARKS_SCHEMA = pa.schema(
    [
        ("_group", pa.string()),
        ("_chunk", pa.int32()),
        ("_first", pa.int32()),
        ("_single", pa.bool_()),
        ("_after", pa.list_(pa.bool_())),
        ("_stray", pa.list_(pa.string())),
        ("_whole", pa.bool_()),
    ]
)


def border_marks(cleaner: Cleaner):
    """For the first and the last group of a chunk: how marks pass through it, and what it adds to a line before."""

    def row(group, chunk, marks, heads):
        stray, stray_last, whole = "", "", False
        if marks[0] & JOINS:
            stray, whole = cleaner.stray(marks, heads, False)
        if marks[0] & (JOINS_LAST if len(marks) == 1 else JOINS):
            stray_last, _ = cleaner.stray(marks, heads, True)
        after = [bool(_open_after(marks, state)[-1]) for state in (False, True)]
        return dict(zip(MARKS_SCHEMA.names, (group, chunk, int(marks[0]), len(marks) == 1, after, [stray, stray_last], whole)))

    def summarise(batches):
        first, current, marks, heads, chunk, rows = None, None, [], [], None, []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            chunk = batch.column("_chunk")[0].as_py()
            own = batch.column("_mark").to_numpy()
            names = batch.column("_head")
            for label, start, end in _runs(batch.column("_group")):
                if label != current:
                    if current is not None and first is None:
                        first = current
                        rows.append(row(current, chunk, np.concatenate(marks), heads))
                    current, marks, heads = label, [], []
                marks.append(own[start:end])
                # only texts in an unbroken run from the first can be a stray
                if len(heads) == sum(map(len, marks[:-1])):
                    run = names.slice(start, end - start)
                    broken = np.flatnonzero(np.append(run.is_null().to_numpy(zero_copy_only=False), True))[0]
                    heads += run.slice(0, int(broken)).to_pylist()
        if current is not None:
            rows.append(row(current, chunk, np.concatenate(marks), heads))
        yield pa.RecordBatch.from_pylist(rows, schema=MARKS_SCHEMA)

    return summarise


def fold_marks(chunks: pd.DataFrame) -> pd.DataFrame:
    """Walk the chunks of one group in order: the state each begins in, its neighbours, what ends its last line."""
    names = ["_group", "_chunk", "_open", "_earlier", "_later", "_next_joins", "_append"]
    chunks = chunks.sort_values("_chunk").to_dict("records")
    n, state, rows = len(chunks), False, []
    if n < 2:
        return pd.DataFrame([], columns=names)
    joins = [bool(c["_first"] & (JOINS_LAST if k == n - 1 and c["_single"] else JOINS)) for k, c in enumerate(chunks)]
    for k, c in enumerate(chunks):
        behind = joins[k + 1] if k < n - 1 else False
        rows.append([c["_group"], c["_chunk"], state, k > 0, k < n - 1, behind, None])
        state = bool(c["_after"][int(state)])
    tail = None
    for k in range(n - 1, -1, -1):
        rows[k][-1] = tail
        enters = k > 0 and rows[k][2] and joins[k]
        if not enters:
            tail = None
        elif k == n - 1:
            tail = chunks[k]["_stray"][1]
        else:
            # all texts of the chunk are on the line: the mark that ends it may go on in the next chunk
            whole = chunks[k]["_whole"] and tail is not None
            tail = chunks[k]["_stray"][0][:-2] + tail if whole else chunks[k]["_stray"][0]
    return pd.DataFrame(rows, columns=names)


# rows with texts that a task copies at once
TEXTS_AT_ONCE = 1_000


def _cut(batches, rows: int = TEXTS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that what a step copies does not grow with a batch."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _with_rows_behind(batches) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Slices that end with up to two rows of what follows, and how many rows are their own."""
    held = None
    for batch in _cut(batches):
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        n = batch.num_rows
        if n > 2:
            yield batch, n - 2
            # a copy, since a slice would keep the whole batch
            held = batch.take(pa.array([n - 2, n - 1]))
        else:
            held = batch
    if held is not None:
        yield held, held.num_rows


def place_texts(columns: Sequence[str]):
    """Add ``_place`` to the texts of a chunk: ends of the corpus, and marks that reach across a border."""

    def place(batches):
        current, state = None, False
        for batch, n in _with_rows_behind(batches):
            marks = batch.column("_mark").to_numpy()
            places = np.zeros(len(marks), np.int8)
            for label, start, end in _runs(batch.column("_group")):
                if start >= n:
                    break
                own, carry = marks[start:end], {name: batch.column(name)[start].as_py() for name in CARRIED}
                here = np.zeros(end - start, np.int8)
                if label != current:
                    current, state = label, bool(carry["_open"])
                    if not carry["_earlier"]:
                        here[0] |= FIRST
                ends = end < len(marks) or n == len(marks)  # in this chunk
                joins = _bit(own, JOINS)
                if ends and not carry["_later"]:
                    here[-1] |= LAST
                    joins[-1] = bool(own[-1] & JOINS_LAST)
                after = _open_after(own, state)
                before = np.concatenate(([state], after[:-1]))
                behind = np.append(joins[1:], bool(carry["_later"] and carry["_next_joins"]))
                here[before & joins] |= HEAD_CUT
                here[after & behind] |= TAIL_CUT
                places[start:end] = here
                state = bool(after[min(end, n) - start - 1])
            kept = [batch.column(name).slice(0, n) for name in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(places[:n])], names=[*columns, "_place"])

    return place


CARRIED = ("_open", "_earlier", "_later", "_next_joins")


def merge_lines(cleaner: Cleaner, columns: Sequence[str]):
    """Put lines together that a removed mark joined; ``_more`` says which, ``_append`` what a later chunk adds."""

    def emit(batch, lines, kept, touched):
        texts = [cleaner.emoji.sub("", t) if i in touched else t for i, t in enumerate(lines)]
        arrays = [pa.array(texts, pa.string()) if n == "line" else batch.column(n) for n in columns]
        return pa.RecordBatch.from_arrays(arrays, names=list(columns)).filter(pa.array(kept))

    def merge(batches):
        held = None  # the last line so far, if a line behind it may go on with it

        def closed():
            line = held.column("line")[0].as_py() + (held.column("_append")[0].as_py() or "")
            return emit(held, [line], [True], {0})

        for batch in batches:
            if batch.num_rows == 0:
                continue
            more = batch.column("_more").to_numpy()
            if held is not None and not more[0] & CONTINUES:
                yield closed()
                held = None
            if not more.any():
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in columns], names=list(columns))
                continue
            begins_held = held is not None
            if begins_held:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
                more = batch.column("_more").to_numpy()
            held = None
            lines, kept = batch.column("line").to_pylist(), np.ones(len(more), bool)
            flagged = np.flatnonzero(more).tolist()
            host, end = None, -1  # the line that may go on, and its last piece so far
            for i in flagged:
                if more[i] & CONTINUES and not (i == 0 and begins_held):
                    kept[i] = False
                    if host is None or end != i - 1:
                        host = None  # it belongs to a line of an earlier chunk
                        continue
                    lines[host] += lines[i]
                else:
                    host = i
                end = i
            if host is not None and end == len(more) - 1 and more[end] & OPEN:
                row = batch.slice(host, 1)
                at = batch.schema.get_field_index("line")
                text = pa.array([lines[host]], batch.schema.field("line").type)
                held = row.set_column(at, batch.schema.field("line"), text)
                kept[host] = False
            yield emit(batch, lines, kept, set(flagged))
        if held is not None:
            yield closed()

    return merge


def with_sizes(batches):
    """Add ``_size``, the characters of a line and its newline."""
    for batch in batches:
        size = pc.add(pc.utf8_length(batch.column("line")).cast(pa.int64()), 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, size], names=[*batch.schema.names, "_size"])


def chained(*steps):
    """One task function of several, each fed by the one before."""

    def run(batches):
        for step in steps:
            batches = step(batches)
        return batches

    return run


# --- lines in order: which batch each falls into -----------------------------------------


SUMMARY_SCHEMA = pa.schema(
    [
        ("_group", pa.string()),
        ("_chunk", pa.int32()),
        ("_size", pa.int64()),
        ("_batches", pa.int64()),
        (
            "_pieces",
            pa.list_(pa.struct([("from_fill", pa.int64()), ("fill", pa.int64()), ("batches", pa.int64())])),
        ),
    ]
)


def group_summaries(limit: int):
    """Summarise the groups of a chunk: size and number of batches, and for the first and the last group,
    which alone can leave the chunk, what they do to a batch filled to any level."""

    def row(group, chunk, parts, border):
        sizes = np.concatenate(parts)
        _, _, batch = _assign(sizes, limit, 0, 0)
        pieces = _pieces(sizes, limit) if border else None
        return dict(zip(SUMMARY_SCHEMA.names, (group, chunk, int(sizes.sum()), batch + 1, pieces)))

    def summarise(batches):
        current, parts, chunk, rows, any_yet = None, [], None, [], False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            chunk = batch.column("_chunk")[0].as_py()
            sizes = batch.column("_size").to_numpy()
            for label, start, end in _runs(batch.column("_group")):
                if label != current:
                    if current is not None:
                        rows.append(row(current, chunk, parts, not any_yet))
                        any_yet = True
                    current, parts = label, []
                parts.append(sizes[start:end])
            if len(rows) > 10_000:
                yield pa.RecordBatch.from_pylist(rows, schema=SUMMARY_SCHEMA)
                rows = []
        if current is not None:
            rows.append(row(current, chunk, parts, True))
        yield pa.RecordBatch.from_pylist(rows, schema=SUMMARY_SCHEMA)

    return summarise


def fold_chunks(limit: int):
    """Walk the chunks of one group in order: the batch each starts in, and size and batches of the whole group."""

    def fold(chunks: pd.DataFrame) -> pd.DataFrame:
        rows, fill, batch = [], 0, 0
        if len(chunks) == 1:
            group, chunk, size, batches, _ = next(chunks.itertuples(index=False, name=None))
            rows, total, batch = [[group, chunk, 0, 0]], size, batches - 1
        else:
            total = int(chunks["_size"].sum())
            for group, chunk, size, _, pieces in chunks.sort_values("_chunk").itertuples(index=False, name=None):
                rows.append([group, chunk, fill, batch])
                piece = [p for p in pieces if p["from_fill"] <= min(fill, limit)][-1]
                fill = fill + size if piece["fill"] is None else piece["fill"]
                batch += piece["batches"]
        rows = [(*r, total, batch + 1, k == 0) for k, r in enumerate(rows)]
        names = ["_group", "_chunk", "_fill", "_batch", "_total", "_batches", "_head"]
        return pd.DataFrame(rows, columns=names)

    return fold


def number_lines(limit: int, columns: Sequence[str]):
    def number(batches):
        current, fill, batch_no = None, 0, 0
        for batch in batches:
            sizes = batch.column("_size").to_numpy()
            numbers = np.empty(batch.num_rows, dtype=np.int64)
            for label, start, end in _runs(batch.column("_group")):
                if label != current:
                    current = label
                    fill = batch.column("_fill")[start].as_py() or 0
                    batch_no = batch.column("_batch")[start].as_py() or 0
                numbers[start:end], fill, batch_no = _assign(
                    sizes[start:end], limit, fill, batch_no
                )
            kept = [batch.column(name) for name in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(numbers)], names=[*columns, "batch_no"]
            )

    return number


def batch_fragments(keys: Sequence[str]):
    """The lines of a chunk that fall into one batch as one row, each line with its newline behind it."""

    def fragments(batches):
        part = 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            numbers = batch.column("batch_no").to_numpy()
            codes = pc.dictionary_encode(batch.column("_group")).indices.to_numpy()
            new = np.concatenate(([True], (numbers[1:] != numbers[:-1]) | (codes[1:] != codes[:-1])))
            starts = np.flatnonzero(new)
            at = pa.array(starts)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, n).astype(np.int32)), batch.column("line"))
            text = pc.binary_join_element_wise(pc.binary_join(lists, "\n"), "", "\n")
            chars = np.add.reduceat(batch.column("_size").to_numpy(), starts)
            own = [batch.column(name).take(at) for name in (*keys, "batch_no", "_chunk")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(np.arange(part, part + len(starts))), pa.array(chars), text],
                names=[*keys, "batch_no", "_chunk", "_part", "_chars", "_text"],
            )
            part += len(starts)

    return fragments


# --- lines of a CSV file in order: where records end ------------------------------------

# parts of records at the borders of a block: what ends there and what begins there; whole records have no number
HEAD_PART, TAIL_PART = 1, 2

RECORDS_SCHEMA = pa.schema([("no", pa.int64()), ("border", pa.int32()), ("record", pa.string())])


def _joined_lines(lines: pa.Array, starts: np.ndarray) -> pa.Array:
    """One string for each run of lines; ``starts`` has the end behind the last."""
    if len(starts) == len(lines) + 1:
        return lines
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), lines), "\n")


def cut_records(header: Sequence[str], sep: str, quote: str, borders: bool = False):
    """Join the lines of each block to records: those within the block, or the parts at its ``borders``."""
    wanted = [name.lower() for name in header]

    def check(record: str) -> None:
        text = io.StringIO(record.lstrip("\ufeff").rstrip("\r"), newline="")
        names = next(csv.reader(text, delimiter=sep, quotechar=quote), [])
        if [n.lower() for n in names] != wanted:
            raise ValueError(f"a file has another header: {names}")

    def rows(no, border, records):
        numbers = pa.array([no] * len(records), pa.int64()), pa.array([border] * len(records), pa.int32())
        return pa.RecordBatch.from_arrays([*numbers, records.cast(pa.string())], schema=RECORDS_SCHEMA)

    def cut(batches):
        # the block being read, the lines since its last end of a record, whether they end inside quotes
        no, waiting, odd = None, [], False
        begins_inside = head = False  # no record of the block has ended yet; its first record is the header

        def rest():
            """The part of a record that goes on in the next block."""
            if waiting and (begins_inside or odd):
                if head and not begins_inside:
                    raise ValueError("a header does not end in the first block of its file")
                if borders:
                    yield rows(no, HEAD_PART if begins_inside else TAIL_PART, pa.array(["\n".join(waiting)]))

        for batch in batches:
            for label, start, end in _runs(batch.column("no")):
                if label != no:
                    yield from rest()
                    no, waiting = label, []
                    odd = begins_inside = batch.column("begins")[start].as_py()
                    head = batch.column("first")[start].as_py()
                lines = batch.column("line").slice(start, end - start)
                quotes = pc.count_substring(lines, quote).to_numpy(zero_copy_only=False)
                inside = (np.cumsum(quotes) + odd) % 2 == 1
                ends = np.flatnonzero(~inside) + 1
                odd = bool(inside[-1])
                if not len(ends):
                    waiting += lines.to_pylist()
                    continue
                records = _joined_lines(lines.slice(0, ends[-1]), np.concatenate(([0], ends)))
                if waiting:
                    first = "\n".join([*waiting, records[0].as_py()])
                    records = pa.concat_arrays([pa.array([first], records.type), records.slice(1)])
                waiting = lines.slice(ends[-1]).to_pylist()
                if begins_inside:
                    if borders:
                        yield rows(no, HEAD_PART, records.slice(0, 1))
                    records, begins_inside = records.slice(1), False
                if head and len(records):
                    check(records[0].as_py())
                    records, head = records.slice(1), False
                if not borders and len(records):
                    records = pc.utf8_rtrim(records, "\r")
                    if batch.column("crlf")[start].as_py():
                        records = pc.replace_substring(records, "\r\n", "\n")
                    yield rows(no, None, records)
        yield from rest()

    return cut


# --- the summary of one text ----------------------------------------------------------


def summary(text: str, token: re.Pattern, most: int, least: int) -> tuple[str, int]:
    """Lines of ``text`` in their order, chosen one by one for the most new weight per word, and their words.

    A token weighs more the fewer lines hold it, and counts once, so lines that repeat
    chosen ones fall behind. Lines that do not fit are passed over; if none fits and
    the summary has fewer than ``least`` words, the best line left is cut to the rest.
    """
    lines, words, tokens = [], [], []
    for line in text.split("\n"):
        own = set(token.findall(line.lower()))
        if own:
            lines.append(line)
            words.append(re.findall("[^ \t]+", line))
            tokens.append(own)
    holders: dict[str, list[int]] = {}
    for k, own in enumerate(tokens):
        for t in own:
            holders.setdefault(t, []).append(k)
    weight = {t: round(math.log((len(lines) + 1) / (len(ks) + 1)), 9) for t, ks in holders.items()}
    # whole numbers, so that the order of the sums does not matter
    new = np.array([sum(round(weight[t] * 1e9) for t in own) for own in tokens], np.int64)
    sizes = np.array([len(w) for w in words], np.int64)
    free, left, chosen = np.ones(len(lines), bool), most, {}
    while True:
        fits = np.flatnonzero(free & (sizes <= left))
        if not len(fits):
            break
        k = int(fits[np.argmax(new[fits] / sizes[fits])])
        if new[k] <= 0 and most - left >= least:
            break
        chosen[k] = lines[k]
        free[k] = False
        left -= int(sizes[k])
        for t in tokens[k]:
            for other in holders.pop(t, ()):
                new[other] -= round(weight[t] * 1e9)
    if most - left < least and free.any():
        rest = np.flatnonzero(free)
        k = int(rest[np.argmax(new[rest] / sizes[rest])])
        chosen[k] = " ".join(words[k][:left])
        left = 0
    return "\n".join(chosen[k] for k in sorted(chosen)), most - left


def summaries(token: str, most: int, least: int):
    """Add ``summary`` and ``n_words`` to rows with a short ``text``."""
    pattern = re.compile(token)

    def add(batches):
        for batch in _cut(batches, TEXTS_AT_ONCE // 10):
            found = [summary(t or "", pattern, most, least) for t in batch.column("text").to_pylist()]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "summary", "n_words"])

    return add
