"""Fill-in-the-middle transformation with indexable skip lists.

A text is cut into units: a run of ASCII letters, or any other code point. Two
ranks among its units, drawn from a hash of the document's id, cut it into prefix,
middle and suffix, which are put in another order behind markers. A rank is found
in a skip list over the units: every link of a lane says how many units and how
many code points it spans, so a descent that adds up the widths ends at the rank
and knows its code point. The lists of a slice of documents lie side by side and
all ranks descend together.

Defined results: a null text is empty; an empty text, and one that holds a marker,
stays plain; a null id is hashed like an empty one; repeated rows give equal rows;
an empty table gives no row. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.llm.common import id_and_text, mixed, slices, text_buffer, travels

travels(__name__)

PREFIX, SUFFIX, MIDDLE = MARKERS = ("<P>", "<S>", "<M>")
SEED = "1"
PLAIN_FROM, SPM_BELOW = 90, 20
# text whose lists are built at once, but for a longer document
SLICE_BYTES = 2_000_000
# a node climbs to the next lane with odds of one in four
CLIMB_BITS = 2
NEVER = np.iinfo(np.int64).max

LETTER = np.zeros(256, bool)
LETTER[ord("A") : ord("Z") + 1] = LETTER[ord("a") : ord("z") + 1] = True


class Lane(NamedTuple):
    """Links of one lane: a node's next one stands behind it, a tail has none."""

    units: np.ndarray
    points: np.ndarray
    down: np.ndarray  # the same node one lane below


class SkipLists:
    """One list per row over the units of its text, with a node before each unit and one at the end."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        opens = (data & 0xC0) != 0x80
        letter = LETTER[data]
        joined = np.zeros(len(data), bool)
        joined[1:] = letter[1:] & letter[:-1]
        joined[starts[(starts > 0) & (starts < len(data))]] = False
        points = np.concatenate(([0], np.cumsum(opens)))  # code points before each byte
        begins = np.flatnonzero(opens & ~joined)
        before = np.searchsorted(begins, starts, "left")
        self.n_units = np.diff(before)
        rows = np.arange(len(self.n_units))
        tails = before[1:] + rows
        self.heads = before[:-1] + rows
        size = len(begins) + len(rows)
        place, rank = np.empty(size, np.int64), np.empty(size, np.int64)
        at = np.arange(len(begins)) + np.repeat(rows, self.n_units)
        place[at], rank[at] = points[begins], np.arange(len(begins))
        place[tails], rank[tails] = points[starts[1:]], before[1:]
        ends = np.zeros(size, bool)
        ends[tails] = True
        kept = ends.copy()
        kept[self.heads] = True
        height = mixed(np.arange(size, dtype=np.uint64))
        self.lanes: list[Lane] = []
        down = np.arange(size)
        while True:
            links = [np.append(np.diff(x), 0) for x in (rank, place)]
            links[0][ends] = NEVER
            self.lanes.append(Lane(*links, down))
            if kept.all():
                return
            climbs = kept | (height & np.uint64((1 << CLIMB_BITS) - 1) == 0)
            height = height >> np.uint64(CLIMB_BITS)
            if climbs.all():  # none stays behind: the hash is used up
                climbs = kept
            down = np.flatnonzero(climbs)
            rank, place, ends, kept, height = (x[down] for x in (rank, place, ends, kept, height))
            self.heads = np.searchsorted(down, self.heads)

    def points_before(self, ranks: np.ndarray) -> np.ndarray:
        """Code points before the unit of each row's rank (0 to the number of units)."""
        rest, points, node = ranks.astype(np.int64), np.zeros(len(ranks), np.int64), self.heads
        for lane in reversed(self.lanes):
            node = node.copy()
            moving = np.arange(len(ranks))
            while len(moving := moving[lane.units[node[moving]] <= rest[moving]]):
                rest[moving] -= lane.units[node[moving]]
                points[moving] += lane.points[node[moving]]
                node[moving] += 1
            node = lane.down[node]
        return points


def _cuts(first: str, second: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_buffer(batch["text"])
            one, two = (batch[n].to_numpy() for n in (first, second))
            found = [np.zeros((3, 0), np.int64)]
            for a, b in slices(np.diff(starts), SLICE_BYTES):
                lists = SkipLists(data[starts[a] : starts[b]], starts[a : b + 1] - starts[a])
                x, y = one[a:b] % (lists.n_units + 1), two[a:b] % (lists.n_units + 1)
                prefix, end = (lists.points_before(f(x, y)) for f in (np.minimum, np.maximum))
                found.append(np.stack([lists.n_units, prefix, end - prefix]))
            found = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, found)], [*batch.schema.names, "n", "prefix_chars", "middle_chars"]
            )

    return cut


def hash_group(doc_id: Column, k: int, seed: str = SEED) -> Column:
    """The ``k``-th (from 1) group of eight hex digits of the SHA-256 of ``seed:id``, as a long."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 8 * k - 7, 8), 16, 10).cast("bigint")


def fill_in_middle(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: str = SEED,
    plain_from: int = PLAIN_FROM,
    spm_below: int = SPM_BELOW,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row of ``docs``.

    ``n`` counts the units. ``form`` is plain, spm (suffix, prefix, middle) or psm;
    a plain text is its own output and has no parts.
    """
    rows = id_and_text(docs, id_col=id_col, text_col=text_col)
    h = [hash_group(F.col("doc_id"), k, seed) for k in (1, 2, 3, 4)]
    drawn = rows.select("doc_id", "text", h[0].alias("h1"), h[1].alias("h2"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    cut = drawn.mapInArrow(
        _cuts("h1", "h2"),
        f"doc_id {id_type}, text string, h1 bigint, h2 bigint, n bigint, prefix_chars bigint, middle_chars bigint",
    )
    text = F.col("text")
    marked = F.lit(False)
    for m in MARKERS:
        marked = marked | text.contains(m)
    plain = (text == "") | marked | (h[2] % 100 >= plain_from)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_below, "spm").otherwise("psm")
    formed = cut.withColumn("form", form)
    end = F.col("prefix_chars") + F.col("middle_chars")
    prefix = F.substring(text, F.lit(1), F.col("prefix_chars"))
    middle = F.substring(text, F.col("prefix_chars") + 1, F.col("middle_chars"))
    suffix = F.substring(text, end + 1, F.length(text))
    parts = {
        "psm": (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle),
        "spm": (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
    }
    output = text
    for name, pieces in parts.items():
        joined = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])
        output = F.when(F.col("form") == name, joined).otherwise(output)
    cut_only = F.col("form") != "plain"
    return formed.select(
        "doc_id",
        "n",
        "form",
        F.when(cut_only, F.col("prefix_chars")).alias("prefix_chars"),
        F.when(cut_only, F.col("middle_chars")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text behind ``output``: markers occur in no text that was cut."""
    part = F.split(output, "<[PSM]>")
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
