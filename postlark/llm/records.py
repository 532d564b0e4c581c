"""Token ids as length-delimited binary records with masked checksums and an offset index.

A record is: payload length (8 bytes), masked CRC-32 of those 8 bytes (4), the
payload, masked CRC-32 of the payload (4); all little-endian. The payload is one
byte, the width of an id in bytes, and the ids. Documents are range partitioned
and sorted by id, one file each partition; the index, a Parquet table beside the
files, holds one row per record, so that any subset can be read in any order. A
task writes under a name of its own and renames at the end: a repeated task
replaces its file with the same bytes.

Ids come from a table of distinct parts of texts per Python worker. A text is cut before
each space that a non-space follows, where the pre-tokeniser always cuts, and
between Latin letters, digits, signs and single newlines, where it cuts as well
(tried at the start; if it does not, only the spaces count). The library segments
each distinct part once: its model alone what is of one kind, the whole library
all others, many side by side in one text, told apart by the tokens that open with a space.

Defined results: a null or empty text is one record with only the end id; a null
document id sorts first; repeated rows give one record each; an empty table
gives no file and an empty index.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pf
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlark.llm.common import fresh, ids_by_word, list_array, slices, text_buffer, travels, with_fields, worker_cache

travels(__name__)

# white space, after which no word starts: ASCII, and the first bytes of the others in UTF-8
ASCII_BLANK = np.zeros(256, bool)
ASCII_BLANK[[*range(9, 14), *range(28, 33)]] = True
BLANKS = [c.encode() for c in map(chr, range(0x80, 0x3001)) if c.isspace()]
BLANK_HEAD = np.zeros(256, bool)
BLANK_HEAD[[c[0] for c in BLANKS]] = True
# letters of Latin scripts, of which any run behind a space is one part for the pre-tokeniser
LATIN = [chr(c) for c in range(0x250) if chr(c).isalpha()]
IS_LATIN = np.zeros(0x800, bool)
IS_LATIN[list(map(ord, LATIN))] = True
SIGNS, DIGITS = ".,;:!?*$%#&()-", "0123456789"
# kinds of bytes between which the pre-tokeniser cuts; 0: all others
LETTER, SIGN, DIGIT, NEWLINE = 1, 2, 3, 4
KIND = np.zeros(256, np.uint8)
for kind, chars in ((LETTER, LATIN), (SIGN, SIGNS), (DIGIT, DIGITS), (NEWLINE, "\n")):
    KIND[[ord(c) for c in chars if c.isascii()]] = kind
# a part of one kind, with the space before it
PURE = re.compile(f" ?(?:[{''.join(LATIN)}]+|[{re.escape(SIGNS)}]+|[{DIGITS}]+)")
# parts that the table holds, and their characters; longer ones are segmented anew
TABLE_ENTRIES = 500_000
HELD_CHARS = 64
# new words that the library gets in one text
TOGETHER = 1_000
# how a byte-level vocabulary writes a space
SPACE = "Ġ"
FRAME = 16
READ_BYTES = 8_000_000
# text encoded at once, but for a longer document
SLICE_BYTES = 4_000_000
MASK_DELTA = 0xA282EAD8


def masked_crc(data: bytes) -> int:
    """CRC-32 rotated and shifted, so that a checksum of data that holds checksums stays sound."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    payload = bytes([width]) + ids.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(payload))
    return b"".join(
        (size, struct.pack("<I", masked_crc(size)), payload, struct.pack("<I", masked_crc(payload)))
    )


def unframe(data: bytes, at: int) -> tuple[np.ndarray, int]:
    """The ids of the record at ``at`` and where the next record begins; raises if a checksum fails."""
    size = data[at : at + 8]
    (length,) = struct.unpack("<Q", size)
    if struct.unpack_from("<I", data, at + 8)[0] != masked_crc(size):
        raise ValueError(f"checksum of the length at {at} fails")
    payload = data[at + 12 : at + 12 + length]
    if len(payload) != length or struct.unpack_from("<I", data, at + 12 + length)[0] != masked_crc(payload):
        raise ValueError(f"checksum of the record at {at} fails")
    return np.frombuffer(payload, f"<u{payload[0]}", offset=1).astype("<u4"), at + FRAME + length


class WordTable:
    """Ids of distinct parts of texts, with the space before them, as bytes of 32-bit integers."""

    def __init__(self, path: str):
        # its threads cost more than they give on short words, and Spark fills the cores
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        tokens = map(self.tokenizer.id_to_token, range(max(self.tokenizer.get_vocab().values()) + 1))
        self.opens = np.array([(token or "").startswith(SPACE) for token in tokens])
        self.ids: dict[str, bytes] = {}
        self.spelled = self._spelling()

    def _spelling(self) -> dict[int, str] | None:
        """How the vocabulary writes Latin letters; none if parts alone do not give the library's ids."""
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str
        spelled = {ord(c): parts(c)[0][0] for c in LATIN}
        probes = ["".join(LATIN[k : k + 9]) for k in range(0, len(LATIN), 9)]
        probes += ["the", "Straße.", "naïveté.\nxqzj", "a,\nÉb!?", "ab***", "c$$$.", "d--", "(e)\n12", "3f\n-4th", "'s5's", "it's."]
        probes += [f" {a}{b}{c}" for a in "aé.-7" for b in "aé.-7" for c in "aé.-7"]
        # tokens that the library finds before it cuts must stay whole
        probes += [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        texts = [*probes, *(" " + p for p in probes)]
        for text, whole in zip(texts, self._encoded(texts)):
            data = np.frombuffer(text.encode(), np.uint8)
            cuts = [0, *part_places(data, np.array([0, len(data)])).tolist(), len(data)]
            parts = [data[a:b].tobytes().decode() for a, b in zip(cuts, cuts[1:])]
            found = [self._pure([p], spelled) if PURE.fullmatch(p) else self._encoded([p]) for p in parts]
            if b"".join(ids for (ids,) in found) != whole:
                return None
        return spelled

    def _pure(self, parts: list[str], spelled: dict[int, str]) -> list[bytes]:
        """Ids of parts of one kind, as the vocabulary spells them."""
        segment, found = self.tokenizer.model.tokenize, []
        for part in parts:
            if not part.isascii():
                part = part.translate(spelled)
            if part[0] == " ":
                part = SPACE + part[1:]
            found.append(array("I", [t.id for t in segment(part)]).tobytes())
        return found

    def _encoded(self, parts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learned(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts that the table lacks."""
        pure = list(filter(PURE.fullmatch, parts)) if self.spelled else []
        found = dict(zip(pure, self._pure(pure, self.spelled)))
        if len(found) < len(parts):
            rest = [p for p in parts if p not in found]
            plain = [p for p in rest if p.rfind(" ") == 0]
            for at in range(0, len(plain), TOGETHER):
                some = plain[at : at + TOGETHER]
                (together,) = self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)
                found.update(zip(some, ids_by_word(np.array(together.ids, np.uint32), self.opens, len(some))))
            rest = [p for p in rest if p not in found]
            found.update(zip(rest, self._encoded(rest)))
        return found

    def _cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where parts begin: each text that is not empty, each space before a word, places within words."""
        cut = np.zeros(len(data) + 1, bool)
        cut[starts] = True
        cut[len(data)] = False
        cut[word_spaces(data, starts)] = True
        if self.spelled:
            cut[part_places(data, starts)] = True
        return np.flatnonzero(cut)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text begins (one more at the end).

        The distinct parts of the batch are looked up once, what the table lacks is
        learned, and the ids are joined by position.
        """
        data, starts = text_buffer(column)
        cuts = self._cuts(data, starts)
        offsets = np.append(cuts, len(data)).astype(np.int64)
        parts = pa.Array.from_buffers(
            pa.large_string(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        )
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.ids) > TABLE_ENTRIES:
            self.ids.clear()
        found = list(map(self.ids.get, distinct))
        lacking = [k for k, ids in enumerate(found) if ids is None]
        learned = self._learned([distinct[k] for k in lacking])
        for k in lacking:
            found[k] = learned[distinct[k]]
        self.ids.update((part, ids) for part, ids in learned.items() if len(part) <= HELD_CHARS)
        entry = coded.indices.to_numpy()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        each = sizes[entry]
        begins = np.cumsum(sizes) - sizes
        ends = np.cumsum(each)
        at = np.repeat(begins[entry] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)
        ids = np.frombuffer(b"".join(found), np.uint32)[at]
        return ids, np.concatenate(([0], ends))[np.searchsorted(cuts, starts, "left")]


def part_places(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places within texts where one kind of bytes follows another, or a single newline stands between them."""
    kind = KIND[data]
    # of two bytes each; they begin with one of seven bytes
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xC9))
    lead = lead[lead + 1 < len(data)]
    lead = lead[IS_LATIN[(data[lead] & 31).astype(np.int64) << 6 | data[lead + 1] & 63]]
    kind[lead] = kind[lead + 1] = LETTER
    begins = np.zeros(len(data) + 1, bool)
    begins[starts] = True
    known = (kind != 0) & (kind != NEWLINE)
    change = np.flatnonzero((kind[1:] != kind[:-1]) & known[1:] & known[:-1]) + 1
    lines = np.flatnonzero(kind == NEWLINE)
    lines = lines[(lines > 0) & (lines + 1 < len(data))]
    lines = lines[known[lines - 1] & known[lines + 1] & ~begins[lines] & ~begins[lines + 1]]
    return np.sort(np.concatenate((change[~begins[change]], lines, lines + 1)))


def word_spaces(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of the spaces that a non-space of the same text follows."""
    begins = np.zeros(len(data) + 1, bool)
    begins[starts] = True
    at = np.flatnonzero((data == 32) & ~begins[1:])
    after = data[at + 1]
    at, after = at[~ASCII_BLANK[after]], after[~ASCII_BLANK[after]]
    blank = np.zeros(len(at), bool)
    for k in np.flatnonzero(BLANK_HEAD[after]).tolist():
        p = int(at[k]) + 1
        blank[k] = data[p : p + 3].tobytes().startswith(tuple(BLANKS))
    return at[~blank]


def _write(tokenizer_path: str, folder: str, end_id: int):
    def write(batches):
        table = worker_cache(f"words_{tokenizer_path}", lambda: WordTable(tokenizer_path))
        end = np.uint32(end_id)
        task = TaskContext.get()
        store, path = pf.FileSystem.from_uri(folder)
        name = f"part-{task.partitionId():06d}.rec"
        own = f"{path}/.{name}.{task.taskAttemptId()}"
        out, offset, start = None, 0, 0
        for batch in batches:
            if out is None and len(batch):
                store.create_dir(path, recursive=True)
                out = store.open_output_stream(own)
            sizes, counts = [], []
            for a, b in slices(pc.binary_length(pc.fill_null(batch.column(1), "")).to_numpy(), SLICE_BYTES):
                flat, begins = table.encode(batch.column(1)[a:b])
                for x, y in zip(begins[:-1].tolist(), begins[1:].tolist()):
                    ids = np.append(flat[x:y], end)
                    record = frame(ids)
                    out.write(record)
                    sizes.append(len(record))
                    counts.append(len(ids))
            ends, tokens = offset + np.cumsum(sizes, dtype=np.int64), start + np.cumsum(counts, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(batch), pa.string()),
                    batch.column(0),
                    pa.array(ends - sizes),
                    pa.array(np.array(sizes, np.int64)),
                    pa.array(tokens - counts),
                    pa.array(np.array(counts, np.int64)),
                ],
                ["file", "doc_id", "offset", "n_bytes", "start", "n_tokens"],
            )
            if len(batch):
                offset, start = int(ends[-1]), int(tokens[-1])
        if out is not None:
            out.close()
            store.move(own, f"{path}/{name}")

    return write


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write ``docs`` (``doc_id, text``) below ``folder`` in ascending id order; returns the index.

    The index has ``file, doc_id, offset, n_bytes, start, n_tokens``; ``start``
    counts the tokens before the record in its file. File names ascend with ids.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    # rows that share an id are in the order of their texts: a repeated task writes the same bytes
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    index = ordered.mapInArrow(
        _write(tokenizer_path, f"{folder}/records", end_id),
        f"file string, doc_id {kind}, offset bigint, n_bytes bigint, start bigint, n_tokens bigint",
    )
    index.write.parquet(f"{folder}/index")
    return read_index(docs.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def corpus_starts(index: DataFrame) -> DataFrame:
    """The index with ``start`` counted over all files. One row a file is summed in order."""
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return index.join(bases, "file").withColumn("start", F.col("start") + F.col("base")).drop("base")


def _runs(files: list[str], offsets: list[int], sizes: list[int]):
    """Cut rows into runs that lie side by side in one file and can be read at once."""
    begin = 0
    for i in range(1, len(files) + 1):
        if (
            i == len(files)
            or files[i] != files[i - 1]
            or offsets[i] != offsets[i - 1] + sizes[i - 1]
            or offsets[i] + sizes[i] - offsets[begin] > READ_BYTES
        ):
            yield begin, i
            begin = i


def _read(folder: str, raw: bool, name: str):
    def read(batches):
        store, path = pf.FileSystem.from_uri(folder)
        for batch in batches:
            files, offsets, sizes = (
                batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("file", "offset", "n_bytes")
            )
            for a, b in _runs(files, offsets, sizes):
                with store.open_input_file(f"{path}/{files[a]}") as f:
                    data = f.read_at(offsets[b - 1] + sizes[b - 1] - offsets[a], offsets[a])
                rows, at = [], 0
                for _ in range(a, b):
                    ids, at = unframe(data, at)
                    rows.append(ids.tobytes())
                part = batch.slice(a, b - a)
                column = pa.array(rows, pa.binary()) if raw else list_array(rows, "int32")
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, name])

    return read


def read_records(index: DataFrame, folder: str, *, raw: bool = False) -> DataFrame:
    """``index`` rows, any subset in any order, with their ids: an array, or ``raw`` as 32-bit little-endian bytes.

    Rows that lie side by side are read in one piece; every checksum is verified.
    """
    kind, name = "binary" if raw else "array<int>", fresh("ids", index.columns)
    return index.mapInArrow(_read(f"{folder}/records", raw, name), with_fields(index.schema, f"{name} {kind}"))
