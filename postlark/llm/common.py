"""What the operators share: session settings, Arrow buffers, and a cache that outlives a task.

Task functions travel to the executors by value, so module globals are new in
every task; `worker_cache` keeps what is costly to build for the life of the
Python worker.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# rows of one Arrow batch: a batch of documents stays at a few MB
BATCH_ROWS = 512


def travels(module: str) -> None:
    """Pickle the functions of ``module`` by value, so executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


travels(__name__)


def prepared(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """The object called ``name`` of this Python worker, made at its first use."""
    holder = sys.modules.setdefault("_postlark_worker", types.ModuleType("_postlark_worker"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, or a longer name that no column has (column names ignore case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def with_fields(schema: StructType, more: str) -> StructType:
    """A copy of ``schema`` with the columns of a DDL string behind it."""
    return StructType([*schema.fields, *StructType.fromDDL(more).fields])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def id_and_text(docs: DataFrame, *more: Column, id_col="doc_id", text_col="text") -> DataFrame:
    """Two columns, ``doc_id`` and ``text`` (null: empty), whatever else ``docs`` has."""
    return docs.select(
        docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), *more
    )


def folds(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column (null: empty), and where each row begins (one more at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    _, starts, data = column.buffers()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(starts, np.int64 if wide else np.int32)
    starts = starts[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


def slices(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Cut rows into runs of about ``most`` bytes, whole rows only."""
    cuts, begin, total = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            cuts.append((begin, i))
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        cuts.append((begin, len(sizes)))
    return cuts


def list_array(rows: list[bytes], dtype: str) -> pa.Array:
    """A list column from one buffer of numbers per row."""
    sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // np.dtype(dtype).itemsize
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), dtype)))


def ids_by_word(ids: np.ndarray, begins: np.ndarray, n_words: int) -> list[bytes]:
    """Ids of ``n_words`` words encoded side by side, one buffer per word.

    ``begins[id]`` tells whether a piece opens a word. Where that does not give
    ``n_words`` words, the list is empty and the caller encodes one by one.
    """
    cuts = (np.flatnonzero(begins[ids]) * ids.itemsize).tolist()
    if len(cuts) != n_words or cuts[0]:
        return []
    data = ids.tobytes()
    return [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]


# --- hashes of all words of a buffer ---------------------------------------------------

BASE = 0x9E3779B97F4A7C15


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64; a longer text makes a longer table."""
    held = worker_cache("powers", dict)
    if len(held.get("up", ())) < size:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            factors = np.full(max(size, 1 << 21), base, np.uint64)
            factors[0] = 1
            held[name] = np.cumprod(factors, dtype=np.uint64)
    return held["up"], held["down"]


def run_hashes(data: np.ndarray, inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every maximal run of ``inside`` bytes, and the number of runs before each row.

    ``starts`` tells where the rows begin, and where the last ends; runs do not cross rows.
    """
    size = len(data)
    if not size:
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    borders = starts[(starts > 0) & (starts < size)]
    begins[borders] |= inside[borders]
    ends[borders - 1] |= inside[borders - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(size)
    sums = np.zeros(size + 1, np.uint64)
    np.cumsum((data + np.uint64(1)) * up[:size], dtype=np.uint64, out=sums[1:])
    return mixed((sums[last] - sums[first]) * down[first]), np.searchsorted(first, starts, "left")
