"""Language-model scoring with a sharded bigram trie in Elias-Fano levels.

The model is P(w | u) = (c(u, w) + m P(w)) / (c(u) + m), with the add-one unigram
P(w) = (c(w) + 1) / (N + V + 1). It is learned from all training documents:

1. Documents are blocked by id. A block sends its distinct words (hashes, packed)
   with their training counts to the task of their bucket, which answers with the
   corpus counts and gives every known word a number.
2. A block sends its distinct bigrams of known words to the shard of their context;
   a context of very many tokens is spread over shards by its successors. A shard
   builds its part of the trie: sorted contexts, Elias-Fano coded pointers to their
   successors, successor numbers made monotone by adding the last value of the
   context before, and smoothed probabilities quantised to a byte. The levels are
   written to a file, memory-mapped, and asked for every distinct bigram by a search
   among the successors of its context. The answer is one byte per bigram.
3. The block sums the logarithms by document.

Defined results: a null or empty text has one token, the end; a row without an id
is scored, not learned from, and not held out; repeated rows are scored each and,
when they train, counted each; an empty table gives no row; with no training text
every token has probability one.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlark.llm.common import mixed, run_hashes, slices, text_buffer, travels

travels(__name__)

BLOCK_DOCS = 2048
SLICE_BYTES = 1_500_000
# weight of the unigram in tokens
MASS = 8.0
# a context of so many training tokens is spread over the shards
HOT_CONTEXT = 1 << 17
END = np.uint64(0xE0D0C0B0A0908070)
# a byte holds floor(log10 p / STEP); 255 stands for an unseen bigram
STEP, UNSEEN = 0.045, 255


# --- packed integers -------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers in byte planes, only as many as the largest needs."""
    if not len(values):
        return b""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + planes.tobytes()


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8").astype(np.int64)


def pack_rising(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0))


def unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


# --- Elias-Fano ------------------------------------------------------------------------

_IN_BYTE = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    _set = [i for i in range(8) if _byte >> i & 1]
    _IN_BYTE[_byte, : len(_set)] = _set


def elias_fano(values: np.ndarray) -> dict[str, np.ndarray]:
    """A non-decreasing sequence: low bits packed, high bits in unary with a count before each word."""
    n = len(values)
    top = int(values[-1]) if n else 0
    low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
    low = np.zeros(((n * low_bits + 7) // 8 + 8,), np.uint8)
    step = 1 << 16  # eight rows fill whole bytes, so each part begins on one
    for a in range(0, n if low_bits else 0, step):
        part = values[a : a + step, None] >> np.arange(low_bits) & 1
        packed = np.packbits(part.astype(np.uint8).reshape(-1), bitorder="little")
        low[a * low_bits // 8 : a * low_bits // 8 + len(packed)] = packed
    at = (values >> low_bits) + np.arange(n)
    high = np.zeros((((top >> low_bits) + n) // 64 + 1) * 8, np.uint8)
    np.bitwise_or.at(high, at >> 3, (1 << (at & 7)).astype(np.uint8))
    counts = np.bitwise_count(high.view("<u8")).astype(np.int64)
    before = np.concatenate(([0], np.cumsum(counts)))
    return {"low": low, "high": high, "before": before, "bits": np.array([low_bits], np.int64)}


def ef_get(levels: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    """The values at the positions ``at``."""
    bits = int(levels["bits"][0])
    before, high, low = levels["before"], levels["high"], levels["low"]
    word = np.searchsorted(before, at, "right") - 1
    rest = at - before[word]
    rows = high.reshape(-1, 8)[word]
    counts = np.cumsum(np.bitwise_count(rows), axis=1, dtype=np.int64)
    byte = (counts <= rest[:, None]).sum(axis=1)
    within = rest - np.where(byte > 0, counts[np.arange(len(at)), byte - 1], 0)
    position = word * 64 + byte * 8 + _IN_BYTE[rows[np.arange(len(at)), byte], within]
    value = (position - at) << bits
    if bits:
        begin = at * bits
        around = low[(begin >> 3)[:, None] + np.arange(8)]
        value |= (np.ascontiguousarray(around).view("<u8").reshape(-1) >> (begin & 7).astype(np.uint64)).astype(
            np.int64
        ) & ((1 << bits) - 1)
    return value


class Trie:
    """Two levels of one shard: contexts with pointers, successors with quantised probabilities."""

    def __init__(self, contexts: np.ndarray, sizes: np.ndarray, successors: np.ndarray, codes: np.ndarray, path: str):
        ends = np.cumsum(sizes)
        last = successors[ends - 1] + 1 if len(ends) else ends
        base = np.cumsum(last) - last  # what the contexts before have added
        monotone = successors + np.repeat(base, sizes)
        parts = {"contexts": contexts, "codes": codes}
        for name, values in (("pointers", np.concatenate(([0], ends))), ("successors", monotone)):
            parts |= {f"{name}.{k}": v for k, v in elias_fano(values).items()}
        self.path = path
        self.n = len(monotone)
        self.places = {}
        with open(path, "wb") as f:
            for name, values in parts.items():
                f.write(b"\0" * (-f.tell() % 8))
                self.places[name] = (values.dtype.str, f.tell(), len(values))
                f.write(values.tobytes())

    def level(self, name: str) -> np.ndarray:
        kind, at, n = self.places[name]
        return np.memmap(self.path, kind, "r", at, (n,)) if n else np.zeros(0, kind)

    def coded(self, name: str) -> dict[str, np.ndarray]:
        return {k: self.level(f"{name}.{k}") for k in ("low", "high", "before", "bits")}

    def ask(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Code of each bigram; `UNSEEN` where the trie has none."""
        out = np.full(len(context), UNSEEN, np.uint8)
        if not self.n or not len(context):
            return out
        contexts, codes = self.level("contexts"), self.level("codes")
        pointers, successors = self.coded("pointers"), self.coded("successors")
        at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
        rows = np.flatnonzero(contexts[at] == context)
        low, high = ef_get(pointers, at[rows]), ef_get(pointers, at[rows] + 1)
        # the successors of a context begin at its base: one more than the last value before it
        target = word[rows] + np.where(low > 0, ef_get(successors, np.maximum(low - 1, 0)) + 1, 0)
        end = high.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            less = ef_get(successors, middle) < target[open_]
            low[open_] = np.where(less, middle + 1, low[open_])
            high[open_] = np.where(less, high[open_], middle)
        there = np.flatnonzero(low < end)
        hit = there[ef_get(successors, low[there]) == target[there]]
        out[rows[hit]] = codes[low[hit]]
        return out


def quantised(p: np.ndarray) -> np.ndarray:
    """Code of each probability, rounded down, so that sums stay below one."""
    return np.minimum(np.ceil(-np.log10(p) / STEP - 1e-9), UNSEEN - 1).astype(np.uint8)


def probabilities() -> np.ndarray:
    table = 10.0 ** (-STEP * np.arange(256))
    table[UNSEEN] = 0
    return table


# --- steps -----------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False


def token_hashes(column) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token of the texts, the end of each included, and where each text begins."""
    data, starts = text_buffer(column)
    words, befores = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    total = 0
    for a, b in slices(np.diff(starts), SLICE_BYTES):
        part = _LOWER[data[starts[a] : starts[b]]]
        found, before = run_hashes(part, _WORD[part], starts[a : b + 1] - starts[a])
        words.append(found)
        befores.append(before[1:] + total)
        total += len(found)
    before = np.concatenate(befores)
    tokens = np.insert(np.concatenate(words), before[1:], END)
    return tokens, before + np.arange(len(before))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema.names)


def _schema(**kinds) -> pa.Schema:
    types = {"int": pa.int32(), "long": pa.int64(), "bin": pa.binary()}
    return pa.schema([(k, types[v]) for k, v in kinds.items()])


WORDS = _schema(bucket="int", block="long", keys="bin", counts="bin")
KNOWN = _schema(block="long", kind="int", bucket="int", first="bin", second="bin")
PAIRS = _schema(bucket="int", block="long", contexts="bin", totals="bin", sizes="bin", words="bin", counts="bin")
DDL = {
    "words": "bucket int, block bigint, keys binary, counts binary",
    "known": "block bigint, kind int, bucket int, first binary, second binary",
    "pairs": "bucket int, block bigint, contexts binary, totals binary, sizes binary, words binary, counts binary",
}


def _distinct_words(buckets: int):
    """Distinct words of training texts, and the number of tokens, by bucket."""

    def words(batches):
        for batch in batches:
            tokens, _ = token_hashes(batch.column(0))
            keys, counts = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_pydict(
                dict(zip(("bucket", "n", "keys"), zip(*_split(keys, counts, buckets)))),
                schema=pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("keys", pa.binary())]),
            )

    return words


def _split(keys: np.ndarray, counts: np.ndarray, buckets: int):
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in range(buckets):
        own = order[cuts[k] : cuts[k + 1]]
        if len(own):
            yield k, int(counts[own].sum()), keys[own].tobytes()


def _count_distinct(table: pa.Table) -> pa.Table:
    keys = np.concatenate([np.frombuffer(k.as_py(), np.uint64) for k in table["keys"]])
    return pa.table([pa.array([int(np.sum(table["n"].to_numpy()))]), pa.array([len(np.unique(keys))])], ["n", "v"])


def totals(training: DataFrame) -> tuple[int, int, int]:
    """Documents, tokens and distinct tokens of the training texts (one column, ``text``)."""
    buckets = int(training.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = training.mapInArrow(_distinct_words(buckets), "bucket int, n bigint, keys binary")
    counted = words.groupBy("bucket").applyInArrow(_count_distinct, "n bigint, v bigint")
    n, v = counted.agg(F.sum("n"), F.sum("v")).first()
    return training.count(), n or 0, v or 0


def _block(table: pa.Table):
    """Tokens of a block in an order that every step repeats: rows sorted by id and text."""
    import pyarrow.compute as pc

    table = table.take(pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")]))
    tokens, starts = token_hashes(table["text"])
    keys, place = np.unique(tokens, return_inverse=True)
    trains = np.repeat(table["trains"].to_numpy(), np.diff(starts))
    return table, tokens, starts, keys, place, trains


def _send_words(buckets: int):
    def send(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        _, _, _, keys, place, trains = _block(table)
        counts = np.bincount(place, trains, len(keys)).astype(np.int64)
        rows = [
            (k, block, keys[own].tobytes(), pack(counts[own])) for k, own in _own(keys, buckets)
        ]
        return _table(rows, WORDS)

    return send


def _own(keys: np.ndarray, buckets: int):
    """Each bucket with the places of its keys, in order."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(k, order[cuts[k] : cuts[k + 1]]) for k in range(buckets) if cuts[k] < cuts[k + 1]]


def _answer_words(table: pa.Table) -> pa.Table:
    """Corpus counts for each block's words, and for the known ones their rank in the bucket."""
    parts = [np.frombuffer(k.as_py(), np.uint64) for k in table["keys"]]
    counts = np.concatenate([unpack(c.as_py()) for c in table["counts"]])
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(place, counts, len(keys)).astype(np.int64)
    rank = np.cumsum(total > 0) - 1
    rows, at = [], 0
    for block, bucket, own in zip(table["block"].to_pylist(), table["bucket"].to_pylist(), parts):
        mine = place[at : at + len(own)]
        at += len(own)
        known = total[mine] > 0
        rows.append((block, 0, bucket, pack(total[mine]), pack_rising(rank[mine][known])))
    return _table(rows, KNOWN)


def _known_words(keys: np.ndarray, answers: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Corpus count and number (0: unknown) of each distinct word of a block."""
    counts, numbers = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    places = dict(_own(keys, buckets))
    for kind, bucket, first, second in zip(*(answers[n].to_pylist() for n in ("kind", "bucket", "first", "second"))):
        if kind == 0:
            own = places[bucket]
            counts[own] = unpack(first)
            known = own[counts[own] > 0]
            # 0 is the unknown word and 1 the beginning of a text
            numbers[known] = unpack_rising(second) * buckets + bucket + 2
    return counts, numbers


def _bigrams(docs: pa.Table, answers: pa.Table, buckets: int, n_docs: int):
    """Distinct known bigrams of a block in the order of their shards, and per token its bigram (-1: none)."""
    docs, _, starts, keys, place, trains = _block(docs)
    counts, numbers = _known_words(keys, answers, buckets)
    word, count = numbers[place], counts[place]
    context, total = np.empty_like(word), np.empty_like(count)
    context[1:], total[1:] = word[:-1], count[:-1]
    context[starts[:-1]], total[starts[:-1]] = 1, n_docs
    known = np.flatnonzero((word > 0) & (context > 0) & (total > 0))
    order = known[np.lexsort((word[known], context[known]))]
    new = np.ones(len(order), bool)
    new[1:] = (context[order][1:] != context[order][:-1]) | (word[order][1:] != word[order][:-1])
    group = np.cumsum(new) - 1
    heads = order[new]
    seen = np.bincount(group, trains[order], len(heads)).astype(np.int64)
    u, w, t = context[heads], word[heads], total[heads]
    hashed = np.where(t >= HOT_CONTEXT, u * 0x9E3779B1 + w, u)
    shard = (mixed(hashed.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    by_shard = np.argsort(shard, kind="stable")  # within a shard by context and word
    number = np.empty(len(heads), np.int64)
    number[by_shard] = np.arange(len(heads))
    bigram = np.full(len(word), -1, np.int64)
    bigram[order] = number[group]
    cuts = np.searchsorted(shard[by_shard], np.arange(buckets + 1))
    pairs = (u[by_shard], w[by_shard], t[by_shard], seen[by_shard])
    return docs, starts, count, total, bigram, pairs, cuts


def _send_pairs(buckets: int, n_docs: int):
    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return _table([], PAIRS)
        block = docs["block"][0].as_py()
        *_, (u, w, t, seen), cuts = _bigrams(docs, answers, buckets, n_docs)
        rows = []
        for k in range(buckets):
            a, b = int(cuts[k]), int(cuts[k + 1])
            if a < b:
                new = np.concatenate(([True], u[a:b][1:] != u[a:b][:-1]))
                heads = np.flatnonzero(new)
                sizes = np.diff(np.concatenate((heads, [b - a])))
                rows.append(
                    (k, block, pack_rising(u[a:b][heads]), pack(t[a:b][heads]), pack(sizes), pack(w[a:b]), pack(seen[a:b]))
                )
        return _table(rows, PAIRS)

    return send


def _answer_pairs(table: pa.Table) -> pa.Table:
    """Build the shard's trie of all blocks' bigrams and answer every block."""
    us, ts, ws, cs = [], [], [], []
    for row in range(len(table)):
        heads, total, sizes, w, c = (
            table[n][row].as_py() for n in ("contexts", "totals", "sizes", "words", "counts")
        )
        sizes = unpack(sizes)
        us.append(np.repeat(unpack_rising(heads), sizes))
        ts.append(np.repeat(unpack(total), sizes))
        ws.append(unpack(w))
        cs.append(unpack(c))
    lengths = [len(u) for u in us]
    u, t, w, c = (np.concatenate(x) for x in (us, ts, ws, cs))
    del us, ts, ws, cs
    order = np.lexsort((w, u))
    new = np.ones(len(order), bool)
    new[1:] = (u[order][1:] != u[order][:-1]) | (w[order][1:] != w[order][:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    heads = order[new]
    u, w, t = u[heads], w[heads], t[heads]
    seen = np.bincount(group, c, len(heads))
    held = np.flatnonzero(seen > 0)
    first = np.ones(len(held), bool)
    first[1:] = u[held][1:] != u[held][:-1]
    sizes = np.diff(np.concatenate((np.flatnonzero(first), [len(held)])))
    codes = quantised(seen[held] / (t[held] + MASS))
    with tempfile.TemporaryDirectory() as folder:
        trie = Trie(u[held][first], sizes, w[held], codes, os.path.join(folder, "trie"))
        found = np.concatenate(
            [np.zeros(0, np.uint8), *[trie.ask(u[a : a + 200_000], w[a : a + 200_000]) for a in range(0, len(u), 200_000)]]
        )
    answers = found[group]
    rows, at = [], 0
    for block, bucket, n in zip(table["block"].to_pylist(), table["bucket"].to_pylist(), lengths):
        rows.append((block, 1, bucket, answers[at : at + n].tobytes(), b""))
        at += n
    return _table(rows, KNOWN)


SCORES = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def _score(buckets: int, n_docs: int, n: int, v: int):
    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(docs):
            return pa.table([pa.array([], f.type) for f in SCORES], SCORES.names)
        docs, starts, count, total, bigram, (u, *_), cuts = _bigrams(docs, answers, buckets, n_docs)
        codes = np.full(len(u) + 1, UNSEEN, np.uint8)  # the last one stands for no bigram
        for kind, bucket, first in zip(*(answers[x].to_pylist() for x in ("kind", "bucket", "first"))):
            if kind == 1:
                codes[cuts[bucket] : cuts[bucket + 1]] = np.frombuffer(first, np.uint8)
        unigram = (count + 1) / (n + v + 1)
        both = probabilities()[codes[bigram]] + unigram * MASS / (total + MASS)
        # no probability above one, however the parts are rounded
        model = np.log10(np.minimum(both, 1.0))
        known = (count > 0).astype(np.int64)
        at = starts[:-1]
        return pa.table(
            [
                docs["doc_id"].combine_chunks(),
                pa.array(np.diff(starts)),
                pa.array(np.add.reduceat(known, at)),
                pa.array(np.add.reduceat(np.log10(unigram), at)),
                pa.array(np.add.reduceat(model, at)),
            ],
            SCORES.names,
        )

    return score


def score_texts(docs: DataFrame, trains: Column, *, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of ``docs`` (``doc_id bigint, text``).

    ``trains`` says which rows to learn from (null: not).
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    learned = F.coalesce(trains, F.lit(False))
    n_docs, n, v = totals(docs.filter(learned).select("text"))
    # rows without an id are dealt out by their text
    block = F.coalesce(
        F.floor(F.col("doc_id") / block_docs).cast("bigint"), -1 - F.pmod(F.xxhash64("text"), F.lit(1024))
    )
    blocks = docs.select("doc_id", "text", learned.alias("trains"), block.alias("block")).repartition("block")
    words = blocks.groupBy("block").applyInArrow(_send_words(buckets), DDL["words"])
    known = words.groupBy("bucket").applyInArrow(_answer_words, DDL["known"])
    pairs = (
        blocks.groupBy("block")
        .cogroup(known.groupBy("block"))
        .applyInArrow(_send_pairs(buckets, n_docs), DDL["pairs"])
    )
    answers = pairs.groupBy("bucket").applyInArrow(_answer_pairs, DDL["known"])
    scored = (
        blocks.groupBy("block")
        .cogroup(known.unionByName(answers).groupBy("block"))
        .applyInArrow(
            _score(buckets, n_docs, n, v),
            "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double",
        )
    )
    return scored.withColumn("train_tokens", F.lit(n).cast("bigint"))
