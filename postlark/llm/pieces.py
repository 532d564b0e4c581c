"""SentencePiece encoding and decoding by a table of distinct chunks.

No piece of a suitable model holds a whitespace marker after another character,
so no merge crosses the start of a marked word. Each task keeps a table of
distinct marked words, segments every new one once with the library, and joins
the ids back by position. New words go to the library side by side, many in one
text, and are told apart by the pieces that open with a marker. The table is a
cache of the Python worker and is emptied at a fixed number of entries, so its
memory is bounded; no text moves.

Defined results: a null or empty text has no pieces but the end id; repeated
rows give one result each; an empty table gives none.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from postlark.llm.common import fresh, ids_by_word, list_array, slices, travels, with_fields, worker_cache

travels(__name__)

MARK = "▁"
MARKED_WORD = re.compile(f"{MARK}+[^{MARK}]*")
# a table beyond this is emptied and filled anew
TABLE_ENTRIES = 500_000
SLICE_BYTES = 4_000_000
# new words that the library gets in one text
TOGETHER = 1_000


def check_model(model) -> None:
    """Refuse a model for which segmenting marked words one by one is not exact."""
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if MARK in piece.lstrip(MARK):
            raise ValueError(f"piece {piece!r} crosses a whitespace marker")
    for probe in ("  a  b ", "ﬁ\t２ x"):
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("the model normalises more than white space")


class ChunkTable:
    """Ids of distinct marked words, as bytes of 32-bit integers.

    A word is stored without its first marker, which the library adds again.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        check_model(self.model)
        pieces = range(self.model.get_piece_size())
        self.opens = np.array([self.model.id_to_piece(i).startswith(MARK) for i in pieces])
        # the library adds no marker to an empty text; a lone marker is what follows a word
        bare, alone = self.model.encode("a"), self.model.encode("a ")
        self.lone = np.array(alone[len(bare) :], np.int32).tobytes()
        self.ids: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if w and " " not in w]
        for at in range(0, len(plain), TOGETHER):
            part = plain[at : at + TOGETHER]
            ids = np.array(self.model.encode(" ".join(part)), np.int32)
            self.ids.update(zip(part, ids_by_word(ids, self.opens, len(part))))
        self.ids[""] = self.lone
        for word in words:
            if word not in self.ids:
                self.ids[word] = np.array(self.model.encode(word), np.int32).tobytes()

    @staticmethod
    def _words(text: str) -> list[str]:
        if not text:
            return []
        words = text.replace(MARK, " ").split(" ")
        if "" in words:
            marked = MARK + " ".join(words).replace(" ", MARK)
            words = [w[1:].replace(MARK, " ") for w in MARKED_WORD.findall(marked)]
        return words

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; words that the table lacks are segmented together."""
        split = [self._words(text) for text in texts]
        if len(self.ids) > TABLE_ENTRIES:
            self.ids.clear()
        self._learn([w for w in set().union(*split) if w not in self.ids])
        return [b"".join(map(self.ids.__getitem__, words)) for words in split]


def _table(path: str) -> ChunkTable:
    return worker_cache(f"pieces_{path}", lambda: ChunkTable(path))


def _encode(path: str, end: bool):
    def encode(batches):
        table = _table(path)
        tail = np.array([table.model.eos_id()], np.int32).tobytes() if end else b""
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
            for a, b in slices(sizes, SLICE_BYTES):
                rows = [ids + tail for ids in table.encode(pc.fill_null(texts[a:b], "").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], list_array(rows, "int32")], ["doc_id", "ids"]
                )

    return encode


def encode_pieces(docs: DataFrame, model_path: str, *, end: bool = True) -> DataFrame:
    """``doc_id, ids`` of ``docs`` (``doc_id, text``, text not null); ``end`` appends the end id."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _encode(model_path, end), f"doc_id {kind}, ids array<int>"
    )


def _decode(path: str, ids: str, text: str):
    def decode(batches):
        model = _table(path).model
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            for a, b in slices(sizes, SLICE_BYTES // 4):
                rows = [model.decode(x or []) for x in column[a:b].to_pylist()]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(rows, pa.string())], [*part.schema.names, text]
                )

    return decode


def decode_pieces(encoded: DataFrame, model_path: str, *, ids_col="ids", text_col="decoded") -> DataFrame:
    """``encoded`` with the text that the library decodes from ``ids_col`` (null: the empty text)."""
    text_col = fresh(text_col, encoded.columns)
    schema = with_fields(encoded.schema, f"{text_col} string")
    return encoded.mapInArrow(_decode(model_path, ids_col, text_col), schema)
