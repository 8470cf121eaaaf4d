"""Encoding texts into sentence pieces and back, one segmentation per distinct marked word."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from melodex.llm.common import ship

ship(__name__)

MARKER = "▁"
# a marked word: a run of markers and what follows up to the next marker; or markers alone at the end
MARKED_WORD = re.compile(f"{MARKER}*[^{MARKER}]+|{MARKER}+")
# words kept in a task's table; longer ones are segmented where they stand
TABLE_WORDS = 200_000
TABLE_WORD_LENGTH = 48
# characters of text whose pieces are held at a time
BATCH_CHARACTERS = 4_000_000


class WordTable:
    """Distinct marked words with their ids and what the ids decode to.

    No piece of the vocabulary holds a marker after another character, so no merge crosses from a character
    to a marker: a text's pieces are the pieces of its marked words, one after the other.
    """

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        crossing = [p for p in pieces if MARKER in p.lstrip(MARKER)]
        if crossing or self.library.encode("a b") != self.library.encode("a") + self.library.encode("b"):
            raise ValueError("pieces of this model cross white space: words can't be segmented one by one")
        self.marker_id = self.library.piece_to_id(MARKER)
        self.ids, self.surfaces = _Ids(self), _Surfaces(self)

    def segment(self, word: str) -> tuple[bytes, str]:
        """Ids of a marked word, as 32-bit numbers, and the text they stand for, with a blank for every marker."""
        if word == MARKER:
            return np.int32(self.marker_id).tobytes(), " "
        ids = self.library.encode(word[1:])  # the library puts the first marker back
        return np.array(ids, np.int32).tobytes(), " " + self.library.decode(ids)

    def add(self, word: str) -> tuple[bytes, str]:
        entry = self.segment(word)
        if len(word) <= TABLE_WORD_LENGTH:
            if len(self.ids) >= TABLE_WORDS:
                self.ids.clear()
                self.surfaces.clear()
            self.ids[word], self.surfaces[word] = entry
        return entry

    def encode(self, text: str) -> tuple[bytes, str]:
        if not text:
            return b"", ""
        words = MARKED_WORD.findall(MARKER + text.replace(" ", MARKER))
        ids = b"".join(map(self.ids.__getitem__, words))
        return ids, "".join(map(self.surfaces.__getitem__, words))[1:]


class _Ids(dict):
    def __init__(self, table: WordTable):
        self.table = table

    def __missing__(self, word: str) -> bytes:
        return self.table.add(word)[0]


class _Surfaces(dict):
    def __init__(self, table: WordTable):
        self.table = table

    def __missing__(self, word: str) -> str:
        return self.table.add(word)[1]


def _encode_batches(load):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load()
        for batch in batches:
            texts, start, held = batch.column(1), 0, 0
            ids, decoded = [], []
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                found, surface = table.encode(text)
                ids.append(found)
                decoded.append(surface)
                held += len(text)
                if held >= BATCH_CHARACTERS or i == batch.num_rows - 1:
                    offsets = np.cumsum([0, *map(len, ids)], dtype=np.int64) // 4
                    values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
                    key = batch.column(0).slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays(
                        [key, lists, pa.array(decoded, pa.string())], names=["id", "ids", "decoded"]
                    )
                    start, held, ids, decoded = i + 1, 0, [], []

    return encode


def encode_documents(
    docs: DataFrame, model: bytes, *, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, ``ids`` (all pieces, no begin or end id) and ``decoded`` (the ids' text).

    ``model`` is a SentencePiece model as bytes (half a megabyte for 32,000 pieces), sent to the executors as a
    broadcast variable. Each task keeps a table of the distinct marked words it has met, of bounded size, and
    segments a word only when the table lacks it; ids are joined back in the order of the words. A null or
    empty text has no ids and decodes to the empty text. Rows are encoded one by one: equal rows give equal
    results.
    """
    spark = docs.sparkSession
    WordTable(model)  # raises here, rather than in a task, if the model does not allow it
    sent = spark.sparkContext.broadcast(model)
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_column].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    return slim.mapInArrow(_encode_batches(lambda: WordTable(sent.value)), schema).withColumnRenamed("id", id_column)
