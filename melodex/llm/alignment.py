"""Aligning the tokens that two tokenizers make of the same texts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from melodex.llm.chunks import ChunkTable, encode_alone, encode_joined, interleave, ragged, slices
from melodex.llm.common import ship
from melodex.session import materialise

ship(__name__)

MARKER = "▁"
# a blank with other white space beside it, or white space at an end: there a text isn't simply cut at its blanks
ODD_BLANKS = re.compile(r" \s|\s |\A\s|\s\Z")
LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
# windows kept in a task's table; a full table is emptied, which changes no result
TABLE_WINDOWS = 200_000
# windows looked up at a time, and bytes of text aligned at a time
KEYS, SLICE_BYTES = 50_000, 4_000_000
LOW = (1 << 32) - 1


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the
    others for the code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def lone_blank_chunks(text: str) -> list[str]:
    """The text cut at every blank between two characters that are no white space. Neither a byte-level pattern
    nor a marked piece reaches from such a character over the blank, so a chunk's tokens are its own."""
    return LONE_BLANK.split(text) if ODD_BLANKS.search(text) else text.split(" ")


class TokenizerPair:
    """Both tokenizers: ids of chunks, the bytes of each id, and which ids begin with a blank."""

    def __init__(self, a_json: str, b_model: bytes):
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters, vocabulary = byte_letters(), self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, place in vocabulary.items():
            if all(c in letters for c in token):
                self.a_bytes[place] = bytes(letters[c] for c in token)
        self.b_bytes = [
            bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(MARKER, " ").encode()
            for i, piece in enumerate(self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        ]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(MARKER in piece.lstrip(MARKER) for piece in pieces):
            raise ValueError("pieces of this model cross white space: chunks can't be encoded one by one")
        self.a_lengths = np.array([len(x) for x in self.a_bytes], np.int32)
        self.b_lengths = np.array([len(x) for x in self.b_bytes], np.int32)
        self.a_marked = np.array([x.startswith(b" ") for x in self.a_bytes])
        self.b_marked = np.array([x.startswith(b" ") for x in self.b_bytes])

    def ids(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for the chunks, and how many each has. Chunks with odd blanks can't be joined: they are encoded alone."""
        odd = np.array([bool(ODD_BLANKS.search(chunk)) for chunk in chunks], bool)
        simple = [chunk for chunk, is_odd in zip(chunks, odd) if not is_odd]
        others = [chunk for chunk, is_odd in zip(chunks, odd) if is_odd]
        a = encode_joined(simple, self._a_together, self._a_alone, lambda ids: np.flatnonzero(self.a_marked[ids]))
        b = encode_joined(simple, self._b_together, self.b.encode, lambda ids: np.flatnonzero(self.b_marked[ids]))
        apart = [encode_alone(others, alone) for alone in (self._a_alone, self.b.encode)]
        return [interleave(a, apart[0], odd), interleave(b, apart[1], odd)]

    def _a_together(self, chunks: list[str]) -> list[int]:
        return self.a.encode(" " + " ".join(chunks), add_special_tokens=False).ids

    def _a_alone(self, chunks: list[str]) -> list[list[int]]:
        return [x.ids for x in self.a.encode_batch([" " + chunk for chunk in chunks], add_special_tokens=False)]

    def _b_together(self, chunks: list[str]) -> list[int]:
        return self.b.encode(" ".join(chunks))

    def faithful(self, chunk: str, a: np.ndarray, b: np.ndarray) -> bool:
        whole = b" " + chunk.encode()
        return whole == b"".join([self.a_bytes[i] for i in a]) == b"".join([self.b_bytes[i] for i in b])

    def all_faithful(self, chunks: list[str], found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Whether the bytes of both are those of the chunk, for each chunk."""
        wholes = [b" " + chunk.encode() for chunk in chunks]
        sizes, together = np.fromiter(map(len, wholes), np.int64, len(wholes)), b"".join(wholes)
        good = np.ones(len(chunks), bool)
        for (ids, lengths), table, byte_lengths in zip(found, (self.a_bytes, self.b_bytes), (self.a_lengths, self.b_lengths)):
            ends = np.cumsum(lengths)
            made = np.diff(np.concatenate([[0], np.cumsum(byte_lengths[ids])])[np.concatenate([[0], ends])])
            if not np.array_equal(made, sizes) or b"".join(map(table.__getitem__, ids.tolist())) != together:
                parts = np.split(ids, ends[:-1])
                good &= [whole == b"".join([table[i] for i in part]) for whole, part in zip(wholes, parts)]
        return good


class PairTable(ChunkTable):
    """Ids of both tokenizers for each chunk, and whether both stand for exactly the chunk's bytes."""

    def __init__(self, pair: TokenizerPair):
        self.pair = pair
        super().__init__(lambda chunks: pair.ids(chunks)[0])

    def clear(self) -> None:
        super().clear()
        self.other = ChunkTable(lambda chunks: self.pair.ids(chunks)[1])
        self.faithful = np.zeros(0, bool)

    def settle(self) -> None:
        if self.new:
            found = self.pair.ids(self.new)
            self.faithful = np.concatenate([self.faithful, self.pair.all_faithful(self.new, found)])
            self.add(*found[0])
            self.other.add(*found[1])
            self.new = []


class WindowTable(dict):
    """Alignment of each pair of id tuples met: its groups as text, how many, and the pairs of ids that end together.

    Codes are given out in the order of first occurrence; ``settle`` aligns the new windows, all at once.
    """

    def __init__(self, pair: TokenizerPair):
        self.pair = pair
        # each id as it is written in the middle and at the end of its side of a group: A's ids, then B's
        signs = [f"{i}{sign}" for i in range(len(pair.a_bytes)) for sign in ",|"]
        signs += [f"{i}{sign}" for i in range(len(pair.b_bytes)) for sign in ",;"]
        self.signs = pa.array(signs, pa.large_string())
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.new: list[tuple[bytes, bytes]] = []
        self.texts: list[str] = []  # every group with a semicolon after it
        self.counts = np.zeros(0, np.int64)  # groups, and so links, of each window
        self.links = np.zeros(0, np.int32)  # numbers of pairs, window after window
        self.numbers: dict[int, int] = {}  # of each pair of ids

    def __missing__(self, key: tuple[bytes, bytes]) -> int:
        code = self[key] = len(self)
        self.new.append(key)
        return code

    def codes(self, windows) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, windows), np.int32)

    def settle(self) -> None:
        """Align the new windows. Both sides of a window have the same bytes, so windows laid end to end share the
        ends that each has alone."""
        if not self.new:
            return
        sides = list(zip(*self.new))
        a, b = (np.frombuffer(b"".join(side), "<i4") for side in sides)
        a_borders, b_borders = (np.cumsum([0, *map(len, side)]) // 4 for side in sides)
        a_ends, b_ends = np.cumsum(self.pair.a_lengths[a]), np.cumsum(self.pair.b_lengths[b])
        other = np.searchsorted(b_ends, a_ends)
        a_shared = b_ends[other] == a_ends
        a_last = np.flatnonzero(a_shared)  # of each group
        b_last = other[a_last]
        b_shared = np.zeros(len(b), bool)
        b_shared[b_last] = True
        counts = np.diff(np.searchsorted(a_last, a_borders))

        # a group's A ids follow the B ids of the groups before, its B ids follow its own A ids
        a_group, b_group = np.cumsum(a_shared) - a_shared, np.cumsum(b_shared) - b_shared
        signs = np.empty(len(a) + len(b), np.int32)
        signs[np.arange(len(a)) + np.concatenate([[0], b_last + 1])[a_group]] = 2 * a + a_shared
        signs[np.arange(len(b)) + a_last[b_group] + 1] = 2 * (len(self.pair.a_bytes) + b) + b_shared
        written = self.signs.take(pa.array(signs))
        borders = np.frombuffer(written.buffers()[1], np.int64)[a_borders + b_borders]
        texts = pa.LargeStringArray.from_buffers(len(self.new), pa.py_buffer(borders), written.buffers()[2])

        found, place = np.unique(a[a_last].astype(np.int64) << 32 | b[b_last], return_inverse=True)
        numbers = self.numbers
        numbered = np.array([numbers.setdefault(p, len(numbers)) for p in found.tolist()], np.int32)
        self.texts += texts.to_pylist()
        self.counts = np.concatenate([self.counts, counts])
        self.links = np.concatenate([self.links, numbered[place]])
        self.new = []


class Aligned:
    """The alignments of a slice of texts, one document after the other."""

    def __init__(self, texts: list[bytes], chunks: PairTable, windows: WindowTable):
        pair = chunks.pair
        chunks.make_room()
        if len(windows) >= TABLE_WINDOWS:
            windows.clear()
        codes = [chunks.codes(lone_blank_chunks(text.decode()) if text else []) for text in texts]
        chunks.settle()
        for i, found in enumerate(codes):
            if len(found) and not chunks.faithful[found].all():
                a, b = (table.gather(found)[0] for table in (chunks, chunks.other))
                if not pair.faithful(texts[i].decode(), a, b):
                    codes[i] = found[:0]
        together = np.concatenate([*codes, np.zeros(0, np.int32)])
        borders = np.cumsum([0, *map(len, codes)])
        a, per_chunk = chunks.gather(together)
        self.a_borders = np.concatenate([[0], np.cumsum(per_chunk)])[borders]
        b, per_chunk = chunks.other.gather(together)
        self.b_borders = np.concatenate([[0], np.cumsum(per_chunk)])[borders]
        a_starts, b_starts = np.cumsum(pair.a_lengths[a]), np.cumsum(pair.b_lengths[b])
        a_starts, b_starts = a_starts - pair.a_lengths[a], b_starts - pair.b_lengths[b]
        # windows begin where tokens of both begin with a blank at the same byte: all before it ends together there
        a_places, b_places = np.flatnonzero(pair.a_marked[a]), np.flatnonzero(pair.b_marked[b])
        where = np.searchsorted(b_starts[b_places], a_starts[a_places])
        where = np.minimum(where, max(0, len(b_places) - 1))
        shared = b_starts[b_places[where]] == a_starts[a_places] if len(b_places) else np.zeros(0, bool)
        a_from, b_from = a_places[shared], b_places[where[shared]] if len(b_places) else b_places
        self.borders = np.searchsorted(a_from, self.a_borders)  # windows of each document
        a_ids, b_ids = a.astype("<i4").tobytes(), b.astype("<i4").tobytes()
        a_from, b_from = np.append(a_from * 4, len(a_ids)), np.append(b_from * 4, len(b_ids))
        self.windows = np.zeros(len(a_from) - 1, np.int32)
        for start in range(0, len(self.windows), KEYS):  # a list of all places would take much memory
            i, k = a_from[start : start + KEYS + 1].tolist(), b_from[start : start + KEYS + 1].tolist()
            keys = ((a_ids[p:q], b_ids[r:t]) for p, q, r, t in zip(i, i[1:], k, k[1:]))
            self.windows[start : start + KEYS] = windows.codes(keys)
        windows.settle()
        self.table = windows

    def groups(self, i: int) -> str:
        windows = self.windows[self.borders[i] : self.borders[i + 1]].tolist()
        return "".join(map(self.table.texts.__getitem__, windows))[:-1]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the linked pairs, and how many links each document has."""
        counts = self.table.counts
        starts = np.cumsum(counts) - counts
        lengths = counts[self.windows]
        numbers = self.table.links[ragged(starts[self.windows], lengths)]
        return numbers, np.diff(np.concatenate([[0], np.cumsum(lengths)])[self.borders])


def _longs(values) -> pa.Array:
    return pa.array(values, pa.int64())


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _group_batches(load):
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load()
        chunks, windows = PairTable(pair), WindowTable(pair)
        for batch in batches:
            for start, stop in slices(batch.column(1), SLICE_BYTES):
                texts = [text or b"" for text in batch.column(1).slice(start, stop - start).cast(pa.binary()).to_pylist()]
                found = Aligned(texts, chunks, windows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        _longs(np.diff(found.a_borders)),
                        _longs(np.diff(found.b_borders)),
                        pa.array([found.groups(i) for i in range(len(texts))], pa.string()),
                    ],
                    names=["id", "n_a", "n_b", "groups"],
                )

    return per_batch


def _block_batches(load):
    """A row per slice: its documents' figures, its distinct linked pairs, and the documents' links as places among them."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load()
        chunks, windows = PairTable(pair), WindowTable(pair)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, stop in slices(batch.column(1), SLICE_BYTES):
                texts = [text or b"" for text in batch.column(1).slice(start, stop - start).cast(pa.binary()).to_pylist()]
                found = Aligned(texts, chunks, windows)
                numbers, n_links = found.links()
                times = np.bincount(numbers, minlength=len(windows.numbers))
                used = np.flatnonzero(times)
                place = np.zeros(len(times), np.int32)
                place[used] = np.arange(len(used))
                pairs = np.fromiter(windows.numbers, np.int64, len(windows.numbers))[used]
                hashes = [
                    hashlib.sha256(found.groups(i).encode()).hexdigest() if found.borders[i] < found.borders[i + 1] else ""
                    for i in range(len(texts))
                ]
                columns = [
                    _list(batch.column(0).slice(start, stop - start)),
                    *(_list(_longs(x)) for x in (np.diff(found.a_borders), np.diff(found.b_borders), n_links)),
                    _list(pa.array(hashes, pa.string())),
                    pa.array([place[numbers].astype("<u2" if len(used) < 1 << 16 else "<u4").tobytes()], pa.binary()),
                    *(_list(_longs(x)) for x in (pairs, times[used])),
                ]
                names = ["ids", "n_a", "n_b", "n_links", "groups_sha256", "links", "pairs", "times"]
                yield pa.RecordBatch.from_arrays([_longs([block]), *columns], names=["block", *names])
                block += 1

    return per_batch


def _sum_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a block with the sums over their links."""
    for batch in batches:
        for row in range(batch.num_rows):
            ids, n_a, n_b, n_links, hashes = (batch.column(k)[row].values for k in range(5))
            links, count, best = batch.column(5)[row].as_py(), batch.column(6)[row].values, batch.column(7)[row].values
            count = np.zeros(0, np.int64) if count is None else count.to_numpy()
            best = np.zeros(0, np.int64) if best is None else best.to_numpy()
            places = np.frombuffer(links, "<u2" if len(count) < 1 << 16 else "<u4")
            ends = np.concatenate([[0], np.cumsum(n_links.to_numpy())])
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[places])])[ends]) for x in (best, count)]
            yield pa.RecordBatch.from_arrays(
                [ids, n_a, n_b, n_links, n_links, *map(_longs, sums), hashes],
                names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def _loader(docs: DataFrame, a_json: str, b_model: bytes):
    TokenizerPair(a_json, b_model)  # raises here, rather than in a task, if the model does not allow it
    sent = docs.sparkSession.sparkContext.broadcast((a_json, b_model))
    return lambda: TokenizerPair(*sent.value)


def _schema(id_type: T.DataType, *columns: tuple[str, str]) -> T.StructType:
    simple = {"long": T.LongType(), "string": T.StringType()}
    return T.StructType([T.StructField("id", id_type), *(T.StructField(n, simple[t]) for n, t in columns)])


def aligned_groups(
    docs: DataFrame, a_json: str, b_model: bytes, *, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, ``n_a``, ``n_b`` and ``groups``, written ``a1,a2|b1;a3|b2,b3``.

    A (a byte-level tokenizer) encodes a blank and the text, B (a SentencePiece model, which puts the blank itself) the text, whole
    and without special tokens. Groups end at the byte offsets where tokens of both end. A null or empty text,
    and one whose tokens' bytes are not exactly a blank and the text, has no tokens and no groups.

    Where a shared end lies before tokens of both that begin with a blank, the ids are cut into windows; a
    window's groups follow from its two id tuples, so each task aligns each pair of tuples once.
    """
    load = _loader(docs, a_json, b_model)
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    schema = _schema(docs.schema[id_column].dataType, ("n_a", "long"), ("n_b", "long"), ("groups", "string"))
    return slim.mapInArrow(_group_batches(load), schema).withColumnRenamed("id", id_column)


def alignment_figures(
    docs: DataFrame, a_json: str, b_model: bytes, *, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    The groups are those of ``aligned_groups``. A link is a pair of an A and a B token that end together (no token
    is without bytes, so every group has one). A pair of ids counts as often as it is linked in all
    documents; ``count_sum`` adds up these counts over a document's links, and ``n_best`` counts the links whose
    pair has the highest count of its B id. Rows that share an id keep their own rows.

    Documents are stored in blocks with the distinct pairs of each, so the join with all counts has a row per block
    and pair instead of one per link, and a pair found everywhere has one row per block.
    """
    id_type = docs.schema[id_column].dataType
    long, longs = T.LongType(), T.ArrayType(T.LongType())
    schema = T.StructType(
        [
            T.StructField("block", long),
            T.StructField("ids", T.ArrayType(id_type)),
            *(T.StructField(name, longs) for name in ("n_a", "n_b", "n_links")),
            T.StructField("groups_sha256", T.ArrayType(T.StringType())),
            T.StructField("links", T.BinaryType()),
            *(T.StructField(name, longs) for name in ("pairs", "times")),
        ]
    )
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    blocks = materialise(slim.mapInArrow(_block_batches(_loader(docs, a_json, b_model)), schema), "aligned-blocks")
    entries = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "entry"))
    entries = entries.select("block", "place", F.col("entry.pairs").alias("pair"), F.col("entry.times").alias("times"))
    counts = materialise(entries.groupBy("pair").agg(F.sum("times").alias("count")), "aligned-pairs")
    b_id = F.col("pair").bitwiseAND(F.lit(LOW).cast("long"))
    highest = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("highest"))
    judged = counts.join(highest, b_id == F.col("b")).select(
        F.col("pair").alias("__pair"), "count", (F.col("count") == F.col("highest")).cast("long").alias("best")
    )
    found = (
        entries.join(judged, F.col("pair") == F.col("__pair"))
        .groupBy(F.col("block").alias("__block"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "count", "best"))).alias("found"))  # pairs of one block
    )
    figures = blocks.join(found, F.col("block") == F.col("__block"), "left").select(
        "ids",
        "n_a",
        "n_b",
        "n_links",
        "groups_sha256",
        "links",
        F.transform("found", lambda x: x["count"]).alias("count"),
        F.transform("found", lambda x: x["best"]).alias("best"),
    )
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    out = _schema(id_type, *((name, "long") for name in names), ("groups_sha256", "string"))
    return figures.mapInArrow(_sum_batches, out).withColumnRenamed("id", id_column)
