"""A task's table of distinct chunks of text and their token ids."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from melodex.llm.common import ship

ship(__name__)

# chunks kept in a task's table; a full table is emptied, which changes no result
TABLE_CHUNKS = 400_000
# bytes of text worked on at a time; a longer text is a slice of its own
SLICE_BYTES = 6_000_000
# words handed to a library as one text
JOINED = 4_000


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of runs that start at ``starts`` and have ``lengths``, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class ChunkTable(dict):
    """Codes of the chunks met, in the order of their first occurrence; ``gather`` gives ids for codes.

    ``encode`` gets the new chunks of a slice together and returns their ids, one chunk after the other, and how
    many each has.
    """

    def __init__(self, encode: Callable[[list], tuple[np.ndarray, np.ndarray]], most: int | None = None):
        self.encode, self.most = encode, TABLE_CHUNKS if most is None else most
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.new: list = []
        self.values = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)  # of each chunk's ids, and the end of the last

    def __missing__(self, chunk) -> int:
        code = self[chunk] = len(self)
        self.new.append(chunk)
        return code

    def make_room(self) -> None:
        """Call it between slices: codes handed out before are void if the table was full."""
        if len(self) >= self.most:
            self.clear()

    def codes(self, chunks: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, chunks), np.int32, len(chunks))

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks, one after the other, and how many each chunk has."""
        self.settle()
        starts = self.starts[codes]
        lengths = self.starts[codes + 1] - starts
        return self.values[ragged(starts, lengths)], lengths

    def settle(self) -> None:
        if self.new:
            self.add(*self.encode(self.new))
            self.new = []

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        self.values = np.concatenate([self.values, values])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])


class TextTable:
    """Distinct texts met, as one Arrow column, and the ids of each; a text's code is its place in the column.

    ``encode`` gets the new texts of a slice together, as an Arrow column, and returns their ids, one text after the
    other, and how many each has. No text becomes a Python string to be looked up.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int, most_bytes: int):
        self.encode, self.most, self.most_bytes = encode, most, most_bytes
        self.clear()

    def clear(self) -> None:
        self.texts = pa.array([], pa.string())
        self.values = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)  # of each text's ids, and the end of the last

    def make_room(self) -> None:
        """Call it between slices: codes handed out before are void if the table was full."""
        if len(self.texts) >= self.most or self.texts.nbytes >= self.most_bytes:
            self.clear()

    def codes(self, texts: pa.Array) -> np.ndarray:
        """Codes of texts that may repeat."""
        coded = texts.dictionary_encode()
        found = pc.index_in(coded.dictionary, value_set=self.texts)
        if found.null_count:
            new = coded.dictionary.filter(pc.is_null(found))
            values, lengths = self.encode(new)
            codes = pc.fill_null(found, -1).to_numpy().copy()
            codes[codes < 0] = len(self.texts) + np.arange(len(new))
            self.texts = pa.concat_arrays([self.texts, new])
            self.values = np.concatenate([self.values, values])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        else:
            codes = found.to_numpy()
        return codes[coded.indices.to_numpy()]

    def gather(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, one after the other, and how many each text has."""
        starts = self.starts[codes]
        lengths = self.starts[codes + 1] - starts
        return self.values[ragged(starts, lengths)], lengths


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, stop) of slices of about ``size`` bytes; a longer text is in a slice of its own or the last of one."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, before = 0, 0
    while start < len(ends):
        stop = min(int(np.searchsorted(ends, before + size)) + 1, len(ends))
        yield start, stop
        start, before = stop, ends[stop - 1]


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and how many each list has."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum())), lengths


def encode_alone(chunks: list[str], alone: Callable[[list[str]], list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the chunks and how many each has, some chunks at a time: a library's results take much memory."""
    found = [flat([]), *(flat(alone(chunks[i : i + JOINED])) for i in range(0, len(chunks), JOINED))]
    values, lengths = zip(*found)
    return np.concatenate(values), np.concatenate(lengths)


def encode_joined(
    chunks: list[str],
    together: Callable[[list[str]], list[int]],
    alone: Callable[[list[str]], list[list[int]]],
    borders: Callable[[np.ndarray], np.ndarray],
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the chunks and how many each has, from texts of many joined chunks. ``borders`` gives the first places of the
    chunks in the ids of a text, or another number of places where it can't tell; such chunks are encoded alone."""
    found = [flat([])]
    for start in range(0, len(chunks), JOINED):
        part = chunks[start : start + JOINED]
        ids = np.array(together(part), np.int32)
        places = borders(ids)
        found.append((ids, np.diff([*places, len(ids)])) if len(places) == len(part) else flat(alone(part)))
    values, lengths = zip(*found)
    return np.concatenate(values), np.concatenate(lengths)


def interleave(
    first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray], is_second: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and lengths of chunks that were encoded in two lists, in the order given by ``is_second``."""
    values, lengths = (np.concatenate(x) for x in zip(first, second))
    order = np.empty(len(is_second), np.int64)
    order[~is_second] = np.arange(len(first[1]))
    order[is_second] = len(first[1]) + np.arange(len(second[1]))
    starts = np.cumsum(lengths) - lengths
    return values[ragged(starts[order], lengths[order])], lengths[order]
