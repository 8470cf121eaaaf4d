"""Token ids in binary files: frequency-ranked ids, byte-aligned variable-length codes, separate control bytes."""

from __future__ import annotations

import string
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from melodex.llm.chunks import TextTable, encode_alone, encode_joined, interleave, slices
from melodex.llm.common import ship, total_before
from melodex.session import discard, materialise

ship(__name__)

BLOCK_IDS = 1_000_000  # ids of a block, unless one document has more
FILE_BLOCKS = 4
# chunks and parts of a task's tables, and bytes of text encoded at a time: several tasks share an executor's memory
KEPT_CHUNKS = 1_000_000
KEPT_BYTES = 32_000_000
ENCODED_BYTES = 4_000_000
MAGIC = b"TOKBLK1\n"
HEADER = "<8sIIIQQ"  # magic, shard, block of the shard, documents, ids, bytes of the codes
# ASCII punctuation that ends words; letters before it are a token run of their own
ENDINGS = ".,;:!?*$%&#"
LATIN_END = "ɐ"

# lengths of the four codes of a control byte
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes (two bits per value: its bytes less one) and the values' bytes, little end first."""
    values = values.astype(np.uint32)
    more = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    padded[: len(values)] = more
    control = padded[0::4] | padded[1::4] << 2 | padded[2::4] << 4 | padded[3::4] << 6
    ends = np.cumsum(more, dtype=np.int64) + np.arange(1, len(values) + 1)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    places = ends - more - 1
    data[places] = values.astype(np.uint8)
    for byte in range(1, int(more.max(initial=0)) + 1):
        longer = np.flatnonzero(more >= byte)
        data[places[longer] + byte] = values[longer] >> np.uint32(8 * byte)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values of ``pack``: lengths are looked up by control byte, then all codes are read at once."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    places = np.cumsum(lengths, dtype=np.int64) - lengths
    codes = np.frombuffer(data, np.uint8)
    values = codes[places].astype(np.uint32)
    for byte in range(1, int(lengths.max(initial=0))):
        longer = np.flatnonzero(lengths > byte)
        values[longer] |= codes[places[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values


def pack_block(shard: int, number: int, keys: list[int | None], lengths: list[int], ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    missing = np.packbits([key is None for key in keys]).tobytes()
    ids = np.array([key or 0 for key in keys], "<i8").tobytes()
    header = struct.pack(HEADER, MAGIC, shard, number, len(keys), len(ranks), len(data))
    return b"".join([header, missing, ids, np.array(lengths, "<u4").tobytes(), control, data])


def unpack_blocks(content: bytes) -> Iterator[tuple[int, int, list[int | None], np.ndarray, np.ndarray]]:
    """(shard, block, document ids, lengths, ranks) of each block of a file; a line feed ends a block."""
    at = 0
    while at < len(content):
        magic, shard, number, documents, count, size = struct.unpack_from(HEADER, content, at)
        if magic != MAGIC:
            raise ValueError("not a file of token blocks")
        at += struct.calcsize(HEADER)

        def take(length: int) -> bytes:
            nonlocal at
            at += length
            return content[at - length : at]

        missing = np.unpackbits(np.frombuffer(take(-(-documents // 8)), np.uint8), count=documents)
        keys = [None if gone else key for key, gone in zip(np.frombuffer(take(8 * documents), "<i8").tolist(), missing)]
        lengths = np.frombuffer(take(4 * documents), "<u4")
        control = take(-(-count // 4))
        yield shard, number, keys, lengths, unpack(control, take(size), count)
        at += 1


def latin(word: str) -> bool:
    """Whether the word is of letters and ends with one of the first Latin blocks, in lower case, too."""
    return word.isalpha() and word[-1] < LATIN_END and word[-1].lower().isalpha()


def _word_and_ending(chunk: str) -> tuple[str, str]:
    """Letters, and the punctuation after them; all of a chunk that isn't so, and nothing."""
    word = chunk.rstrip(ENDINGS)
    if not word.isalpha():
        return chunk, ""
    if word.isascii():
        return word.lower(), chunk[len(word) :]
    return (word, chunk[len(word) :]) if latin(word) else (chunk, "")


class WordTokens:
    """Ids of texts by a tokenizer that drops white space and whose tokens never cross it."""

    def __init__(self, tokenizer_json: str):
        self.library = Tokenizer.from_str(tokenizer_json)
        vocabulary = self.library.get_vocab()
        self.last_of_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last_of_word[[place for token, place in vocabulary.items() if token.endswith("</w>")]] = True
        whole, first, second = self._alone(["a b.", "a", "b."])
        if whole != first + second:
            raise ValueError("tokens of this tokenizer cross white space: words can't be encoded one by one")
        self.parts = TextTable(self._encode_parts, KEPT_CHUNKS, KEPT_BYTES)
        self.table = TextTable(self._encode_chunks, KEPT_CHUNKS, KEPT_BYTES)

    def _alone(self, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _first_places(self, ids: np.ndarray) -> np.ndarray:
        ends = np.flatnonzero(self.last_of_word[ids])
        return np.concatenate([[0], ends[:-1] + 1]) if len(ends) and ends[-1] == len(ids) - 1 else ends[:0]

    def _encode_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A word of letters is one run of tokens, the last of which is marked: such words are encoded joined."""

        def together(words: list[str]) -> list[int]:
            return self._alone([" ".join(words)])[0]

        parts = parts.to_pylist()
        other = np.array([not part.isalpha() for part in parts], bool)
        words = [part for part, is_other in zip(parts, other) if not is_other]
        others = [part for part, is_other in zip(parts, other) if is_other]
        joined = encode_joined(words, together, self._alone, self._first_places)
        return interleave(joined, encode_alone(others, self._alone), other)

    def _encode_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Letters and the punctuation after them are parts of their own; all other chunks are one part."""
        words = pc.utf8_rtrim(chunks, characters=ENDINGS)
        plain = pc.ascii_is_alpha(words)  # of ASCII letters
        first = pc.if_else(plain, pc.ascii_lower(words), chunks)
        second = pc.if_else(plain, pc.ascii_ltrim(chunks, characters=string.ascii_letters), "")
        odd = pc.invert(pc.string_is_ascii(chunks))
        if pc.any(odd).as_py():
            pairs = [_word_and_ending(chunk) for chunk in chunks.filter(odd).to_pylist()]
            first, second = (pc.replace_with_mask(x, odd, pa.array(y)) for x, y in zip((first, second), zip(*pairs)))
        ends = pc.not_equal(second, "")
        counts = 1 + ends.to_numpy(zero_copy_only=False)
        starts = np.cumsum(counts) - counts
        self.parts.make_room()
        found = self.parts.codes(pa.concat_arrays([first, second.filter(ends)]))
        codes = np.empty(len(found), np.int64)
        codes[starts] = found[: len(chunks)]
        codes[starts[counts > 1] + 1] = found[len(chunks) :]
        ids, lengths = self.parts.gather(codes)
        return ids, np.add.reduceat(lengths, starts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has; a null text is empty."""
        self.table.make_room()
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))  # no token reaches across the six ASCII blanks
        ids, lengths = self.table.gather(self.table.codes(words.flatten().cast(pa.string())))
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, np.diff(ends[np.cumsum([0, *words.value_lengths().to_numpy()])])


def _binaries(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Runs of numbers as a column of bytes."""
    offsets = (np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]) * ids.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.tobytes())]
    )


def _token_batches(sent, end_id: int, kind: str):
    """Ids of each document as numbers of ``kind`` (of 16 bits where the vocabulary allows); at the end of a task a row
    with how often each id stands in it."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(sent.value)
        names = ["id", "ids", "counts"]
        total = np.zeros(0, np.int64)
        for batch in batches:
            for start, stop in slices(batch.column(1), ENCODED_BYTES):
                ids, lengths = tokens.encode(batch.column(1).slice(start, stop - start))
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                rows = [batch.column(0).slice(start, stop - start), _binaries(ids.astype(kind), lengths + 1)]
                yield pa.RecordBatch.from_arrays([*rows, pa.nulls(stop - start, pa.binary())], names=names)
                counts = np.bincount(ids, minlength=len(total))
                counts[: len(total)] += total
                total = counts
        if len(total):
            nulls = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
            yield pa.RecordBatch.from_arrays([*nulls, pa.array([total.astype("<i8").tobytes()], pa.binary())], names=names)

    return per_batch


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for counts in batch.column(0).to_pylist():
            found = np.frombuffer(counts, "<i8")
            total = np.concatenate([total, np.zeros(max(0, len(found) - len(total)), np.int64)])
            total[: len(found)] += found
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["token", "times"])


def _block_batches(by_frequency: list[int], block_ids: int, kind: str):
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.zeros(max(by_frequency, default=0) + 1, np.uint32)
        rank[by_frequency] = np.arange(len(by_frequency))
        shard, number = TaskContext.get().partitionId(), 0
        keys, parts, held = [], [], 0

        def block() -> pa.RecordBatch:
            found = pack_block(shard, number, keys, [len(p) for p in parts], rank[np.concatenate(parts)])
            return pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], names=["block"])

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(ids.as_py(), kind)
                if keys and held + len(ids) > block_ids:
                    yield block()
                    number += 1
                    keys, parts, held = [], [], 0
                keys.append(key)
                parts.append(ids)
                held += len(ids)
        if keys:
            yield block()

    return per_batch


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_json: str,
    end_id: int,
    *,
    id_column: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode every text, append ``end_id`` to each, and write the ids to binary files in ascending order of document.

    ``path/ranks`` holds the ids from the most to the least frequent (ties: smaller id), ``path/blocks`` the
    documents. A block: header, a bit per document whose id is null, document ids (64 bits), lengths (32 bits), control bytes
    (two bits per token), then each token's rank in one to four bytes. A line feed ends each block. Blocks name
    their shard and place in it, which give the order; a file has up to ``FILE_BLOCKS`` blocks. Spark commits the
    files of a task together, so a lost executor leaves no half file.

    The id column must hold integers. A null text is empty and has the end id alone; a null document id comes before all
    others; rows that share an id are all written, next to each other, in the order of their ids' hash.
    """
    if not isinstance(docs.schema[id_column].dataType, T.IntegralType):
        raise ValueError("document ids must be integers")
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(tokenizer_json)
    slim = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    vocabulary = Tokenizer.from_str(tokenizer_json).get_vocab().values()
    kind = "<u2" if max(end_id, *vocabulary) < 1 << 16 else "<u4"
    tokens = slim.mapInArrow(_token_batches(sent, end_id, kind), "id long, ids binary, counts binary")
    # the place makes equal rows different, so that many rows of one id can be divided, too
    tokens = materialise(tokens.withColumn("place", F.monotonically_increasing_id()), "token-ids", compression="zstd")
    counts = tokens.select("counts").filter("counts is not null").mapInArrow(_count_batches, "token long, times long")
    counts = counts.groupBy("token").agg(F.sum("times").alias("times"))
    by_frequency = [row["token"] for row in counts.orderBy(F.desc("times"), "token").collect()]  # the vocabulary at most
    order = ["id", F.crc32("ids"), F.xxhash64("place")]
    sorted_ids = tokens.filter("ids is not null").repartitionByRange(*order).sortWithinPartitions(*order).select("id", "ids")
    blocks = sorted_ids.mapInArrow(_block_batches(by_frequency, block_ids, kind), "block binary")
    _write_bytes(blocks, f"{path}/blocks", FILE_BLOCKS)
    ranks = np.array(by_frequency, "<u4").tobytes()
    _write_bytes(spark.createDataFrame([(bytearray(ranks),)], "block binary"), f"{path}/ranks", 1)
    discard(tokens)


def _write_bytes(blocks: DataFrame, path: str, per_file: int) -> None:
    """The text writer puts the bytes of a string out as they are, with a line feed after each row."""
    lines = blocks.select(F.col("block").cast("string").alias("value"))
    lines.write.option("maxRecordsPerFile", per_file).option("compression", "none").text(path)


def _read_batches(by_frequency: np.ndarray):
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for shard, number, keys, lengths, ranks in unpack_blocks(content.as_py()):
                    ids = by_frequency[ranks]
                    ends = np.cumsum(lengths, dtype=np.int64)
                    lists = _binaries(ids, lengths)
                    alike = [pa.array(np.full(len(keys), x, np.int32)) for x in (shard, number)]
                    before = pa.array(ends - lengths)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), *alike, before, lists], names=["id", "shard", "block", "before", "ids"]
                    )

    return per_batch


def _headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            rows, at, data = [], 0, content.as_py()
            while at < len(data):
                _, shard, number, documents, count, size = struct.unpack_from(HEADER, data, at)
                rows.append((shard, number, count))
                at += struct.calcsize(HEADER) + -(-documents // 8) + 12 * documents + -(-count // 4) + size + 1
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "block", "tokens"])


def read_token_files(spark: SparkSession, path: str, id_name: str = "doc_id") -> DataFrame:
    """One row per document of ``write_token_files``: id, ``start`` (ids of all documents before it) and ``ids``
    (binary: little-endian unsigned 32-bit numbers, as numpy reads them)."""
    files = spark.read.format("binaryFile")
    # one file of a vocabulary's size
    ranks = b"".join(bytes(row[0])[:-1] for row in files.load(f"{path}/ranks").select("content").collect() if row[0])
    by_frequency = np.frombuffer(ranks, "<u4")
    content = files.load(f"{path}/blocks").select("content")
    schema = "id long, shard int, block int, before long, ids binary"
    rows = content.mapInArrow(_read_batches(by_frequency), schema)
    blocks = materialise(content.mapInArrow(_headers, "shard int, block int, tokens long"), "token-blocks")
    firsts = total_before(blocks, [], "shard", ["block"], F.col("tokens"), "first")
    firsts = firsts.select(F.col("shard").alias("__shard"), F.col("block").alias("__block"), "first")
    same = (F.col("shard") == F.col("__shard")) & (F.col("block") == F.col("__block"))
    return rows.join(firsts, same).select(F.col("id").alias(id_name), (F.col("first") + F.col("before")).alias("start"), "ids")


def token_count(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
