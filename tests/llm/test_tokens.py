"""Token files and alignments against the libraries and a plain version, on awkward texts and rows."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from melodex.llm.alignment import TokenizerPair, aligned_groups, alignment_figures
from melodex.llm.queries import BYTE_TOKENIZER, WORD_TOKENIZER, op11_token_files, op12_token_alignment, piece_model, tokenizer_file
from melodex.llm import token_files
from melodex.llm.token_files import WordTokens, pack, read_token_files, unpack, write_token_files

SCHEMA = "doc_id long, text string"
PARTS = [" ", "  ", "\n", "\t", "ab", "The", " word", "é", "世", "\U0001f600", "<|endoftext|>", "<s>", "12", "'s", ".", "."]
PARTS += ["▁", "\x1c", " ", "　", "İ", "́", "\r\n", "ſ", "ß"]


def mixtures(count, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 25))) for _ in range(count)]


def awkward(spark):
    rows = [(7, None), (3, ""), (3, "the same"), (3, "the same"), (None, "no id"), (5, "long " * 40_000), (-2, " \n"), (9, "x" * 70_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "ids", "place", "block", "start", "pair", "count", "n_a", "shard"):
        df = df.withColumn(name, F.lit("clash"))
    return df


# token files

WORDS = WordTokens(tokenizer_file(WORD_TOKENIZER))
LIBRARY = Tokenizer.from_file(WORD_TOKENIZER)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.text(max_size=60) | st.lists(st.sampled_from(PARTS), max_size=20).map("".join), max_size=6))
@settings(max_examples=200, deadline=None)
def test_word_tokens_equal_the_library(texts):
    ids, lengths = WORDS.encode(pa.array([*texts, None], pa.string()))
    assert ids.tolist() == [i for text in texts for i in library_ids(text)]
    assert lengths.tolist() == [*(len(library_ids(text)) for text in texts), 0]


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
def test_codes_are_read_back(values):
    control, data = pack(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4) and len(data) == sum(max(1, -(-v.bit_length() // 8)) for v in values)
    assert unpack(control, data, len(values)).tolist() == values


def test_token_files_are_read_back(spark, tmp_path):
    texts = mixtures(400)
    docs = spark.createDataFrame([(1000 - 3 * i, t) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    path = f"{tmp_path}/files"
    write_token_files(docs, path, tokenizer_file(WORD_TOKENIZER), 1, block_ids=100)
    assert spark.read.format("binaryFile").load(f"{path}/blocks").count() > 10
    rows = sorted(read_token_files(spark, path).collect())
    start = 0
    for row, (doc_id, text) in zip(rows, sorted((1000 - 3 * i, t) for i, t in enumerate(texts)), strict=True):
        ids = np.array([*library_ids(text), 1], "<u4")
        assert (row.doc_id, row.start, bytes(row.ids)) == (doc_id, start, ids.tobytes())
        start += len(ids)
    ranks = b"".join(bytes(r.content)[:-1] for r in spark.read.format("binaryFile").load(f"{path}/ranks").collect())
    counts = Counter(np.frombuffer(b"".join(bytes(r.ids) for r in rows), "<u4").tolist())
    assert np.frombuffer(ranks, "<u4").tolist() == sorted(counts, key=lambda i: (-counts[i], i))


def test_ids_are_counted_once_per_task(monkeypatch):
    """However small the slices are, a task counts its ids in one row, and its tables hold a bounded number of chunks."""
    monkeypatch.setattr(token_files, "ENCODED_BYTES", 10)
    monkeypatch.setattr(token_files, "KEPT_CHUNKS", 3)
    texts = [None, "", *mixtures(60), "the end"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])

    class Sent:
        value = tokenizer_file(WORD_TOKENIZER)

    found = pa.Table.from_batches(token_files._token_batches(Sent, 1, "<u2")(iter([batch, batch])))
    ids = np.concatenate([np.frombuffer(x, "<u2") for x in found["ids"].drop_null().to_pylist()])
    counts = found["counts"].drop_null().to_pylist()
    assert len(counts) == 1
    assert np.frombuffer(counts[0], "<i8").tolist() == np.bincount(ids).tolist()
    library = Tokenizer.from_str(Sent.value)
    expected = [[*library.encode(text or "", add_special_tokens=False).ids, 1] for text in texts]
    assert ids.tolist() == 2 * [token for each in expected for token in each]


def test_a_word_is_encoded_once_per_task():
    """A task's tables have room for the different words of large inputs; a full table is emptied."""
    tokens = WordTokens(tokenizer_file(WORD_TOKENIZER))
    letters = str.maketrans("0123456789", "abcdefghij")
    words = [str(i).translate(letters) for i in range(100_000, 350_000)]
    texts, sent, encode = pa.array([" ".join(words[i : i + 50_000]) for i in range(0, 250_000, 50_000)]), [], tokens.parts.encode

    def counted(parts):
        sent.append(len(parts))
        return encode(parts)

    tokens.parts.encode = counted
    first, again = ([tokens.encode(texts.slice(i, 1)) for i in range(len(texts))] for _ in range(2))
    assert sum(sent) == len(words)
    assert all((a == b).all() for pair in zip(first, again) for a, b in zip(*pair))
    assert first[0][0].tolist() == library_ids(texts[0].as_py())
    tokens.table.most_bytes = 1000
    assert tokens.encode(pa.array(["word, Word***"]))[0].tolist() == library_ids("word, Word***")
    assert len(tokens.table.texts) == 2


def test_token_files_of_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    write_token_files(docs, f"{tmp_path}/a", tokenizer_file(WORD_TOKENIZER), 1)
    rows = sorted(read_token_files(spark, f"{tmp_path}/a").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, -2, 3, 3, 3, 5, 7, 9]
    assert sorted(len(r.ids) // 4 for r in rows if r.doc_id == 3) == [1, 3, 3]
    assert len(rows[-2].ids) == len(rows[1].ids) == 4 and len(rows[5].ids) == 4 * 40_001
    assert [r.start for r in rows] == np.cumsum([0, *(len(r.ids) // 4 for r in rows)])[:-1].tolist()
    write_token_files(spark.createDataFrame([], SCHEMA), f"{tmp_path}/e", tokenizer_file(WORD_TOKENIZER), 1)
    assert read_token_files(spark, f"{tmp_path}/e").collect() == []
    with pytest.raises(ValueError):
        write_token_files(docs, f"{tmp_path}/s", "", 1, id_column="text")


def test_token_query(spark, tmp_path):
    spark.createDataFrame([(2, "some words"), (1, None)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op11_token_files(spark, str(tmp_path)).collect()}
    ids = np.array([*library_ids("some words"), 1], "<u4")
    assert (rows[1].start, rows[1].n_tokens) == (0, 1)
    assert (rows[2].start, rows[2].n_tokens, rows[2].ids_crc32) == (1, len(ids), zlib.crc32(ids.tobytes()))


# alignment

PAIR = TokenizerPair(tokenizer_file(BYTE_TOKENIZER), piece_model())


def plain_alignment(docs):
    """(n_a, n_b, links, groups) of each document, from the offsets of both tokenizers over the whole text."""
    out = []
    for _, text in docs:
        whole = (" " + (text or "")).encode()
        a = PAIR.a.encode(whole.decode(), add_special_tokens=False).ids
        b = PAIR.b.encode(text or "")
        if not text or any(b"".join(table[i] for i in ids) != whole for table, ids in ((PAIR.a_bytes, a), (PAIR.b_bytes, b))):
            a, b = [], []
        a_ends = np.cumsum([len(PAIR.a_bytes[i]) for i in a]).tolist()
        b_ends = np.cumsum([len(PAIR.b_bytes[i]) for i in b]).tolist()
        a_at, b_at = ({end: k + 1 for k, end in enumerate(ends)} for ends in (a_ends, b_ends))
        groups, links, i, j = [], [], 0, 0
        for end in sorted(a_at.keys() & b_at.keys()):
            to, upto = a_at[end], b_at[end]
            groups.append(",".join(map(str, a[i:to])) + "|" + ",".join(map(str, b[j:upto])))
            links.append((a[to - 1], b[upto - 1]))
            i, j = to, upto
        out.append((len(a), len(b), links, ";".join(groups)))
    return out


def plain_figures(docs):
    aligned = plain_alignment(docs)
    counts = Counter(link for _, _, links, _ in aligned for link in links)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    for (doc_id, _), (n_a, n_b, links, groups) in zip(docs, aligned):
        best = sum(counts[link] == highest[link[1]] for link in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if links else ""
        yield doc_id, n_a, n_b, len(links), len(links), best, sum(counts[link] for link in links), digest


def test_alignment_equals_the_plain_version(spark, tmp_path):
    docs = list(enumerate(mixtures(1500) + ["the word and the words, again"] * 40 + ["a▁b", "", "café now"]))
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in alignment_figures(df, tokenizer_file(BYTE_TOKENIZER), piece_model()).collect())
    assert got == list(plain_figures(docs))
    groups = dict(r[::3] for r in aligned_groups(df, tokenizer_file(BYTE_TOKENIZER), piece_model()).collect())
    assert [groups[i] for i, _ in docs] == [text for *_, text in plain_alignment(docs)]
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in op12_token_alignment(spark, str(tmp_path)).collect()) == got


def test_alignment_of_awkward_rows(spark):
    docs = awkward(spark)
    got = alignment_figures(docs, tokenizer_file(BYTE_TOKENIZER), piece_model()).collect()
    expected = list(plain_figures([(r.doc_id, r.text) for r in docs.collect()]))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert alignment_figures(empty, tokenizer_file(BYTE_TOKENIZER), piece_model()).collect() == []
