"""Language of texts: known words first, shorter and shorter character n-grams for the others."""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from melodex.llm.chunks import TextTable, ragged, slices
from melodex.llm.common import as_list, ship
from melodex.llm.token_files import pack, unpack
from melodex.session import materialise

ship(__name__)

# more languages than this are refused: a table of their totals is sent to all tasks
LANGUAGES = 10_000
LONGEST_GRAM = 5
UNKNOWN = "und"
# distinct words of a block of documents, after the slice that reaches it the next block begins
BLOCK_WORDS = 400_000
# bytes of text taken apart at a time, unless one text has more
SLICE_BYTES = 4_000_000
# distinct chunks and words of a task's tables, and their bytes; counts and scores gathered before they are handed on
KEPT_TEXTS = 1_000_000
KEPT_BYTES = 32_000_000
GATHERED = 1_000_000
# words of documents that are scored together
SCORED = 500_000
# words whose n-grams are counted together
GRAM_WORDS = 40_000
# bytes of the texts of a block at most, unless one text has more
BLOCK_BYTES = 32_000_000

# runs of word characters without decimal digits and underscores; what is no letter among them is cut off later
WORD = re.compile(r"[^\W\d_]+")


class LanguageModel(NamedTuple):
    languages: list[str]
    defaults: np.ndarray  # log frequency of what a language lacks: a row per length (0: words), a column per language
    counts: DataFrame  # (length, entry, places, times): languages and counts of every word and n-gram, stored


def letter_words(run: str) -> list[str]:
    """The words of letters alone in a run of word characters."""
    return [run] if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split()


def word_grams(word: str, length: int) -> list[str]:
    marked = f" {word} "
    return [marked[i : i + length] for i in range(len(marked) - length + 1)]


class WordTable:
    """Words of texts as codes, their places in ``words.texts``. A chunk between ASCII blanks is taken apart once; no word and
    no lower-casing depends on what stands across such a blank."""

    def __init__(self):
        self.words = TextTable(lambda new: (np.zeros(0, np.int32), np.zeros(len(new), np.int64)), KEPT_TEXTS, KEPT_BYTES)
        self.chunks = TextTable(self._take_apart, KEPT_TEXTS, KEPT_BYTES)

    def full(self) -> bool:
        return any(len(t.texts) >= KEPT_TEXTS or t.texts.nbytes >= KEPT_BYTES for t in (self.words, self.chunks))

    def _take_apart(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = pc.utf8_trim(chunks, characters=string.punctuation)
        plain = pc.ascii_is_alpha(words)  # one word of ASCII letters
        found = [
            [word for run in WORD.findall(chunk.lower()) for word in letter_words(run)]
            for chunk in chunks.filter(pc.invert(plain)).to_pylist()
        ]
        is_plain = plain.to_numpy(zero_copy_only=False)
        counts = np.ones(len(chunks), np.int64)
        counts[~is_plain] = [len(x) for x in found]
        starts = np.cumsum(counts) - counts
        others = pa.array([word for x in found for word in x], pa.string())
        codes = self.words.codes(pa.concat_arrays([pc.ascii_lower(words.filter(plain)), others]))
        placed = np.empty(len(codes), np.int32)
        placed[starts[is_plain]] = codes[: len(codes) - len(others)]
        placed[ragged(starts[~is_plain], counts[~is_plain])] = codes[len(codes) - len(others) :]
        return placed, counts

    def codes(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words of the texts, and how many each text has; a null text has none."""
        chunks = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        codes, lengths = self.chunks.gather(self.chunks.codes(chunks.flatten().cast(pa.string())))
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return codes, np.diff(ends[np.cumsum([0, *chunks.value_lengths().to_numpy()])])


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in ascending order, the sums of their times, and a place of each."""
    order = np.argsort(keys)
    keys = keys[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[: len(keys)]
    return keys[firsts], np.add.reduceat(times[order], firsts) if len(keys) else times, order[firsts]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, times): a task's counts, handed on whenever a good number is gathered."""
    table, languages, held, size = WordTable(), {}, [], 0

    def gathered() -> Iterator[pa.RecordBatch]:
        keys, times, _ = _summed(*(np.concatenate(x) for x in zip(*held)))
        names = pa.array(list(languages), pa.string())
        columns = [names.take(pa.array(keys >> 32)), table.words.texts.take(pa.array(keys & 0xFFFFFFFF)), pa.array(times)]
        rows = pa.RecordBatch.from_arrays(columns, names=["lang", "entry", "times"])
        for start in range(0, rows.num_rows, 100_000):
            yield rows.slice(start, 100_000)

    for batch in batches:
        of_row = np.array([languages.setdefault(x, len(languages)) for x in batch.column(0).to_pylist()], np.int64)
        for start, stop in slices(batch.column(1), SLICE_BYTES):
            codes, lengths = table.codes(batch.column(1).slice(start, stop - start))
            keys, times = np.unique(np.repeat(of_row[start:stop], lengths) << 32 | codes, return_counts=True)
            held.append((keys, times))
            size += len(keys)
            if size >= 2 * GATHERED or table.full():
                yield from gathered()
                table, held, size = WordTable(), [], 0
    if held:
        yield from gathered()


def _grams_one_by_one(language: list, words: list, times: list) -> Iterator[tuple[list, list, list, int]]:
    found: dict[tuple, int] = Counter()
    for name, word, n in zip(language, words, times):
        for length in range(1, LONGEST_GRAM + 1):
            for gram in word_grams(word, length):
                found[length, name, gram] += n
    for length in range(1, LONGEST_GRAM + 1):
        keys = [key for key in found if key[0] == length]
        yield [key[1] for key in keys], [key[2] for key in keys], [found[key] for key in keys], length


def _grams_together(language: list, words: list, times: list) -> Iterator[tuple[list, list, np.ndarray, int]]:
    """Like ``_grams_one_by_one``: n-grams are numbers in the base of the alphabet met."""
    names: dict[str, int] = {}
    of_word = np.array([names.setdefault(x, len(names)) for x in language], np.int64)
    points = np.frombuffer("".join(f" {word} " for word in words).encode("utf-32-le"), "<u4")
    alphabet, letters = np.unique(points, return_inverse=True)
    base = len(alphabet)
    if len(names) * base**LONGEST_GRAM >= 1 << 62:
        yield from _grams_one_by_one(language, words, times)
        return
    lengths = np.array([len(word) + 2 for word in words], np.int64)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))  # code points from here to the word's end
    of_point, times_of_point = np.repeat(of_word, lengths), np.repeat(np.array(times, np.int64), lengths)
    keys, listed = np.zeros(len(points), np.int64), list(names)
    for length in range(1, LONGEST_GRAM + 1):
        at = np.flatnonzero(left >= length)
        keys = keys[: len(points) - length + 1] * base + letters[length - 1 :]
        distinct, sums, places = _summed(of_point[at] * base**length + keys[at], times_of_point[at])
        grams = points[at[places][:, None] + np.arange(length)].astype("<u4").view(f"<U{length}").reshape(-1)
        yield [listed[k] for k in (distinct // base**length).tolist()], grams.tolist(), sums, length


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, length, n-gram, times) of the words given."""

    def counted(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        for language, grams, times, length in _grams_together(*(rows.column(k).to_pylist() for k in range(3))):
            columns = [pa.array(language, pa.string()), pa.array([length] * len(grams), pa.int32())]
            columns += [pa.array(grams, pa.string()), pa.array(times, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "length", "entry", "times"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= GRAM_WORDS:
            yield from counted(held)
            held = []
    if sum(x.num_rows for x in held):
        yield from counted(held)


def fit_languages(docs: DataFrame, *, text: str = "text", language: str = "lang") -> LanguageModel:
    """Count the words and n-grams of all texts with a language, per language. All counts are kept, in a stored table.

    Null texts and null languages teach nothing.
    """
    known = docs.filter(F.col(language).isNotNull() & F.col(text).isNotNull())
    texts = known.select(F.col(language).alias("lang"), F.col(text).alias("text"))
    in_order = F.sort_array(F.collect_list(F.struct("lang", "times"))).alias("found")  # languages of one entry
    # the rows of a word meet once, for both sums
    words = texts.mapInArrow(_count_words, "lang string, entry string, times long").repartition("entry")
    words = words.groupBy("lang", "entry").agg(F.sum("times").alias("times")).groupBy("entry").agg(in_order)
    words = materialise(words, "language-words", compression="zstd")
    # n-grams are taken from the distinct words, not from the texts
    of_words = words.select("entry", F.explode("found").alias("found")).select("found.lang", "entry", "found.times")
    grams = of_words.mapInArrow(_count_grams, "lang string, length int, entry string, times long")
    grams = grams.groupBy("lang", "length", "entry").agg(F.sum("times").alias("times"))
    grams = materialise(grams.groupBy("length", "entry").agg(in_order), "language-grams", compression="zstd")
    by_entry = words.select(F.lit(0).alias("length"), "entry", "found").unionByName(grams)
    each = by_entry.select("length", F.explode("found").alias("found"))
    totals = each.groupBy("length", "found.lang").agg(F.sum("found.times").alias("times"))
    totals = totals.limit(LANGUAGES * (LONGEST_GRAM + 1) + 1).collect()
    languages = sorted({row["lang"] for row in totals})
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    kinds = {row["length"]: row["count"] for row in by_entry.groupBy("length").count().collect()}
    sums = {(row["length"], row["lang"]): row["times"] for row in totals}
    # an entry a language lacks counts as half a sighting
    defaults = [
        [math.log(0.5 / (sums.get((length, name), 0) + kinds.get(length, 0) + 1)) for name in languages]
        for length in range(LONGEST_GRAM + 1)
    ]
    shape = (LONGEST_GRAM + 1, len(languages))
    places = F.transform("found", lambda x: F.array_position(F.lit(languages), x["lang"]) - 1) if languages else F.lit([])
    table = by_entry.select(
        "length",
        "entry",
        places.cast("array<int>").alias("places"),
        F.transform("found", lambda x: x["times"]).alias("times"),
    )
    return LanguageModel(languages, np.array(defaults).reshape(shape), table)


def _word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents: their ids, the distinct words of the block, and each document's words as places among them
    with their counts."""
    block, table, held, size = TaskContext.get().partitionId() << 32, WordTable(), [], 0

    def finished(ids: pa.Array) -> pa.RecordBatch:
        words = table.words.texts
        # the most frequent words of a block get the smallest places, whose codes are short
        uses = sum(np.bincount(keys & 0xFFFFFFFF, minlength=len(words)) for keys, _ in held)
        order = np.argsort(-uses, kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        lengths = np.zeros(len(ids), np.int64)
        for i, (keys, times) in enumerate(held):  # each of documents of its own
            rows, places = keys >> 32, place[keys & 0xFFFFFFFF]
            sorting = np.argsort(rows << 32 | places)
            places = places[sorting]
            firsts = np.flatnonzero(np.diff(rows, prepend=-1))
            steps = np.diff(places, prepend=0)
            steps[firsts] = places[firsts]
            lengths += np.bincount(rows, minlength=len(ids))
            held[i] = steps.astype(np.uint32), times[sorting] - 1
        steps, times = (np.concatenate(x) for x in zip(*held))
        packed = [*pack(steps), *pack(times)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                as_list(ids),
                as_list(pa.array(lengths, pa.int64())),
                as_list(words.take(pa.array(order))),
                pa.array([packed], pa.list_(pa.binary())),
            ],
            names=["block", "ids", "lengths", "words", "uses"],
        )

    for batch in batches:
        first = 0
        for start, stop in slices(batch.column(1), SLICE_BYTES):
            texts = batch.column(1).slice(start, stop - start)
            codes, lengths = table.codes(texts)
            rows = np.repeat(np.arange(start - first, stop - first), lengths)
            keys, times = np.unique(rows << 32 | codes, return_counts=True)
            held.append((keys, times.astype(np.uint32)))
            size += pc.sum(pc.binary_length(texts)).as_py() or 0
            if len(table.words.texts) >= BLOCK_WORDS or size >= BLOCK_BYTES or stop == batch.num_rows:
                yield finished(batch.column(0).slice(first, stop - first))
                block, first, table, held, size = block + 1, stop, WordTable(), [], 0


def _score_text(length: int, pairs: Column, value: str) -> Column:
    """``length language:value language:value ...``; as text, as most words have one language and a small count."""
    parts = F.transform(pairs, lambda x: F.concat(x["places"].cast("string"), F.lit(":"), x[value].cast("string")))
    return F.concat_ws(" ", F.lit(str(length)), parts).alias("score")


def _word_scores(blocks: DataFrame, model: LanguageModel) -> DataFrame:
    """(entry, score) for each word of the blocks that is known or has known n-grams: the counts of a known word, else by how
    much the mean of its n-grams exceeds the default log frequency of their length, in the languages that have them."""
    counts = model.counts
    logs = F.transform("times", lambda n: F.log(2.0 * n + 1))  # log (n + 0.5) over log 0.5
    known = counts.filter("length = 0").select("entry", _score_text(0, F.arrays_zip("places", "times"), "times"))
    distinct = blocks.select(F.explode("words").alias("word")).distinct()
    known_words = counts.filter("length = 0").select(F.col("entry").alias("word"))
    left = materialise(distinct.join(known_words, "word", "left_anti"), "language-unseen")
    found = [known]
    for length in range(LONGEST_GRAM, 0, -1):
        marked = F.concat(F.lit(" "), F.col("word"), F.lit(" "))
        starts = F.sequence(F.lit(1), F.length("word") + (3 - length))
        grams = left.filter(F.length("word") >= length - 2).select(
            "word", F.explode(F.transform(starts, lambda i: F.substring(marked, i, F.lit(length)))).alias("gram")
        )
        table = counts.filter(F.col("length") == length).select(F.col("entry").alias("gram"), "places", logs.alias("values"))
        met = grams.join(table, "gram")
        sums = met.select("word", F.explode(F.arrays_zip("places", "values")).alias("x")).groupBy("word", "x.places")
        sums = sums.agg(F.sum("x.values").alias("value")).groupBy("word")
        sums = sums.agg(F.sort_array(F.collect_list(F.struct("places", "value"))).alias("sums"))  # languages of one word
        known_grams = met.groupBy(F.col("word").alias("__word")).agg(F.count("*").alias("grams"))
        mean = F.transform(
            "sums", lambda x: F.struct(x["places"].alias("places"), (x["value"] / F.col("grams")).alias("value"))
        )
        means = sums.join(known_grams, F.col("word") == F.col("__word")).select(
            F.col("word").alias("entry"), _score_text(length, mean, "value")
        )
        means = materialise(means, "language-means")
        found.append(means)
        left = left.join(means.select(F.col("entry").alias("word")), "word", "left_anti")
        if length > 1:
            left = materialise(left, "language-unseen")
    return reduce(DataFrame.unionByName, found)


class ScoreTable(dict):
    """The different scores met, by their text: length, and languages with what they add to the default."""

    def __init__(self):
        self.lengths: list[int] = []
        self.counts: list[int] = []
        self.languages: list[int] = []
        self.values: list[float] = []

    def __missing__(self, text: str) -> int:
        length, *parts = text.split(" ")
        for part in parts:
            language, value = part.split(":")
            self.languages.append(int(language))
            # a known word has its count
            self.values.append(math.log(2 * int(value) + 1) if length == "0" else float(value))
        self.lengths.append(int(length))
        self.counts.append(len(parts))
        code = self[text] = len(self)
        return code


def _pack_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (block, place, score), rows (block, n, scores, packed): the different scores of a part of a block, its ``n`` places
    and which score each has."""

    def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        coded = rows.column(2).combine_chunks().dictionary_encode()
        blocks, places, codes = (x.to_numpy() for x in (rows.column(0), rows.column(1), coded.indices))
        order = np.lexsort((places, blocks))
        blocks, places, codes = blocks[order], places[order], codes[order]
        ends = [*np.flatnonzero(blocks[1:] != blocks[:-1]) + 1, len(blocks)]
        for start, stop in zip([0, *ends[:-1]], ends):
            used, at = np.unique(codes[start:stop], return_inverse=True)
            parts = [*pack(np.diff(places[start:stop], prepend=0)), *pack(at)]
            columns = [pa.array(blocks[start : start + 1], pa.int64()), pa.array([stop - start], pa.int32())]
            columns += [as_list(coded.dictionary.take(pa.array(used))), pa.array([parts], pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "n", "scores", "packed"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= GATHERED:
            yield from packed(held)
            held = []
    if sum(x.num_rows for x in held):
        yield from packed(held)


def _with_scores(blocks: DataFrame, scores: DataFrame) -> DataFrame:
    """The blocks, each with ``found``: a list of rows of ``_pack_scores`` for its words that ``scores`` (entry, score) has.
    A block lists its words once, so the join has one row per block and word, and what is gathered is packed."""
    places = blocks.select("block", F.posexplode("words").alias("place", "entry"))
    met = places.join(scores.withColumnRenamed("entry", "__entry"), F.col("entry") == F.col("__entry"))
    packed = met.select("block", "place", "score").mapInArrow(
        _pack_scores, "block long, n int, scores array<string>, packed array<binary>"
    )
    found = packed.groupBy(F.col("block").alias("__block")).agg(
        F.collect_list(F.struct("n", "scores", "packed")).alias("found")  # a few rows for each task that met the block
    )
    return blocks.join(found, F.col("block") == F.col("__block"), "left").drop("__block", "words")


def _score_blocks(languages: list[str], defaults: np.ndarray):
    def score(row: tuple) -> tuple[list[str], np.ndarray]:
        lengths, (controls, data, time_controls, time_data), found = row
        total, documents = int(lengths.sum()), len(lengths)
        all_steps, all_times = unpack(controls, data, total), unpack(time_controls, time_data, total)
        words = np.zeros(documents)
        scores = np.zeros((documents, len(languages)))
        table, entries = ScoreTable(), []
        if found is not None:
            for n, texts, (controls, data, which, which_data) in zip(*(found.field(k).to_pylist() for k in range(3))):
                codes = np.fromiter(map(table.__getitem__, texts), np.int64, len(texts))
                entries.append((np.cumsum(unpack(controls, data, n).astype(np.int64)), codes[unpack(which, which_data, n)]))
        where = np.full(1 + max((int(places[-1]) for places, _ in entries), default=-1), -1)
        for places, codes in entries:
            where[places] = codes
        known_lengths, counts = np.array(table.lengths, np.int64), np.array(table.counts, np.int64)
        firsts, known_languages, values = np.cumsum(counts) - counts, np.array(table.languages, np.int64), np.array(table.values)
        ends = np.cumsum(lengths)
        start = 0
        while start < documents:
            before = int(ends[start] - lengths[start])
            stop = max(start + 1, int(np.searchsorted(ends, before + SCORED, "right")))
            part, length = slice(before, int(ends[stop - 1])), lengths[start:stop]
            steps, times = np.cumsum(all_steps[part], dtype=np.int64), all_times[part].astype(np.int64) + 1
            places = steps - np.repeat(np.concatenate([[0], steps])[np.cumsum(length) - length], length)
            document = np.repeat(np.arange(stop - start), length)
            words[start:stop] = np.bincount(document, times, stop - start)
            at = np.where(places < len(where), where[np.minimum(places, len(where) - 1)], -1) if len(where) else places * 0 - 1
            document, times, at = document[at >= 0], times[at >= 0], at[at >= 0]
            if len(at):
                kinds = np.bincount(document * len(defaults) + known_lengths[at], times, (stop - start) * len(defaults))
                scores[start:stop] += kinds.reshape(stop - start, -1) @ defaults
                index = ragged(firsts[at], counts[at])
                cell = np.repeat(document, counts[at]) * len(languages) + known_languages[index]
                weights = values[index] * np.repeat(times, counts[at])
                scores[start:stop] += np.bincount(cell, weights, (stop - start) * len(languages)).reshape(stop - start, -1)
            start = stop
        if not len(languages):
            return [UNKNOWN] * documents, np.zeros(documents)
        best = scores.argmax(1)  # of equal scores the first in code point order
        # share of the best language if a text's evidence grows with the root of its words
        with np.errstate(invalid="ignore", divide="ignore"):
            odds = np.exp((scores - scores.max(1, keepdims=True)) / np.sqrt(words)[:, None])
        share = np.where(words > 0, 1 / np.where(words > 0, odds.sum(1), 1), 0.0)
        return [languages[k] if n else UNKNOWN for k, n in zip(best.tolist(), words)], share

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, lengths, uses, found = (batch.column(k)[row] for k in range(4))
                names, share = score((lengths.values.to_numpy(), uses.as_py(), found.values))
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(names, pa.string()), pa.array(share)], names=["id", "lang_pred", "score"]
                )

    return per_batch


def identify_languages(
    docs: DataFrame, model: LanguageModel, *, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: id, ``lang_pred`` and ``score``, the share of the best language.

    Only the text is used, all of it, in lower case. A known word adds its log frequency per language; another
    word adds the mean over its n-grams of the greatest length of which any is known, from five characters down
    to one; a word of which nothing is known adds nothing. A null text and one without letters are ``und`` with score 0.

    Documents are stored as blocks with their distinct words; these are joined with all counts of the model, so no
    part of the model is sent to all tasks but the totals of the languages.
    """
    id_type = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.ArrayType(id_type)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("words", T.ArrayType(T.StringType())),
            T.StructField("uses", T.ArrayType(T.BinaryType())),
        ]
    )
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    blocks = materialise(slim.mapInArrow(_word_blocks, schema), "language-blocks", compression="zstd")
    looked_up = _with_scores(blocks, _word_scores(blocks, model))
    rows = looked_up.select("ids", "lengths", "uses", "found").mapInArrow(
        _score_blocks(model.languages, model.defaults),
        T.StructType(
            [
                T.StructField("id", id_type),
                T.StructField("lang_pred", T.StringType()),
                T.StructField("score", T.DoubleType()),
            ]
        ),
    )
    return rows.withColumnRenamed("id", id_column)
