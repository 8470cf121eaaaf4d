"""Grouping words that differ by one letter."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from melodex.llm.common import ship
from melodex.session import materialise

ship(__name__)

# runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8, after A-Z are lowered
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
SYMBOLS = 8  # of the reduced alphabet
FACTOR = 0x9E3779B97F4A7C15  # odd: keys are polynomials in it, modulo 2 ** 64
# words of one reduced form that are compared through it; words of a more crowded form are compared letter by letter
CROWD = 64
TABLE_WORDS = 500_000  # words a task counts before it hands them on
CELLS = 2_000_000  # keys made at a time
# letter by code point: its symbol in the reduced alphabet, and its own number
REDUCED = np.zeros(256, np.uint64)
EXACT = np.zeros(256, np.uint64)
for _place, _letter in enumerate(LETTERS):
    REDUCED[ord(_letter)] = zlib.crc32(_letter.encode()) % SYMBOLS
    EXACT[ord(_letter)] = _place


def damaged(run: bytes, seed: int, damage: int) -> bytes:
    """The run without one code point, if its checksum is divisible by ``damage``."""
    value = zlib.crc32(run, seed)
    if value % damage:
        return run
    word = run.decode()
    place = value % len(word)
    return (word[:place] + word[place + 1 :]).encode()


def _count_batches(least_length: int, damage: int | None):
    def counted(total: Counter) -> pa.RecordBatch:
        words = [(w, n) for w, n in ((w.decode(), n) for w, n in total.items()) if len(w) >= least_length]
        columns = [pa.array([w for w, _ in words], pa.string()), pa.array([n for _, n in words], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for i, key in enumerate(batch.column(0).to_pylist()):
                found = Counter(RUN.findall((texts[i].as_py() or b"").lower()))  # bytes: lowers A-Z only
                if damage is None:
                    total.update(found)
                else:
                    seed = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for run, n in found.items():
                        total[damaged(run, seed, damage)] += n
                if len(total) >= TABLE_WORDS:
                    yield counted(total)
                    total.clear()
        yield counted(total)

    return per_batch


def count_words(
    docs: DataFrame,
    *,
    least_length: int = 5,
    least_count: int = 3,
    damage: int | None = None,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(word, n): runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) of all whole texts, A-Z lowered.

    Words of ``least_length`` code points and ``least_count`` occurrences count. With ``damage``, misspellings are planted: a run
    loses the code point ``h % length`` where ``damage`` divides h, the checksum (CRC-32) of
    ``<id>:<run>``; a null id is written as nothing. Null and empty texts have no words.
    """
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    words = slim.mapInArrow(_count_batches(least_length, damage), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def letters_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row per word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    return points.reshape(len(words), -1)


def _powers(length: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(length, FACTOR, np.uint64))])


def keys_of(symbols: np.ndarray) -> np.ndarray:
    """A word's key: the sum of its symbols, plus one each, times powers of ``FACTOR``. Equal words have equal
    keys; what different words of one key would add is found out when the words themselves are compared."""
    return ((symbols + np.uint64(1)) * _powers(symbols.shape[1])[:-1]).sum(1, dtype=np.uint64)


def neighbour_keys(symbols: np.ndarray, size: int, *, both_ways: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, keys) of the words one edit away from each row, over an alphabet of ``size`` symbols.

    One way, a link is made from one of its ends only: an insertion is the other word's deletion, and a replacement by a
    smaller symbol is the other word's replacement by a larger one.
    """
    rows, length = symbols.shape
    power = _powers(length + 1)
    terms = (symbols + np.uint64(1)) * power[:length]
    before = np.concatenate([np.zeros((rows, 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)], axis=1)
    whole = before[:, -1:]

    def after(shift: np.ndarray) -> np.ndarray:
        """Sums of the symbols from each place on, at the powers given."""
        moved = np.cumsum(((symbols + np.uint64(1)) * shift)[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        return np.concatenate([moved, np.zeros((rows, 1), np.uint64)], axis=1)

    lower = after(np.concatenate([np.zeros(1, np.uint64), power[: length - 1]]))  # each symbol one place to the left
    # of equal symbols in a row only the first is deleted
    first = np.concatenate([np.ones((rows, 1), bool), symbols[:, 1:] != symbols[:, :-1]], axis=1)
    at, place = np.nonzero(first)
    yield at, before[at, place] + lower[at, place + 1]
    if both_ways:
        upper = after(power[1 : length + 1])
    for symbol in range(size):
        value = np.uint64(symbol)
        at, place = np.nonzero(symbols != value if both_ways else symbols < value)
        yield at, whole[at, 0] + (value - symbols[at, place]) * power[place]
        if both_ways:
            inserted = before + (value + np.uint64(1)) * power[: length + 1] + upper
            yield np.repeat(np.arange(rows), length + 1), inserted.reshape(-1)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points) of the words of each length, a bounded number of letters at a time."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        step = max(1, CELLS // (int(length) * SYMBOLS))
        for start in range(0, len(places), step):
            part = places[start : start + step]
            yield part, letters_of([words[i] for i in part])


def _key_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        keys = np.zeros((2, len(words)), np.uint64)
        for places, letters in _by_length(words):
            for row, table in enumerate((REDUCED, EXACT)):
                keys[row, places] = keys_of(table[letters])
        reduced, exact = (pa.array(k.view(np.int64)) for k in keys)
        yield pa.RecordBatch.from_arrays([*batch.columns, reduced, exact], names=["word", "n", "key", "exact"])


def _neighbour_batches(table: np.ndarray, size: int, both_ways: bool):
    """(key, target) for rows (key, word)."""

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(1).to_pylist()
            for places, letters in _by_length(words):
                for rows, keys in neighbour_keys(table[letters], size, both_ways=both_ways):
                    sources = batch.column(0).take(pa.array(places[rows]))
                    yield pa.RecordBatch.from_arrays([sources, pa.array(keys.view(np.int64))], names=["key", "target"])

    return per_batch


def near_words(words: DataFrame) -> DataFrame:
    """All pairs (word, n, near, near_n) of ``words`` (word, n) that differ by one inserted, deleted or replaced
    code point, in both directions.

    Letters are hashed to ``SYMBOLS`` symbols. Reduced words make their one-edit neighbourhood, which is
    joined with all reduced words; a reduced word is also its own neighbour. The words behind a match are compared letter by letter.
    Where more than ``CROWD`` words share a reduced form, its words make the neighbourhood of their own letters
    instead, which is joined with all words, so that no join compares many words with many.
    """
    keyed = materialise(words.mapInArrow(_key_batches, "word string, n long, key long, exact long"), "variant-words")
    forms = keyed.groupBy("key").agg(F.count("*").alias("words"), F.min("word").alias("word"))
    forms = materialise(forms, "variant-forms")
    open_forms = forms.filter(F.col("words") <= CROWD)
    made = open_forms.select("key", "word").mapInArrow(_neighbour_batches(REDUCED, SYMBOLS, False), "key long, target long")
    met = made.join(open_forms.select(F.col("key").alias("target")), "target", "left_semi").select("key", "target")
    itself = open_forms.filter("words > 1").select("key", F.col("key").alias("target"))
    left = keyed.select("key", "word", "n")
    right = keyed.select(F.col("key").alias("target"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    one_edit = F.levenshtein("word", "near", 1) == 1
    once = (F.col("key") != F.col("target")) | (F.col("word") < F.col("near"))
    found = met.union(itself).join(left, "key").join(right, "target").filter(once & one_edit)
    found = materialise(found.select("word", "n", "near", "near_n").distinct(), "variant-pairs")
    turned = [F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")]
    pairs = found.union(found.select(*turned))
    crowded = forms.filter(F.col("words") > CROWD).select("key")
    if crowded.isEmpty():
        return pairs
    crowded = keyed.join(crowded, "key", "left_semi")
    own = crowded.select("word", F.col("word").alias("letters"))
    targets = own.mapInArrow(_neighbour_batches(EXACT, len(LETTERS), True), "word string, target long").join(
        keyed.select(F.col("exact").alias("target"), F.col("word").alias("near"), F.col("n").alias("near_n")), "target"
    )
    beyond = targets.filter(one_edit).join(crowded.select("word", "n"), "word").select("word", "n", "near", "near_n")
    beyond = materialise(beyond, "variant-crowded")
    return pairs.union(beyond.union(beyond.select(*turned)).distinct())


def follow_forms(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): each form is followed to the last, doubling the steps per round."""
    reached = materialise(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = reached.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
        following = reached.join(onward, F.col("root") == F.col("__word"), "left")
        following = following.select("word", F.coalesce("__root", "root").alias("root"), F.col("__root").isNotNull().alias("on"))
        following = materialise(following, "variant-roots")
        reached = following.select("word", "root")
        if following.filter("on").isEmpty():
            return reached


def group_variants(words: DataFrame, *, dominance: float = 2.0) -> DataFrame:
    """One row per word of ``words`` (word, n; each word once): word, form, root, n, n_near, form_n.

    A word's form is its most frequent near word (one edit away; ties: the first in code point order), if that one
    is at least ``dominance`` times as frequent; else null. The root is the last form along the chain, the word itself
    if it has none; counts grow along a chain, so it ends. ``n_near`` counts the near words.
    """
    words = materialise(words.select("word", "n"), "variant-counts")
    best = near_words(words).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    )
    leads = -F.col("best.order") >= F.col("n") * dominance
    best = materialise(
        best.select(
            F.col("word").alias("__word"),
            "n_near",
            F.when(leads, F.col("best.near")).alias("form"),
            F.when(leads, -F.col("best.order")).alias("form_n"),
        ),
        "variant-best",
    )
    roots = follow_forms(best.filter("form is not null").select(F.col("__word").alias("word"), "form"))
    roots = roots.select(F.col("word").alias("__rooted"), "root")
    return (
        words.join(best, F.col("word") == F.col("__word"), "left")
        .join(roots, F.col("word") == F.col("__rooted"), "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )
