"""Spelling variants against a plain version over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from melodex.llm import spelling
from melodex.llm.spelling import EXACT, LETTERS, count_words, follow_forms, group_variants, keys_of, letters_of, neighbour_keys

SCHEMA = "doc_id long, text string"


def plain_words(docs, least_length=5, least_count=3, damage=97):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    rows = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(rows)


def vocabulary(count=250, seed=4):
    draw = random.Random(seed)
    words = {}
    for _ in range(count):
        word = "".join(draw.choices("abcdeéÿ", k=draw.randint(5, 8)))
        for _ in range(draw.randint(1, 4)):
            words[word] = draw.choice([3, 4, 8, 9, 20, 50, 400])
            place = draw.randrange(len(word) + 1)
            word = word[:place] + draw.choice(["", "a", "b", "ÿ"]) + word[place + draw.randint(0, 1) :]
    return {w: n for w, n in words.items() if len(w) >= 5}


@pytest.mark.parametrize("crowd", [64, 1])
def test_variants_equal_the_plain_version(spark, monkeypatch, crowd):
    monkeypatch.setattr(spelling, "CROWD", crowd)  # 1: nearly all forms are crowded
    words = vocabulary() | {"ab" * 40: 3, "ab" * 40 + "c": 6}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    got = sorted(map(tuple, group_variants(df).collect()), key=lambda r: r[0])
    assert got == plain_groups(words)
    assert any(row[1] for row in got) and any(row[1] != row[2] for row in got if row[1])


def test_words_are_counted_as_the_plain_version_does(spark):
    draw = random.Random(9)
    alphabet = ["Straße", "naïve", "WORDS", "words", "Élan!", "x÷y", "over-the-top", "日本", "éé" * 4, "letters\x00letters"]
    docs = [(i, " ".join(draw.choices(alphabet, k=30))) for i in range(300)] + [(None, "words words " * 3), (7, None), (8, "")]
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    for name in ("word", "n", "id"):
        df = df.withColumn(name, F.lit("clash"))
    got = {r.word: r.n for r in count_words(df, damage=97).collect()}
    assert got == plain_words(docs)
    assert {r.word: r.n for r in count_words(df).collect()} == plain_words(docs, damage=1 << 40)


def test_no_words(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert group_variants(count_words(empty, damage=97)).collect() == []


def test_long_words(spark):
    word = "ab" * 20_000
    docs = spark.createDataFrame([(1, f"{word} {word}c " * 3)], SCHEMA)
    got = {len(r.word): (r.n, r.n_near, r.form) for r in group_variants(count_words(docs)).collect()}
    assert got == {40_000: (3, 1, None), 40_001: (3, 1, None)}


def test_forms_are_followed_to_the_last(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(11)] + [(f"x{i}", "w3") for i in range(30)]
    got = {r.word: r.root for r in follow_forms(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {word: "w11" for word, _ in chain}


WORD = st.text(alphabet="abcÿ", min_size=1, max_size=6)


@given(WORD)
@settings(deadline=None)
def test_neighbourhoods_are_whole(word):
    def key(w):
        return int(keys_of(EXACT[letters_of([w])])[0]) if w else 0

    letters = EXACT[letters_of([word])]
    full = {int(k) for _, keys in neighbour_keys(letters, len(LETTERS), both_ways=True) for k in keys}
    half = {int(k) for _, keys in neighbour_keys(letters, len(LETTERS), both_ways=False) for k in keys}
    places = range(len(word))
    shorter = {word[:i] + word[i + 1 :] for i in places}
    larger = {word[:i] + c + word[i + 1 :] for i in places for c in LETTERS if c > word[i]}
    smaller = {word[:i] + c + word[i + 1 :] for i in places for c in LETTERS if c < word[i]}
    longer = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in LETTERS}
    assert half == {key(w) for w in shorter | larger}
    assert full == {key(w) for w in shorter | larger | smaller | longer}
    assert np.array_equal(keys_of(letters), keys_of(EXACT[letters_of([word, word])])[:1])
