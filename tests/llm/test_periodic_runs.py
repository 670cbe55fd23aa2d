"""Runs against a definition-by-definition search, and the grammar against plain comparison."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creditmart.llm import periodic_runs
from creditmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def smallest_period(words):
    """By the borders of the words."""
    border, fail = 0, [0] * len(words)
    for i in range(1, len(words)):
        while border and words[i] != words[border]:
            border = fail[border - 1]
        border += words[i] == words[border]
        fail[i] = border
    return len(words) - border


def brute(words):
    """Every maximal stretch of every period, kept where that period is its smallest."""
    found, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(24, 3 * q) and smallest_period(words[i : i + length]) == q:
                found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text, rewrite=planted):
    words = rewrite(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = brute(words)
    top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    digests = tuple(hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept))
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(found), *best, *digests)


def test_query_against_the_definition(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op11_periodic_runs"](spark, SF)
    wanted = sorted(expected(r.doc_id, r.text) for r in docs)
    rows = sorted(tuple(r)[:8] for r in found.collect())
    assert rows == wanted
    assert sum(r[1] > 0 for r in rows) >= 10


ODD = ["", None, " \t\n", "z " * 30_000, "a b c " * 500, "a " * 23, "a " * 24, "a b " * 12, "x " + "a b " * 12 + "a x",
       "a b " * 20 + "b a " * 20, ("a " * 9 + "b ") * 8 + "c " + ("a " * 9 + "b ") * 8, "é ü " * 30, "w" * 100_000]


@pytest.mark.parametrize("chunk_words", [periodic_runs.CHUNK_WORDS, 50])
def test_odd_texts(spark, chunk_words):
    rows = [*enumerate(ODD), (None, "q r " * 30), (4, ODD[4])]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, period int")
    found = [tuple(r)[:8] for r in periodic_runs.collapsed(df, chunk_words=chunk_words).collect()]
    wanted = [expected(i, t, lambda _, words: words) for i, t in rows if i != 3]
    assert {r for r in found if r[0] not in (3,)} == set(wanted)
    long = [r for r in found if r[0] == 3]
    assert [r[1:6] for r in long] == [(1, 0, 30_000, 1, 30_000_000)]
    assert len(found) == len(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120), st.integers(1, 12), st.integers(3, 9), st.integers(0, 10_000))
def test_runs_of_few_words(noise, period, times, seed):
    draw = random.Random(seed)
    unit = [draw.randrange(3) for _ in range(period)]
    texts = [noise, noise[: len(noise) // 2] + unit * times + noise[len(noise) // 2 :], unit * times * 2, []]
    found = periodic_runs.runs([np.array(t, dtype=np.int64) for t in texts])
    assert found == [brute(t) for t in texts]


def test_fibonacci_words_have_many_runs():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert periodic_runs.runs([np.array(b)])[0] == brute(b) != []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=200), st.integers(1, 5))
def test_extensions_are_exact(symbols, times):
    symbols = symbols * times
    n = len(symbols)
    grammar = periodic_runs.Grammar(np.array(symbols))
    x = np.array([i for i in range(0, n, max(1, n // 20)) for j in range(0, n, max(1, n // 20)) if i < j])
    y = np.array([j for i in range(0, n, max(1, n // 20)) for j in range(0, n, max(1, n // 20)) if i < j])
    if not len(x):
        return
    for i, j, ahead, behind in zip(x, y, grammar.common(x, y), grammar.common(x, y, forward=False), strict=True):
        k = 0
        while j + k < n and symbols[i + k] == symbols[j + k]:
            k += 1
        assert ahead == k
        k = 0
        while i - k > 0 and symbols[i - k - 1] == symbols[j - k - 1]:
            k += 1
        assert behind == k


def test_the_grammar_is_small():
    for symbols in (np.zeros(100_000, dtype=np.int64), np.tile(np.arange(100), 1000)):
        grammar = periodic_runs.Grammar(symbols)
        assert sum(len(level.symbols) for level in grammar.levels) <= 12 * len(symbols)
        assert len(grammar.levels) < 80


def test_no_rows(spark):
    assert periodic_runs.collapsed(spark.createDataFrame([], "doc_id long, text string")).collect() == []
