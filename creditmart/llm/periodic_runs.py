"""Periodic runs of words by recompression, and texts with each run cut to one period.

A run is a stretch of words with smallest period q (words q apart are identical), at least
``MIN_REPEATS`` periods and ``MIN_WORDS`` words long, that no neighbouring word extends.

1. Texts are put one after another, a separator of its own behind each, in chunks of
   bounded size. A chunk's words are compressed level by level into a run-length grammar:
   *blocks* of one symbol become one symbol (symbol, length), then *pairs* of a left and a
   right symbol become one, where a hash halves the symbols. Equal symbols of a level stand
   for equal words, and equal texts are compressed alike except at their edges.
2. A run of period q has three multiples of q in it. So the candidates are the points of the
   grids 0, q, 2q, ... for every q up to a third of the longest text, where three neighbours
   of the grid agree: n ln n comparisons of words, no suffix array.
3. How far the words from x on equal those from x + q on is read off the grammar: upwards as
   long as both places begin a symbol of the next level, then downwards; a block against a
   block of other length is one step. The same backwards. Both extensions are exact, and
   give the run; of equal stretches the smallest period stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import raw_values

MIN_WORDS = 24
MIN_REPEATS = 3
#: Words that are compressed together at least; a longer text is a chunk by itself.
CHUNK_WORDS = 200_000

_SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, n_words long, n_kept long"
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Level:
    """Symbols of one level, the places where they begin, and how often each comes in a row."""

    def __init__(self, starts: np.ndarray, symbols: np.ndarray):
        self.starts, self.symbols = starts.astype(np.int32), symbols.astype(np.int32)
        edges = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        self.firsts = np.concatenate([[0], edges])
        self.lengths = np.diff(np.append(self.firsts, len(symbols)))
        #: symbols equal to this one from it on, and up to it
        self.ahead = self.behind = None
        if len(edges) + 1 < len(symbols):
            at = np.arange(len(symbols)) - np.repeat(self.firsts, self.lengths)
            self.behind = (at + 1).astype(np.int32)
            self.ahead = (np.repeat(self.lengths, self.lengths) - at).astype(np.int32)


class Grammar:
    """Run-length grammar of a sequence of symbols (0 and up), level by level."""

    def __init__(self, symbols: np.ndarray):
        self.size = len(symbols)
        self.levels = [_Level(np.arange(len(symbols) + 1), symbols)]
        number = 0
        while True:
            top = self.levels[-1]
            if len(np.unique(top.symbols)) == len(top.symbols):
                return  # no two places agree here, nor above
            if len(top.firsts) < len(top.symbols):
                self.levels.append(self._blocks(top))
            number += 1
            if (paired := self._pairs(self.levels[-1], number)) is not None:
                self.levels.append(paired)

    @staticmethod
    def _blocks(level: _Level) -> _Level:
        """Neighbouring equal symbols become one."""
        names = level.symbols[level.firsts].astype(np.int64) * (int(level.lengths.max()) + 1) + level.lengths
        starts = np.append(level.starts[level.firsts], level.starts[-1])
        return _Level(starts, np.unique(names, return_inverse=True)[1])

    @staticmethod
    def _pairs(level: _Level, number: int) -> _Level | None:
        """A left symbol and the right symbol behind it become one."""
        symbols = level.symbols.astype(np.int64)
        mixed = (symbols.astype(np.uint64) + np.uint64(number << 32)) * _MIX
        right = ((mixed ^ mixed >> np.uint64(29)) * _MIX >> np.uint64(63)).astype(bool)
        joined = ~right[:-1] & right[1:]
        if (other := right[:-1] & ~right[1:]).sum() > joined.sum():
            joined = other
        if not joined.any():
            return None
        second = np.concatenate([[False], joined])
        names = symbols * (int(symbols.max()) + 2)
        names[:-1] += np.where(joined, symbols[1:] + 1, 0)
        starts = level.starts[np.append(~second, True)]
        return _Level(starts, np.unique(names[~second], return_inverse=True)[1])

    def _step(self, level: _Level, x: np.ndarray, y: np.ndarray, forward: bool) -> tuple[np.ndarray, np.ndarray]:
        """Do x and y agree in the symbol that begins (ends) there, and by how many words as a block?"""
        at_x, at_y = np.searchsorted(level.starts, x), np.searchsorted(level.starts, y)
        begun = (level.starts[at_x] == x) & (level.starts[at_y] == y)
        last = len(level.symbols) - 1
        begun &= (np.maximum(at_x, at_y) <= last) if forward else (np.minimum(at_x, at_y) > 0)
        of_x, of_y = (np.clip(at if forward else at - 1, 0, last) for at in (at_x, at_y))
        equal = begun & (level.symbols[of_x] == level.symbols[of_y])
        in_a_row = level.ahead if forward else level.behind
        times = 1 if in_a_row is None else np.minimum(in_a_row[of_x], in_a_row[of_y])
        to = np.clip(at_x + times if forward else at_x - times, 0, last + 1)
        return equal, np.abs(level.starts[to].astype(np.int64) - x)

    def common(self, x: np.ndarray, y: np.ndarray, forward: bool = True) -> np.ndarray:
        """How many words from x on equal those from y on (backwards: before x and before y)."""
        x, y = x.astype(np.int64), y.astype(np.int64)
        found = np.zeros(len(x), dtype=np.int64)
        sign = 1 if forward else -1
        stopped = np.full(len(x), -1)

        def moved(h: int, active: np.ndarray) -> np.ndarray:
            equal, by = self._step(self.levels[h], x[active], y[active], forward)
            active, by = active[equal], by[equal]
            x[active] += sign * by
            y[active] += sign * by
            found[active] += by
            return active

        rising = np.arange(len(x))
        for h in range(len(self.levels)):
            active, higher = rising, []
            while len(active):
                if h + 1 < len(self.levels):
                    up, _ = self._step(self.levels[h + 1], x[active], y[active], forward)
                    higher.append(active[up])
                    active = active[~up]
                on = moved(h, active)
                stopped[np.setdiff1d(active, on, assume_unique=True)] = h
                active = on
            rising = np.concatenate([np.zeros(0, dtype=np.int64), *higher])
        for h in reversed(range(len(self.levels))):
            active = np.flatnonzero(stopped >= h)
            while len(active):
                active = moved(h, active)
        return found


def candidates(symbols: np.ndarray, sizes: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """(places, periods) on the grids where three neighbours agree.

    ``sizes`` are the lengths of the texts in ``symbols``, each with its separator, longest first.
    """
    words = np.asarray(sizes) - 1
    ends = np.cumsum(sizes)
    places, periods = [], []
    for q in range(1, int(words[0]) // MIN_REPEATS + 1):
        long_enough = int(np.searchsorted(-words, -MIN_REPEATS * q, side="right"))
        grid = symbols[: ends[long_enough - 1] : q]
        if len(grid) > 2:
            found = np.flatnonzero((grid[:-2] == grid[1:-1]) & (grid[1:-1] == grid[2:])) * q
            places.append(found)
            periods.append(np.full(len(found), q))
    none = np.zeros(0, dtype=np.int64)
    x, q = np.concatenate([none, *places]), np.concatenate([none, *periods])
    # a run has the words behind x as well, up to one period
    inside = symbols[x + 1] == symbols[x + q + 1]
    return x[inside], q[inside]


def runs(texts: Sequence[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, by start and period.

    A text is an array of its words' numbers, 0 and up, the same word having the same number.
    """
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((i for i in range(len(texts)) if len(texts[i]) >= MIN_WORDS), key=lambda i: -len(texts[i]))
    if not order:
        return found
    vocabulary = 1 + max(int(texts[i].max()) for i in order)
    symbols = np.concatenate([part for n, i in enumerate(order) for part in (texts[i], [vocabulary + n])])
    sizes = np.array([len(texts[i]) + 1 for i in order])
    starts = np.cumsum(sizes) - sizes
    x, q = candidates(symbols, sizes)
    if not len(x):
        return found
    grammar = Grammar(symbols)
    ahead, before = grammar.common(x, x + q), grammar.common(x, x + q, forward=False)
    start, length = x - before, q + ahead + before
    enough = length >= np.maximum(MIN_WORDS, MIN_REPEATS * q)
    start, length, q = start[enough], length[enough], q[enough]
    # a stretch is found with its period and with multiples of it: the smallest comes first
    by = np.lexsort((q, length, start))
    start, length, q = start[by], length[by], q[by]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    owner = np.searchsorted(starts, start, side="right") - 1
    for k in np.flatnonzero(first):
        found[order[owner[k]]].append((int(start[k] - starts[owner[k]]), int(length[k]), int(q[k])))
    return [sorted(spans, key=lambda run: (run[0], run[2])) for spans in found]


def _row(doc_id: int | None, words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    top = (None, None, None)
    dropped = np.zeros(len(words), dtype=bool)
    for start, length, period in found:
        dropped[start + period : start + length] = True
        # lengths over periods are compared as whole numbers; the first of equals stays
        if top[0] is None or length * top[2] > top[1] * period:
            top = (start, length, period)
    written = "".join(f"{start},{length},{period}\n" for start, length, period in found).encode()
    kept = [words[i] for i in np.flatnonzero(~dropped)] if found else words
    exponent = None if top[0] is None else 1000 * top[1] // top[2]
    digests = (hashlib.sha256(written).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())
    return (doc_id, len(found), *top, exponent, *digests, len(words), len(kept))


def collapsed(
    docs: DataFrame,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256,
    n_words, n_kept) of every row of ``docs``.

    The run with the greatest length in periods (of equal ones the first), digests of all runs
    and of the words that stay when every run keeps its first period only. Words are separated
    by ASCII white space; null and blank texts have none: no runs, four nulls, digests of
    nothing. ``rewrite`` may change a row's words before. Repeated rows have the same result
    each; a null doc_id stays null. Other columns are left out; an empty table gives an empty
    result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [field.split() for field in _SCHEMA.split(", ")]
        kinds = [pa.int64() if kind == "long" else pa.string() for _, kind in fields]
        held: list[tuple[int | None, list[bytes], np.ndarray]] = []
        numbers: dict[bytes, int] = {}
        size = 0

        def closed() -> pa.RecordBatch:
            found = runs([symbols for *_, symbols in held])
            rows = [_row(doc_id, words, spans) for (doc_id, words, _), spans in zip(held, found, strict=True)]
            columns = zip(*rows, strict=True)
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])

        for batch in batches:
            for key, raw in zip(batch.column(0), raw_values(batch.column(1)), strict=True):
                doc_id, words = key.as_py(), raw.split()
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                symbols = np.array([numbers.setdefault(word, len(numbers)) for word in words], dtype=np.int64)
                held.append((doc_id, words, symbols))
                size += len(words) + 1
                if size >= chunk_words:
                    yield closed()
                    held, numbers, size = [], {}, 0
        if held:
            yield closed()

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, _SCHEMA)
