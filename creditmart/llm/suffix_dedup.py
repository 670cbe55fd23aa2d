"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

All suffixes of a corpus need not be sorted together to find strings of ``LENGTH``
bytes that occur twice: equal strings contain the same 100-byte grams, hence the same
gram of least hash, the anchor. Each text is cut into runs of window starts with one
anchor (a segment: those windows' bytes), and only windows with one anchor can be equal.

1. Anchors that occur once leave: most of the corpus, by a count of hashes.
2. Equal segments are counted on the map side. Where a segment repeats, all its windows
   do; one copy of it goes on as a partner for the others.
3. Segments that share an anchor are brought together into blocks of bounded size. Each
   block's suffixes are sorted by the difference-cover algorithm modulo 3: sort the
   triples at two thirds of the positions, name them, recurse on the names until they
   are unique, sort the other third by it, and merge. Neighbours in that order whose
   first ``LENGTH`` bytes agree mark their windows.
4. An anchor whose segments exceed a block (a passage in a third of all documents) is
   spread out: its windows are counted one by one by two 64-bit hashes. No window is
   left out.
5. Marked windows come back to their texts, whose covered bytes are removed.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import raw_values, shared_folder

LENGTH = 400
GRAM = 100
#: Bytes of segments that are sorted together at least, and the most that one anchor may bring.
BLOCK_BYTES = 1 << 20
ANCHOR_BYTES = 3 << 19
#: The most values that ``suffix_array`` can sort: three of them and their ranks fit 64 bits.
SORTED_VALUES = (1 << 21) - 3
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_ALL = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base & _ALL, dtype=np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


class _Hasher:
    """Hashes of byte ranges of a text, all from one running sum."""

    def __init__(self, base: int):
        self._base, self._inverse = base, pow(base, -1, 1 << 64)
        self._up = self._down = np.zeros(0, dtype=np.uint64)

    def sums(self, text: np.ndarray) -> np.ndarray:
        n = len(text)
        if n >= len(self._up):
            size = max(1 << 16, 2 * n)
            self._up, self._down = _powers(self._base, size), _powers(self._inverse, size)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self._up[:n], out=sums[1:])
        return sums

    def ranges(self, sums: np.ndarray, starts, ends) -> np.ndarray:
        hashes = (sums[ends] - sums[starts]) * self._down[starts]
        hashes ^= hashes >> np.uint64(30)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(27)
        hashes *= np.uint64(0x94D049BB133111EB)
        hashes ^= hashes >> np.uint64(31)
        return hashes


def _sliding(values: np.ndarray, width: int, best: np.ufunc, filler: int) -> np.ndarray:
    """Least or largest of every ``width`` neighbours, in linear time."""
    n = len(values)
    rows = np.concatenate([values, np.full(-n % width, filler, dtype=values.dtype)]).reshape(-1, width)
    ahead = best.accumulate(rows, axis=1).ravel()
    behind = best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return best(behind[:count], ahead[width - 1 : width - 1 + count])


def segments(text: np.ndarray, hasher: _Hasher, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of window starts with one anchor: anchor, hash of the segment, start, windows, repeats.

    ``repeats`` says that the anchor's gram stands more than once in the segment.
    """
    sums = hasher.sums(text)
    grams = np.arange(len(text) - gram + 1)
    hashes = hasher.ranges(sums, grams, grams + gram)
    width = length - gram + 1
    least = _sliding(hashes, width, np.minimum, _ALL)
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.append(starts[1:], len(least))
    # positions that are the least of some window; two of one value mean a repeat nearby
    edge = np.zeros(width - 1, dtype=np.uint64)
    chosen = np.flatnonzero(hashes == _sliding(np.concatenate([edge, least, edge]), width, np.maximum, 0))
    repeats = np.zeros(len(starts), dtype=bool)
    if len(np.unique(hashes[chosen])) < len(chosen):
        for number, (start, end) in enumerate(zip(starts, ends, strict=True)):
            lo, hi = np.searchsorted(chosen, [start, end + width - 1])
            repeats[number] = (hashes[chosen[lo:hi]] == least[start]).sum() > 1
    windows = ends - starts
    whole = hasher.ranges(sums, starts, ends - 1 + length) ^ windows.astype(np.uint64)
    return least[starts], whole, starts, windows, repeats


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``values`` (1 and up) in order, by difference cover modulo 3."""
    n = len(values)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: values[i:].tolist()), dtype=np.int64)
    s = np.concatenate([values, np.zeros(4, dtype=np.int64)]).astype(np.uint64)
    bits = np.uint64(max(int(s.max()), n + 2).bit_length())
    if 3 * int(bits) > 64:
        raise ValueError("a block is too large")
    # sorted triples at the sample positions; a position more, so that the two halves do not run together
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    triples = (s[sample] << bits | s[sample + 1]) << bits | s[sample + 2]
    distinct, names = np.unique(triples, return_inverse=True)
    if len(distinct) < len(sample):
        order = suffix_array(names.astype(np.int64) + 1)
    else:
        order = np.argsort(names)
    rank = np.zeros(n + 4, dtype=np.uint64)
    rank[sample[order]] = np.arange(1, len(sample) + 1, dtype=np.uint64)
    by_rank = sample[order]
    by_rank = by_rank[by_rank < n]
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(s[rest] << bits | rank[rest + 1])]
    # merge: how many sample suffixes come before each of the rest
    first, second = by_rank[by_rank % 3 == 1], by_rank[by_rank % 3 == 2]
    before = np.searchsorted(s[first] << bits | rank[first + 1], s[rest] << bits | rank[rest + 1])
    wide = [(s[at] << bits | s[at + 1]) << bits | rank[at + 2] for at in (second, rest)]
    places = np.arange(len(rest)) + before + np.searchsorted(*wide)
    result = np.empty(n, dtype=np.int64)
    free = np.ones(n, dtype=bool)
    free[places] = False
    result[places], result[free] = rest, by_rank
    return result


def repeated_windows(parts: list[bytes], windows: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each part, which of its first ``windows`` starts have an equal window of ``length`` anywhere in the parts."""
    joined = np.frombuffer(b"\0".join(parts) + b"\0" * (length + 8), dtype=np.uint8)
    sizes = np.array([len(part) + 1 for part in parts])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    total = int(sizes.sum())
    values = joined[:total].astype(np.int64) + 2
    values[starts[1:] - 1] = 1  # between parts: no window that crosses it equals one that does not
    values[-1] = 1
    valid = np.zeros(total, dtype=bool)
    for start, count in zip(starts, windows, strict=True):
        valid[start : start + count] = True
    order = suffix_array(values)
    order = order[valid[order]]
    left, right = order[:-1], order[1:]
    words = np.zeros(total + length, dtype=np.uint64)
    for k in range(8):
        words |= joined[k : k + total + length].astype(np.uint64) << np.uint64(8 * k)
    offsets = [*range(0, length - 7, 8), length - 8] if length >= 8 else []
    for offset in offsets:
        equal = words[left + offset] == words[right + offset]
        left, right = left[equal], right[equal]
    for offset in range(length if not offsets else 0):
        equal = joined[left + offset] == joined[right + offset]
        left, right = left[equal], right[equal]
    marked = np.zeros(total, dtype=bool)
    marked[left] = marked[right] = True
    return [marked[start : start + count] for start, count in zip(starts, windows, strict=True)]


def runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """(start, length) of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True))


def removed_spans(found: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal (start, end) of bytes covered by windows given as (first, windows)."""
    spans: list[tuple[int, int]] = []
    for first, count in sorted(found):
        end = first + count - 1 + length
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((first, end))
    return spans


def _written(df: DataFrame, name: str) -> DataFrame:
    folder = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _batch(rows: list[tuple], names: str, kinds: tuple[pa.DataType, ...]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names.split())


def _segment_rows(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher(_BASES[0])
        for batch in batches:
            parts, counts = [], []
            for raw in raw_values(batch.column(1)):
                parts.append(segments(np.frombuffer(raw, dtype=np.uint8), hasher, length, gram))
                counts.append(len(parts[-1][0]))
            if not parts:
                continue
            anchor, whole, start, windows, repeats = (np.concatenate(column) for column in zip(*parts, strict=True))
            keys = batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            columns = [anchor.view(np.int64), whole.view(np.int64), start.astype(np.int32), windows.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [keys, *map(pa.array, columns), pa.array(repeats)],
                names=["key", "anchor", "whole", "start", "windows", "repeats"],
            )

    schema = "key long, anchor long, whole long, start int, windows int, repeats boolean"
    long_enough = keyed.where(F.octet_length("text") >= length).select("key", "text")
    return long_enough.mapInArrow(run, schema)


def _cut_out(keyed: DataFrame, wanted: DataFrame, length: int, gram: int) -> DataFrame:
    """Bytes of ``wanted`` segments (key, anchor, whole, n, spread), once or a few times each."""
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "whole", "n", "spread")).alias("wanted"))
    joined = keyed.join(lists, "key").select("key", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher(_BASES[0])
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
        done: set[tuple[int, int]] = set()  # copies of a text bring their segments once a task
        for batch in batches:
            rows, size = [], 0
            for key, raw, wanted in zip(batch.column(0), raw_values(batch.column(1)), batch.column(2), strict=True):
                asked = {(w["anchor"], w["whole"]): (w["n"], w["spread"]) for w in wanted.as_py()}
                anchor, whole, starts, windows, _ = segments(np.frombuffer(raw, dtype=np.uint8), hasher, length, gram)
                names = zip(anchor.view(np.int64).tolist(), whole.view(np.int64).tolist(), strict=True)
                for name, start, count in zip(names, starts.tolist(), windows.tolist(), strict=True):
                    if name in asked and name not in done:
                        done.add(name)
                        part = raw[start : start + count - 1 + length]
                        rows.append((key.as_py(), *name, start, count, *asked[name], part))
                        size += len(part)
                if len(done) > 500_000:
                    done.clear()
                if size > 4 << 20:
                    yield _batch(rows, "key anchor whole start windows n spread part", kinds)
                    rows, size = [], 0
            yield _batch(rows, "key anchor whole start windows n spread part", kinds)

    schema = "key long, anchor long, whole long, start int, windows int, n long, spread boolean, part binary"
    return joined.mapInArrow(run, schema)


def _sorted_blocks(parts: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """(key, first, windows) of repeated windows of segments that occur once, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int32())
        held: list[dict] = []
        coming: list[dict] = []  # segments of the anchor that is being read
        size, more, last = 0, 0, None

        def closed() -> pa.RecordBatch:
            found = []
            if held:
                marks = repeated_windows([r["part"] for r in held], [r["windows"] for r in held], length)
                for row, marked in zip(held, marks, strict=True):
                    if row["n"] == 1:
                        found += [(row["key"], row["start"] + first, count) for first, count in runs(marked)]
            return _batch(found, "key first windows", kinds)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    name = (row["anchor"], row["whole"])
                    if name == last:
                        continue
                    if coming and row["anchor"] != last[0]:
                        if size + more > SORTED_VALUES:
                            yield closed()
                            held, size = [], 0
                        held += coming
                        size += more
                        coming, more = [], 0
                        if size >= block_bytes:
                            yield closed()
                            held, size = [], 0
                    last = name
                    coming.append(row)
                    more += len(row["part"]) + 1
        if size + more > SORTED_VALUES:
            yield closed()
            held = []
        held += coming
        yield closed()

    ordered = parts.repartition("anchor").sortWithinPartitions("anchor", "whole")
    chosen = ordered.select("key", "anchor", "whole", "start", "windows", "n", "part")
    return chosen.mapInArrow(run, "key long, first int, windows int")


def _counted_windows(parts: DataFrame, length: int) -> DataFrame:
    """The same for segments of crowded anchors: every window counted by two hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = [_Hasher(base) for base in _BASES]
        for batch in batches:
            for row in (row for at in range(0, batch.num_rows, 256) for row in batch.slice(at, 256).to_pylist()):
                text = np.frombuffer(row["part"], dtype=np.uint8)
                at = np.arange(row["windows"])
                hashes = [h.ranges(h.sums(text), at, at + length).view(np.int64) for h in hashers]
                key, n = (pa.array(np.full(len(at), row[c], dtype=np.int64)) for c in ("key", "n"))
                first = pa.array((at + row["start"]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, hashes), key, first, n], names=["h1", "h2", "key", "first", "n"]
                )

    chosen = parts.dropDuplicates(["anchor", "whole"]).select("key", "start", "windows", "n", "part")
    windows = chosen.mapInArrow(run, "h1 long, h2 long, key long, first int, n long")
    counts = windows.groupBy("h1", "h2").agg(F.sum("n").alias("all")).where("all > 1")
    # a key of its own gives the join a shuffle of its own, whose hot windows the adaptive skew
    # join can split; fed by the aggregate's partitions it could not
    own = F.col("h1").bitwiseXOR(F.lit(1))
    counts = counts.select(own.alias("_h1"), F.col("h2").alias("_h2"))
    hits = windows.where("n = 1").join(counts, (own == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left_semi")
    return hits.select("key", "first", F.lit(1).cast("int").alias("windows"))


def repeated(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
    anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """(key, found) of texts with repeated strings: the hash of the text, and its repeated
    windows as (first, windows)."""
    keyed = _keyed(docs)
    every = _written(_segment_rows(keyed, length, gram), "segments")
    again = every.groupBy("anchor").agg(F.count("*").alias("n"), F.max(F.col("repeats").cast("int")).alias("twice"))
    again = again.where("n > 1 OR twice = 1").select("anchor")
    shared = _written(every.join(again, "anchor", "left_semi"), "shared")
    distinct = shared.groupBy("anchor", "whole").agg(
        F.count("*").alias("n"),
        F.min("key").alias("key"),
        F.max("windows").alias("windows"),
        F.max(F.col("repeats").cast("int")).alias("twice"),
    )
    distinct = _written(distinct, "distinct")
    per_anchor = distinct.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.sum(F.col("windows") + (length - 1)).alias("bytes")
    )
    alone = (F.col("kinds") == 1) & ((F.col("n") > 1) | (F.col("twice") == 0))
    wanted = distinct.join(per_anchor, "anchor").where(~alone)
    wanted = wanted.select("key", "anchor", "whole", "n", (F.col("bytes") > anchor_bytes).alias("spread"))
    parts = _written(_cut_out(keyed, wanted, length, gram), "parts")

    found = shared.join(distinct.where("n > 1").select("anchor", "whole"), ["anchor", "whole"], "left_semi")
    found = found.select("key", F.col("start").alias("first"), "windows")
    found = found.unionByName(_sorted_blocks(parts.where("NOT spread"), length, block_bytes))
    crowded = parts.where("spread")
    if not crowded.isEmpty():
        found = found.unionByName(_counted_windows(crowded, length))
    return found.groupBy("key").agg(F.collect_set(F.struct("first", "windows")).alias("found"))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, **limits: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row of ``docs``.

    ``kept`` are the bytes that stay. Every byte covered by a string of ``length`` bytes
    that starts anywhere else as well is removed, in all places. Null texts are empty;
    texts shorter than ``length`` stay whole. Rows that repeat are copies of each other,
    whatever their doc_id. Other columns are left out; an empty table gives an empty result.
    """
    marks = repeated(docs, length, gram, **limits)
    joined = _keyed(docs).join(marks, "key", "left").select("doc_id", "text", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                rows = []
                for doc_id, raw, found in zip(part.column(0), raw_values(part.column(1)), part.column(2), strict=True):
                    spans = removed_spans([(f["first"], f["windows"]) for f in found.as_py() or ()], length)
                    cuts = [0, *(edge for span in spans for edge in span), len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                    digest = hashlib.sha256(kept).hexdigest()
                    rows.append((doc_id.as_py(), len(raw), len(raw) - len(kept), len(spans), digest, kept))
                yield _batch(rows, "doc_id n_bytes n_removed n_spans kept_sha256 kept", kinds)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return joined.mapInArrow(run, schema)
