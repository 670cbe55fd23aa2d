"""Removal of passages that stand earlier in the corpus, by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one text. Its minimiser is the gram of ``GRAM``
words with the least hash (of equal ones the first). Consecutive windows whose minimiser
stands at one place form a super-k-mer and travel as one packed string, their words, to the
bucket of that minimiser; equal windows have equal minimisers, hence meet in a bucket.

1. Texts give (minimiser, place) for each super-k-mer: numbers only. Minimisers that occur
   once leave; their buckets could not hold a window twice.
2. The others are named by 128-bit digests of their words. Equal ones are told by their
   names, first within a task, then together; all but the first are removed as they are, so
   a passage in a third of all texts is one string in its bucket, or none, where no other
   string has its minimiser.
3. Strings that share a bucket with others are packed and travel there. The bucket sorts
   their windows and sees which stand earlier. A bucket with more than ``bucket_rows``
   different strings (a common line within ever other words) is spread out: its windows are
   grouped one by one by their digests. None is left out.
4. Windows that stand earlier come back to their texts, whose covered words are removed.

Texts are ordered by doc_id, rows without one last; a row's windows by their start.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import raw_values, shared_folder

WINDOW = 20
GRAM = 8
#: Different packed strings of a minimiser that are sorted together in a task at most.
BUCKET_ROWS = 20_000
_LAST = (1 << 63) - 1
#: Bits of a place that hold the number of windows.
_SHIFT = 16
_BASE = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """Hash of each word, computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def super_kmers(words: list[bytes], hashes: dict, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(minimiser, start, windows) of the runs of windows whose minimiser stands at one place."""
    n = len(words)
    if n < window:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.int32), none.astype(np.int32)
    of_words = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=n)
    grams = of_words[: n - gram + 1].copy()
    for k in range(1, gram):
        grams *= _BASE
        grams += of_words[k : n - gram + 1 + k]
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    width = window - gram + 1
    places = np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)
    places += np.arange(n - window + 1)
    starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    windows = np.diff(np.append(starts, len(places)))
    return grams[places[starts]].view(np.int64), starts.astype(np.int32), windows.astype(np.int32)


def _digest(packed: bytes) -> tuple[int, int]:
    raw = hashlib.blake2b(packed, digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def earlier_windows(rows: list[tuple[int, int, bytes]], window: int = WINDOW) -> list[tuple[int, int]]:
    """(row, offset) of the windows that stand earlier in the bucket; rows are (order, start, packed)."""
    entries = []
    for number, (order, start, packed) in enumerate(rows):
        words = packed.split(b" ")
        for at in range(len(words) - window + 1):
            entries.append((b" ".join(words[at : at + window]), order, start + at, number, at))
    entries.sort()
    found, first = [], None
    for entry in entries:
        if first is None or entry[0] != first[0]:
            first = entry
        elif entry[1:3] != first[1:3]:
            found.append(entry[3:])
    return found


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        text.alias("text"),
        F.coalesce(doc_id, F.lit(_LAST)).alias("order"),
        F.xxhash64(text).alias("key"),
        # finds a text; texts that share it get each other's places too, which changes nothing
        F.xxhash64(doc_id, text).alias("row"),
    )


def _squeezed(keyed: DataFrame) -> DataFrame:
    """``keyed`` with compressed texts, for joins that move them: half of what shuffles write else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array(map(coder.compress, raw_values(batch.column(0))), pa.binary())
            yield pa.RecordBatch.from_arrays([packed, *batch.columns[1:]], names=batch.schema.names)

    chosen = keyed.select("text", "doc_id", "order", "key", "row")
    return chosen.mapInArrow(run, "text binary, doc_id long, order long, key long, row long")


def _written(df: DataFrame, name: str) -> DataFrame:
    folder = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [field.split() for field in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    arrays = [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _all_super_kmers(keyed: DataFrame, window: int, gram: int) -> DataFrame:
    """(row, minimiser, place) of every super-k-mer; a place is a start and a number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            found = [super_kmers(raw.split(), hashes, window, gram) for raw in raw_values(batch.column(1))]
            if not found:
                continue
            rows = pa.array(np.repeat(np.arange(len(found)), [len(starts) for _, starts, _ in found]))
            minimisers, starts, windows = (np.concatenate(column) for column in zip(*found, strict=True))
            places = starts.astype(np.int64) << _SHIFT | windows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), pa.array(minimisers), pa.array(places)], names=["row", "minimiser", "place"]
            )

    return keyed.select("row", "text").mapInArrow(run, "row long, minimiser long, place long")


def _at(keyed: DataFrame, wanted: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Texts with lists of their wanted super-k-mers."""
    lists = wanted.groupBy(*by).agg(F.collect_set(F.struct(*columns)).alias("wanted"))
    rows = _squeezed(keyed).select("order", "key", "text", *(c for c in by if c == "row"))
    return rows.join(lists, by).select("order", "key", "text", "wanted")


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple]:
    """(order, key, start, windows, other fields, packed string) of each wanted super-k-mer."""
    coder = zstandard.ZstdDecompressor()
    for batch in batches:
        columns = (batch.column(0), batch.column(1), raw_values(batch.column(2)), batch.column(3))
        for order, key, raw, wanted in zip(*columns, strict=True):
            words, name = coder.decompress(raw).split(), (order.as_py(), key.as_py())
            for place, *others in sorted(zip(*(column.to_pylist() for column in wanted.values.flatten()), strict=True)):
                start, windows = place >> _SHIFT, place & (1 << _SHIFT) - 1
                end = start + windows - 1 + window
                if end <= len(words):
                    yield *name, start, windows, *others, b" ".join(words[start:end])


def _batches(rows: Iterator[tuple], schema: str, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    yield _batch(held, schema)


def _named(keyed: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Wanted super-k-mers with their names; ``later`` if the task has met one at an earlier place."""
    schema = "order long, key long, minimiser long, place long, d1 long, d2 long, later boolean"

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        met: dict[tuple[int, int], tuple[int, int, int]] = {}
        for order, key, start, windows, minimiser, packed in _cut(batches, window):
            digest, place = _digest(packed), (order, key, start)
            before = met.get(digest, place)
            if digest in met and before == place:
                continue  # a row that repeats
            later = before[0] < order or (before[:2] == (order, key) and before[2] < start)
            if before[0] > order or digest not in met:
                if len(met) > 500_000:
                    met.clear()
                met[digest] = place
            yield order, key, minimiser, start << _SHIFT | windows, *digest, later

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(named(batches), schema)

    return _at(keyed, wanted, ["row"], ["place", "minimiser"]).mapInArrow(run, schema)


def _packed(keyed: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Wanted super-k-mers with their words as one string."""
    schema = "order long, key long, start int, minimiser long, n long, packed binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _cut(batches, window)
        rows = ((order, key, start, *others, packed) for order, key, start, _, *others, packed in cut)
        yield from _batches(rows, schema)

    return _at(keyed, wanted, ["order", "key"], ["place", "minimiser", "n"]).mapInArrow(run, schema)


def _own_shuffle(column: str) -> Column:
    """A key of its own gives a join a shuffle of its own, whose hot keys the adaptive skew join
    can split; fed by an aggregate's partitions it could not."""
    return F.col(column).bitwiseXOR(F.lit(1))


_SPANS = "order long, key long, start int, windows int"


def _searched_buckets(rows: DataFrame, window: int) -> DataFrame:
    """Windows that stand earlier in their buckets, bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_bucket, held = None, []

        def closed() -> list[tuple]:
            spans = earlier_windows([(order, start, packed) for order, _, start, packed in held], window)
            return [(held[row][0], held[row][1], held[row][2] + at, 1) for row, at in spans]

        for batch in batches:
            found = []
            for bucket, *row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if bucket != open_bucket:
                    if len(held) > 1:
                        found += closed()
                    open_bucket, held = bucket, []
                held.append(row)
            yield _batch(found, _SPANS)
        if len(held) > 1:
            yield _batch(closed(), _SPANS)

    ordered = rows.repartition("minimiser").sortWithinPartitions("minimiser")
    return ordered.select("minimiser", "order", "key", "start", "packed").mapInArrow(run, _SPANS)


def _grouped_windows(rows: DataFrame, window: int) -> DataFrame:
    """The same for crowded buckets, one row a window."""
    schema = "order long, key long, start int, w1 long, w2 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                out = []
                for order, key, start, packed in zip(*(column.to_pylist() for column in part.columns), strict=True):
                    words = packed.split(b" ")
                    for at in range(len(words) - window + 1):
                        out.append((order, key, start + at, *_digest(b" ".join(words[at : at + window]))))
                yield _batch(out, schema)

    windows = rows.select("order", "key", "start", "packed").mapInArrow(run, schema)
    place = F.struct("order", "start")
    firsts = windows.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select(_own_shuffle("w1").alias("_w1"), F.col("w2").alias("_w2"), "first")
    again = windows.join(firsts, (_own_shuffle("w1") == F.col("_w1")) & (F.col("w2") == F.col("_w2")))
    return again.where(place > F.col("first")).select("order", "key", "start", F.lit(1).alias("windows"))


def repeated(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(order, key, found) of texts with windows that stand earlier: the text's place in the
    order and its hash, and those windows as (start, windows)."""
    return _repeated(_keyed(docs), window, gram, bucket_rows)


def _repeated(keyed: DataFrame, window: int, gram: int, bucket_rows: int) -> DataFrame:
    every = _written(_all_super_kmers(keyed, window, gram), "super-kmers")
    again = every.groupBy("minimiser").agg(F.count("*").alias("n")).where("n > 1")
    again = again.select(_own_shuffle("minimiser").alias("_again"))
    shared = every.join(again, _own_shuffle("minimiser") == F.col("_again"), "left_semi")
    named = _written(_named(keyed, shared, window), "named")

    firsts = named.where("NOT later").groupBy("d1", "d2").agg(F.min("order").alias("first"))
    firsts = firsts.select(_own_shuffle("d1").alias("_d1"), F.col("d2").alias("_d2"), "first")
    placed = named.join(firsts, (_own_shuffle("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")))
    is_first = (~F.col("later") & (F.col("order") == F.col("first"))).alias("is_first")
    placed = _written(placed.select("order", "key", "minimiser", "place", is_first), "placed")

    start = F.shiftrightunsigned("place", _SHIFT).cast("int").alias("start")
    windows = F.col("place").bitwiseAND(F.lit((1 << _SHIFT) - 1)).cast("int").alias("windows")
    found = placed.where("NOT is_first").select("order", "key", start, windows)
    rows = placed.where("is_first")
    buckets = rows.groupBy("minimiser").agg(F.count("*").alias("n")).where("n > 1")
    buckets = buckets.select(_own_shuffle("minimiser").alias("_bucket"), "n")
    together = rows.join(buckets, _own_shuffle("minimiser") == F.col("_bucket"))
    met = _written(_packed(keyed, together, window), "packed")
    found = found.unionByName(_searched_buckets(met.where(F.col("n") <= bucket_rows), window))
    crowded = met.where(F.col("n") > bucket_rows)
    if not crowded.isEmpty():
        found = found.unionByName(_grouped_windows(crowded, window))
    return found.groupBy("order", "key").agg(F.collect_set(F.struct("start", "windows")).alias("found"))


def deduplicated(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of every row of ``docs``.

    ``kept`` are the words that stay, joined by spaces. A word is removed if a window that
    covers it stands earlier: in a row with a smaller doc_id, or earlier in a row with the same
    one. Words are separated by ASCII white space; null texts have none, and texts shorter
    than a window stay whole. Rows that repeat are one and have the same result each; rows
    without a doc_id come after all others. Other columns are left out; an empty table gives
    an empty result.
    """
    keyed = _keyed(docs)
    marks = _repeated(keyed, window, gram, bucket_rows)
    joined = _squeezed(keyed).join(marks, ["order", "key"], "left").select("doc_id", "text", "found")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                rows = []
                for doc_id, raw, found in zip(part.column(0), raw_values(part.column(1)), part.column(2), strict=True):
                    words = kept = coder.decompress(raw).split()
                    if found.is_valid:
                        edges = np.zeros(len(words) + 1, dtype=np.int64)
                        start, windows = (column.to_numpy() for column in found.values.flatten())
                        np.add.at(edges, start, 1)
                        np.add.at(edges, start + windows - 1 + window, -1)
                        kept = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
                    joined = b" ".join(kept)
                    digest = hashlib.sha256(joined).hexdigest()
                    rows.append((doc_id.as_py(), len(words), len(words) - len(kept), digest, joined.decode()))
                yield _batch(rows, schema)

    return joined.mapInArrow(run, schema)
