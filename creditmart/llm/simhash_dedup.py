"""Near-duplicate documents by SimHash fingerprints and pivot distance tables.

1. Every text gets a 64-bit fingerprint; equal fingerprints are one item from there on,
   so a group of exact copies costs one row, however many rows it has.
2. Fingerprints that differ in at most three bits agree on at least three of six blocks
   of bits. Each of the 20 choices of three blocks is a table of buckets; a bucket holds
   the fingerprints that agree on some 32 bits.
3. In a bucket, the Hamming distances to many reference fingerprints (pivots) are
   computed once. By the triangle inequality two fingerprints whose distances to any
   pivot differ by more than three are no link; the others are verified bit by bit.
   A search that visits every fingerprint once gives a spanning forest of the links:
   fewer rows than fingerprints, not all pairs.
4. Buckets above ``bucket_rows`` are not searched in a task. There, fingerprints meet at
   points: x goes to all points within one bit, y to all points within two bits; a
   common point means three bits or fewer, and every such pair has one. Exact, and
   linear in the fingerprints.
5. Components of the forests are found by alternating star contractions.

Pivots alone give ranges, no keys to join on, and each range keeps about half of all
pairs; therefore blocks come first.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.functions import quoted
from creditmart.llm.common import durable, raw_values

MAX_BITS = 3
BLOCK_BITS = (11, 11, 11, 11, 10, 10)
PIVOTS = 32
BUCKET_ROWS = 16_384
_SEED = 42


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """SimHash of the word shingles of a text, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), _SEED)]
    else:
        digest = xxhash.xxh64_intdigest
        shifted = [words[i:] for i in range(shingle_words)]
        hashes = [digest(shingle, _SEED) for shingle in map(b" ".join, zip(*shifted, strict=False))]
    rows = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(rows), 255):  # sums of 255 bits fit a byte
        bits = np.unpackbits(rows[start : start + 255], axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int(np.packbits(ones * 2 > len(rows), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """(doc_id, fp) of each row; null text counts as empty, whose fingerprint is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(text, shingle_words) for text in raw_values(batch.column(1))]
            signed = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), signed], names=["doc_id", "fp"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return chosen.mapInArrow(run, "doc_id long, fp long")


def _bucket_keys(fp: Column) -> Column:
    """One key per choice of three blocks: the choice, and the bits of its blocks."""
    starts = np.cumsum((0, *BLOCK_BITS))
    keys = []
    for number, chosen in enumerate(combinations(range(len(BLOCK_BITS)), len(BLOCK_BITS) - MAX_BITS)):
        mask = sum(((1 << BLOCK_BITS[b]) - 1) << int(starts[b]) for b in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(number).alias("choice"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def _pivots() -> np.ndarray:
    return np.random.default_rng(_SEED).integers(0, 1 << 64, size=PIVOTS, dtype=np.uint64)


def _forest(items: np.ndarray, table: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the links in a bucket: every item is visited once."""
    found = []
    rest = np.arange(len(items))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.abs(table[rest] - table[at]).max(axis=1) <= MAX_BITS
            passed = rest[near]
            linked = np.bitwise_count(items[passed] ^ items[at]) <= MAX_BITS
            reached = passed[linked]
            if len(reached):
                found += [(int(at), int(to)) for to in reached]
                queue += list(reached)
                near[near] = linked
                rest = rest[~near]
    return found


def _search_buckets(bucket_rows: int):
    """Links per bucket from rows sorted by bucket; for larger buckets, only their key."""

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "choice", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = _pivots()
        open_key, held, large = None, [], False

        def closed() -> list[tuple]:
            if large:
                return [(None, None, *open_key)]
            items = np.concatenate(held)
            if len(items) < 2:
                return []
            unsigned = items.view(np.uint64)
            table = np.bitwise_count(unsigned[:, None] ^ pivots[None, :]).astype(np.int8)
            return [(int(items[a]), int(items[b]), None, None) for a, b in _forest(unsigned, table)]

        for batch in batches:
            if not batch.num_rows:
                continue
            choice, bits, fps = (batch.column(i).to_numpy() for i in range(3))
            new = np.flatnonzero((np.diff(choice) != 0) | (np.diff(bits) != 0)) + 1
            starts, ends = np.concatenate([[0], new]), np.concatenate([new, [len(fps)]])
            # buckets that end inside the batch and have one row need no look
            worth = ends - starts > 1
            worth[0] = worth[-1] = True
            out: list[tuple] = []
            for start, end in zip(starts[worth], ends[worth], strict=True):
                key = (int(choice[start]), int(bits[start]))
                if key != open_key:
                    if open_key is not None:
                        out += closed()
                    open_key, held, large = key, [], False
                if not large:
                    held.append(fps[start:end])
                    if sum(map(len, held)) > bucket_rows:
                        held, large = [], True
            if out:
                yield emit(out)
        if open_key is not None:
            yield emit(closed())

    return run


def _meeting_points(fps: DataFrame) -> DataFrame:
    """Links of ``fps`` through points within one bit of one side and two of the other."""
    one = [1 << i for i in range(64)]
    two = [a | b for a, b in combinations(one, 2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = np.array([0, *one, *two], dtype=np.uint64)
        inner = np.arange(len(flips)) <= len(one)
        for batch in batches:
            items = batch.column(0).to_numpy().view(np.uint64)
            for part in np.array_split(items, max(1, len(items) // 64)):
                points = (part[:, None] ^ flips[None, :]).ravel().view(np.int64)
                owners = np.repeat(part, len(flips)).view(np.int64)
                columns = [pa.array(points), pa.array(owners), pa.array(np.tile(inner, len(part)))]
                yield pa.RecordBatch.from_arrays(columns, names=["point", "fp", "inner"])

    points = fps.mapInArrow(run, "point long, fp long, inner boolean")
    hubs = points.where("inner").groupBy("point").agg(F.min("fp").alias("hub"))
    return points.join(hubs, "point").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))


def links(distinct: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Pairs (a, b) of fingerprints that connect all fingerprints within three bits."""
    buckets = distinct.select(F.explode(_bucket_keys(F.col("fp"))).alias("key"), "fp").select("key.*", "fp")
    ordered = buckets.repartition("choice", "bits").sortWithinPartitions("choice", "bits")
    searched = durable(ordered.mapInArrow(_search_buckets(bucket_rows), "a long, b long, choice int, bits long"))
    found = searched.where("a IS NOT NULL").select("a", "b")
    large = searched.where("a IS NULL").select("choice", "bits")
    if not large.isEmpty():
        crowded = buckets.join(large, ["choice", "bits"], "left_semi").select("fp").distinct()
        found = found.unionByName(_meeting_points(crowded))
    return found


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node reachable.

    Alternating stars: every node hands its neighbours to the smallest one it knows,
    first the larger neighbours, then the smaller ones, until nothing moves.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return pairs.join(least.withColumn("m", F.least("u", "m")), "u")

    def state(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        return tuple(row)

    oriented = [F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")]
    pairs = durable(edges.where("a <> b").select(*oriented).distinct())
    before = None
    while (now := state(pairs)) != before and now[0]:
        before = now
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = smallest(large)
        moved = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = durable(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct())
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, shingle_words: int = 3, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) of each row of ``docs`` (doc_id, text; more columns are left out).

    Rows with fingerprints within three bits are linked, and component_id is the
    smallest doc_id that can be reached. Null or blank texts have fingerprint 0 and
    link like any other. A null doc_id takes part, but is never a component_id unless
    its whole component has none. Repeated rows stay, each with the same result; an
    empty table gives an empty result.
    """
    rows = durable(fingerprints(docs, shingle_words))
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp"), bucket_rows))
    linked = distinct.join(roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct(),
                           F.col("fp") == F.col("node")).select("fp", "least", "root")
    reach = linked.groupBy("root").agg(F.min("least").alias("reached"))
    joined = linked.join(reach, "root").select("fp", "reached")
    final = distinct.join(joined, "fp", "left")
    # a key of its own gives the join a shuffle of its own, whose hot fingerprints the adaptive
    # skew join can split; fed by the aggregate's partitions it could not
    key = F.col("fp").bitwiseXOR(F.lit(1))
    final = final.select(key.alias("_key"), F.coalesce("reached", "least").alias("component_id"))
    return rows.join(final, key == F.col("_key")).select("doc_id", "fp", "component_id")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the smallest doc_id.

    Components are those of ``near_duplicates`` over the rows that have a doc_id. Of several
    rows with the doc_id that stays, one does; which one goes by their content. Rows without
    a doc_id cannot be named by a decision and stay. All columns are kept, whatever their names.
    """
    found = near_duplicates(docs.where("doc_id IS NOT NULL"))
    keepers = found.where("doc_id = component_id").select(F.col("doc_id").alias("_kept")).distinct()
    whole = docs.select(F.col("doc_id").alias("_own"), F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("_row"))
    rows = whole.join(keepers, F.col("_own") == F.col("_kept"), "left_semi")
    rank = F.row_number().over(Window.partitionBy("_own").orderBy(F.xxhash64("_row")))
    first = rows.withColumn("_rank", rank).where("_rank = 1").select("_row.*")
    return first.unionByName(docs.where("doc_id IS NULL"))
