"""Approximate nearest neighbours by multiprobe p-stable hashing.

On vectors of unit length, Euclidean distance orders like cosine. A table hashes a
vector into the cells of ``HASHES`` random projections, drawn from the normal
distribution, which is 2-stable, cut into steps of ``WIDTH``. A query visits its own
bucket in each table and then perturbed ones in the order of their estimated chance of
holding a near vector: the sum of squared distances to the cell borders that a
perturbation crosses. Candidates of all tables are merged and ranked by exact cosine.

A bucket's candidates and queries are cut into blocks of bounded size by a count of the
bucket, so a crowded bucket becomes many tasks. A block keeps only the best of each
query; no pair leaves a task but those. Of equal vectors only as many can be among the
nearest as are asked for, so only those with the smallest ids are indexed: a vector that
a third of all rows share takes a handful of rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.common import durable

NEIGHBOURS = 5
TABLES = 10
HASHES = 8
WIDTH = 2.0
PROBES = 75
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 512
_SEED = 7


def valid(vectors: DataFrame, dims: int) -> DataFrame:
    """(vec_id, vector) of rows whose vector has ``dims`` finite components, not all zero."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    return rows.where((F.size("vector") == dims) & finite & F.exists("vector", lambda x: x != 0) & F.col("vec_id").isNotNull())


def _hashes(dims: int, tables: int, hashes: int, width: float) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(_SEED)
    return random.normal(size=(tables, dims, hashes)), random.uniform(0, width, size=(tables, hashes))


def _bucket(cells: np.ndarray) -> np.ndarray:
    """One number for the cells of each row; a clash only adds candidates."""
    numbers = np.zeros(cells.shape[0], dtype=np.uint64)
    for column in cells.T.astype(np.int64).view(np.uint64):
        numbers = (numbers ^ column) * np.uint64(0x9E3779B97F4A7C15)
        numbers ^= numbers >> np.uint64(29)
    return numbers.view(np.int64)


def perturbations(inside: np.ndarray, probes: int) -> list[list[tuple[int, int]]]:
    """Sets of (hash, step) in the order of estimated success, the empty set first.

    ``inside`` holds the query's place in its cells, from 0 to 1.
    """
    n = len(inside)
    costs = np.concatenate([inside**2, (1 - inside) ** 2])
    order = np.argsort(costs, kind="stable")
    costs = costs[order].tolist()
    moves = [(int(i) % n, -1 if i < n else 1) for i in order]
    found: list[list[tuple[int, int]]] = [[]]
    heap = [(costs[0], (0,))]
    while heap and len(found) < probes:
        cost, chosen = heapq.heappop(heap)
        if len({moves[i][0] for i in chosen}) == len(chosen):
            found.append([moves[i] for i in chosen])
        last = chosen[-1]
        if last + 1 < 2 * n:
            heapq.heappush(heap, (cost - costs[last] + costs[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + costs[last + 1], (*chosen, last + 1)))
    return found


def _number_type(rows: DataFrame) -> str:
    return "<f4" if rows.schema["vector"].dataType.simpleString() == "array<float>" else "<f8"


def _hashed(rows: DataFrame, dims: int, tables: int, hashes: int, width: float, probes: int) -> DataFrame:
    """(tab, bucket, vec_id, vector) of each vector for each table and, of its buckets, the first ``probes``."""
    schema = "tab int, bucket long, vec_id long, vector binary"
    number_type = _number_type(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projections, offsets = _hashes(dims, tables, hashes, width)
        for batch in batches:
            for part in (batch.slice(at, 512) for at in range(0, batch.num_rows, 512)):
                given = part.column(1).flatten().to_numpy().astype(number_type).reshape(-1, dims)
                packed = pa.array([row.tobytes() for row in given], pa.binary())
                vectors = given.astype(np.float64)
                scaled = vectors / np.abs(vectors).max(axis=1)[:, None]
                unit = scaled / np.linalg.norm(scaled, axis=1)[:, None]
                for number in range(tables):
                    places = (unit @ projections[number] + offsets[number]) / width
                    cells = np.floor(places)
                    owners = np.arange(len(cells))
                    if probes > 1:
                        moved, owners = [], []
                        for at, (cell, place) in enumerate(zip(cells, places, strict=True)):
                            for steps in perturbations(place - cell, probes):
                                probe = cell.copy()
                                for hash_number, step in steps:
                                    probe[hash_number] += step
                                moved.append(probe)
                                owners.append(at)
                        cells, owners = np.array(moved), np.array(owners)
                    rows_of = pa.array(owners)
                    columns = [
                        pa.array(np.full(len(cells), number, dtype=np.int32)),
                        pa.array(_bucket(cells)),
                        part.column(0).take(rows_of),
                        packed.take(rows_of),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["tab", "bucket", "vec_id", "vector"])

    return rows.mapInArrow(run, schema)


def _best(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> list[np.ndarray]:
    """Query, candidate and exact cosine of the ``k`` nearest candidates of each query."""
    q_norms, c_norms = (np.sqrt((x * x).sum(axis=1)) for x in (q, c))
    rough = (q / q_norms[:, None]) @ (c / c_norms[:, None]).T
    rough[q_ids[:, None] == c_ids[None, :]] = -np.inf
    least = np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k else np.full(len(q), -3.0)
    at_q, at_c = np.nonzero(rough >= np.maximum(least, -3.0)[:, None] - 1e-9)
    scores = (q[at_q] * c[at_c]).sum(axis=1) / (q_norms[at_q] * c_norms[at_c])
    order = np.lexsort((c_ids[at_c], -scores, at_q))
    at_q, at_c, scores = at_q[order], at_c[order], scores[order]
    starts = np.searchsorted(at_q, np.arange(len(q)))
    first = np.arange(len(at_q)) - starts[at_q] < k
    return [q_ids[at_q[first]], c_ids[at_c[first]], scores[first]]


def _search_blocks(dims: int, number_type: str, k: int):
    """The best of each query in each block, from rows sorted by block, queries first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, held = None, []

        def closed() -> list[np.ndarray]:
            row, ids, vectors = (np.concatenate([part[i] for part in held]) for i in range(3))
            if row.all() or not row.any():
                return [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
            return _best(vectors[~row], ids[~row], vectors[row], ids[row], k)

        def emit(found: list[list[np.ndarray]]) -> pa.RecordBatch:
            columns = [pa.array(np.concatenate(column)) for column in zip(*found, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(4)], axis=1)
            row = batch.column(4).to_numpy(zero_copy_only=False)
            ids = batch.column(5).to_numpy()
            vectors = np.frombuffer(b"".join(batch.column(6).to_pylist()), dtype=number_type)
            vectors = vectors.reshape(-1, dims).astype(np.float64)
            new = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            found = []
            for start, end in zip([0, *new], [*new, len(keys)], strict=True):
                key = tuple(keys[start])
                if key != open_key:
                    if open_key is not None:
                        found.append(closed())
                    open_key, held = key, []
                held.append((row[start:end], ids[start:end], vectors[start:end]))
            if found:
                yield emit(found)
        if open_key is not None:
            yield emit([closed()])

    return run


def nearest(
    vectors: DataFrame,
    is_query: str,
    k: int = NEIGHBOURS,
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    probes: int = PROBES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row for which ``is_query`` holds.

    A query whose buckets hold fewer than ``k`` rows is compared with all rows, so it has
    ``k`` neighbours, or all there are.

    Score is the cosine in double precision on the vectors as given; ties go to the
    smaller vec_id. Vectors that are null, zero or have null or non-finite components
    take no part, nor do those of another length than most have, nor rows without a
    vec_id. Rows that repeat a vec_id are one candidate, the nearest of them, and no
    candidate of the query with their id. Other columns are left out; an empty table
    gives an empty result.
    """
    lengths = vectors.where("vec_id IS NOT NULL").groupBy(F.size("embedding").alias("n")).count().where("n > 0")
    usual = lengths.orderBy(F.desc("count"), "n").first()
    dims = usual["n"] if usual else 1
    rows = valid(vectors, dims)
    # a query's own row may be among the first of equal vectors: one more than k
    same = Window.partitionBy("vector").orderBy("vec_id")
    indexed = rows.distinct().withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1).drop("nth")
    index = _hashed(indexed, dims, tables, hashes, width, 1)
    queries = _hashed(rows.where(is_query), dims, tables, hashes, width, probes)

    def blocks(hashed: DataFrame, size: int, name: str) -> DataFrame:
        counts = hashed.groupBy("tab", "bucket").count()
        return counts.select("tab", "bucket", F.ceil(F.col("count") / size).cast("int").alias(name))

    def searched(index: DataFrame, queries: DataFrame) -> DataFrame:
        """The best of each query in each bucket that it visits."""
        cut = blocks(index, BLOCK_ROWS, "row_blocks").join(blocks(queries, BLOCK_QUERIES, "query_blocks"), ["tab", "bucket"])
        own = F.xxhash64("vec_id")
        keys = ["tab", "bucket", "row_block", "query_block"]

        def every(blocks: str) -> Column:
            return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

        row_side = index.join(cut, ["tab", "bucket"]).withColumn("row_block", F.pmod(own, F.col("row_blocks")).cast("int"))
        row_side = row_side.withColumn("query_block", every("query_blocks")).select(*keys, "vec_id", "vector")
        query_side = queries.join(cut, ["tab", "bucket"])
        query_side = query_side.withColumn("query_block", F.pmod(own, F.col("query_blocks")).cast("int"))
        query_side = query_side.withColumn("row_block", every("row_blocks")).select(*keys, "vec_id", "vector")
        both = query_side.withColumn("is_row", F.lit(False)).unionByName(row_side.withColumn("is_row", F.lit(True)))
        both = both.repartition(*keys).sortWithinPartitions(*keys, "is_row").select(*keys, "is_row", "vec_id", "vector")
        search = _search_blocks(dims, _number_type(rows), k)
        best = both.mapInArrow(search, "query_id long, vec_id long, score double")
        return best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))

    found = durable(searched(index, queries))
    enough = found.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("vec_id"))
    # one bucket that all rows are in: the exact way for queries whose buckets hold too few
    together = [F.lit(0).alias("tab"), F.lit(0).cast("long").alias("bucket"), "vec_id", "vector"]
    short = queries.where("tab = 0").select(*together).distinct().join(enough, "vec_id", "left_anti").select(*together[:2], "vec_id", "vector")
    if not short.isEmpty():
        exact = searched(index.where("tab = 0").select(*together), short)
        found = found.unionByName(exact).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
