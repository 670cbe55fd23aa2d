"""Hierarchical packing of token sequences of several lengths.

1. A document is encoded once; its ids are cut at multiples of the window, and a last
   piece remains. From there on only piece lengths and checksums move, never ids.
2. Pieces of one length are interchangeable, so the plan is made on the number of pieces
   of each length: at most as many numbers as the window has tokens, on the driver.
3. Each piece belongs to the tier of the smallest context size that holds it. From the
   longest tier down, pieces go into gaps of windows already open, the tightest first,
   so that long windows are filled from shorter tiers; then they open windows of their
   own tier's size. A short window that comes out full stays as it is and needs no
   padding; the pieces of the others are packed into windows of full length.
   While those are padded by more than ``PADDING`` of all tokens, full short windows of the
   smallest pieces are opened again to fill their gaps, twice as many each time.
4. Windows are numbered by attention cost and dealt to steps back and forth, so that
   steps have equal numbers of windows and about equal costs.
5. A piece finds its place by its rank among those of its length. Ranks come from
   buckets of bounded size and running sums over buckets: a length that a third of all
   pieces have is never ranked in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.common import durable, texts
from creditmart.llm.tokenizing import encoder, token_ids

WINDOW = 2048
TIERS = (256, 512, 1024, 2048)
END_ID = 1
STEP_WINDOWS = 64
#: Share of padding in all tokens from which short windows are given up.
PADDING = 0.001
#: Pieces that are ranked together.
RANKED_TOGETHER = 5_000

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, ranks_path: str | None = None) -> DataFrame:
    """Pieces of every document: its ids and ``end_id``, cut at multiples of ``window``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks_path, added=True)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        for batch in batches:
            owner, rows = [], []
            for number, text in enumerate(texts(batch.column(1))):
                ids = np.append(token_ids(text, coder), np.array([end_id], dtype="<u4"))
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    owner.append(number)
                    rows.append((start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            numbers = [pa.array(column, pa.int64()) for column in (zip(*rows, strict=True) if rows else [[]] * 4)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *numbers], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _PIECES)


Kind = tuple[int, list[tuple[int, int]]]


class _Windows:
    """Open windows by the gap that is left; those that are alike are one kind."""

    def __init__(self) -> None:
        self.kinds: dict[int, list[tuple[int, Kind]]] = {}  # (size, kind)
        self.gaps: list[int] = []  # ascending, those with kinds

    def put(self, size: int, gap: int, kind: Kind) -> None:
        if gap not in self.kinds:
            self.kinds[gap] = []
            insort(self.gaps, gap)
        self.kinds[gap].append((size, kind))

    def take(self, gap: int) -> tuple[int, Kind]:
        found = self.kinds[gap].pop()
        if not self.kinds[gap]:
            del self.kinds[gap]
            self.gaps.remove(gap)
        return found

    def place(self, length: int, left: int, size: int) -> None:
        """``left`` pieces go into the tightest gaps, and what finds none into new windows of ``size``."""
        while left and (at := bisect_left(self.gaps, length)) < len(self.gaps):
            gap = self.gaps[at]
            of_size, (windows, inside) = self.take(gap)
            if windows > left:
                self.put(of_size, gap, (windows - left, inside))
                windows = left
            self.put(of_size, gap - length, (windows, [*inside, (length, 1)]))
            left -= windows
        fit = size // length
        if left >= fit:
            self.put(size, size - fit * length, (left // fit, [(length, fit)]))
        if left % fit:
            self.put(size, size - left % fit * length, (1, [(length, left % fit)]))


def _packed_by_tier(counts: dict[int, int], sizes: list[int]) -> _Windows:
    opened = _Windows()
    for length in sorted(counts, reverse=True):
        opened.place(length, counts[length], sizes[bisect_left(sizes, length)])
    return opened


def plan(counts: dict[int, int], window: int = WINDOW, tiers: tuple[int, ...] = TIERS) -> list[Kind]:
    """Kinds of windows as (number of windows, [(length, pieces of it in each window)]).

    ``counts`` has the number of pieces of each length. Windows are full at the size of a
    shorter tier, or belong to windows of full length.
    """
    sizes = sorted({window, *(size for size in tiers if size < window)})
    full = _packed_by_tier(counts, sizes).kinds.get(0, [])
    short = sorted(
        (kind for size, kind in full if size < window), key=lambda kind: max(n for n, _ in kind[1]), reverse=True
    )
    rest = dict(counts)
    for windows, inside in short:
        for n, each in inside:
            rest[n] -= windows * each
    total = sum(n * number for n, number in counts.items())
    give_back = 0
    while True:
        long = _packed_by_tier({n: number for n, number in rest.items() if number}, [window])
        kinds = [kind for gap in long.gaps for _, kind in long.kinds[gap]]
        padding = sum(gap * windows for gap in long.gaps for _, (windows, _) in long.kinds[gap])
        least = -sum(n * number for n, number in rest.items()) % window
        if not short or padding <= max(least, PADDING * total):
            return kinds + short
        left = give_back = max(padding, 2 * give_back)
        while short and left > 0:  # those of the smallest pieces come last
            windows, inside = short.pop()
            size = sum(n * each for n, each in inside)
            opened = min(windows, -(-left // size))
            for n, each in inside:
                rest[n] += opened * each
            left -= opened * size
            if opened < windows:
                short.append((windows - opened, inside))


def _slots(kinds: list[Kind], window: int, tiers: tuple[int, ...]) -> list[tuple[int, int, int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, windows, offset, context) of the plan's slots."""
    costly_first = sorted(kinds, key=lambda kind: -sum(n * n * k for n, k in kind[1]))
    used: dict[int, int] = {}
    slots, sequence = [], 0
    for windows, inside in costly_first:
        offset, fill = 0, sum(n * k for n, k in inside)
        context = fill if fill in tiers else window
        for length, each in inside:
            first = used.get(length, 0)
            used[length] = first + windows * each
            slots.append((length, first, used[length], sequence, windows, offset, context))
            offset += each * length
        sequence += windows
    return slots


def packed(
    docs: DataFrame,
    window: int = WINDOW,
    tiers: tuple[int, ...] = TIERS,
    step_windows: int = STEP_WINDOWS,
    ranks_path: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step, context.

    ``tier`` is the context size that a piece is routed to, ``context`` that of its sequence: shorter
    than ``window`` where a sequence fills a shorter tier's window.
    A null or empty text is its end id alone. Rows that repeat a doc_id are documents of
    their own. Pieces of equal length swap places at will, in an order fixed by doc_id, start and
    checksum. Other columns are left out. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = durable(pieces(docs, window, ranks_path=ranks_path))
    counts = {row["length"]: row["count"] for row in rows.groupBy("length").count().collect()}  # at most ``window``
    slots = _slots(plan(counts, window, tiers), window, tiers)
    sequences = sum(windows for windows in {first: n for _, _, _, first, n, _, _ in slots}.values())
    steps = max(1, -(-sequences // step_windows))
    buckets = max(1, -(-sum(counts.values()) // RANKED_TOGETHER))

    salted = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32"))
    sums = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = salted.groupBy("length", "bucket").count()
    before = before.select("length", "bucket", F.coalesce(F.sum("count").over(sums), F.lit(0)).alias("before"))
    ranked = salted.withColumn("own", own).join(before, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("own") - 1).drop("before", "own", "bucket")

    places = spark.createDataFrame(
        slots, "slot_length long, first long, beyond long, sequence long, windows long, slot_offset long, context long"
    )
    # slots: a few for each of at most ``window`` lengths, whatever the corpus
    inside = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("beyond"))
    placed = ranked.join(F.broadcast(places), inside)
    nth = F.col("rank") - F.col("first")
    sequence = F.col("sequence") + nth % F.col("windows")
    lap, place = F.expr(f"sequence_id DIV {steps}"), F.col("sequence_id") % steps
    tier = F.coalesce(*(F.when(F.col("length") <= size, F.lit(size)) for size in sorted({*tiers, window})))
    return (
        placed.withColumns(
            {
                "sequence_id": sequence,
                "offset": F.col("slot_offset") + F.expr("(rank - first) DIV windows") * F.col("length"),
                "tier": tier,
            }
        )
        .withColumn("step", F.when(lap % 2 == 0, place).otherwise(steps - 1 - place))
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step", "context")
    )
