"""Months of several tables made visible together.

New content is written to a hidden folder, ``_staged``, where no reader looks. A journal in
``_journal`` then names all the moves that replace months of the tables; it appears in one
step. Before that step the tables have their old content. After it the moves happen, and
where the job is lost between two of them, whoever opens the tables next carries them to the
end. So a reader that opens them through ``recover`` sees old content only or new content only.

One writer at a time: two jobs must not publish under the same root.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditmart.operators.pointintime import KEY
from creditmart.sources import bucketed, files

STAGED = "_staged"
JOURNAL = "_journal"


def partition_values(spark: SparkSession, path: str, columns: Sequence[str]) -> list[dict[str, str]]:
    """Values of the partitions a table has, from its folder names."""
    pattern = "/".join([path.rstrip("/"), *(f"{c}=*" for c in columns)])
    return [
        dict(part.split("=", 1) for part in found.split("/")[-len(columns) :])
        for found in files.matching(spark, pattern)
    ]


def folder(path: str, values: dict[str, str]) -> str:
    return "/".join([path.rstrip("/"), *(f"{c}={v}" for c, v in values.items())])


class Publication:
    """New content of some tables under ``root``, visible from ``commit`` on."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.token = uuid.uuid4().hex
        #: (staged folder, table folder that it replaces); without the first the second is removed
        self.moves: list[tuple[str | None, str]] = []
        self._number = 0

    def write(
        self,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        order_within: Sequence[str] = (),
        buckets: int | None = None,
    ) -> tuple[str, int]:
        """Write ``df`` where nobody looks; the folder, and the rows as the write observed them.

        With a number of ``buckets`` the rows are dealt out by customer, see ``bucketed``.
        """
        self._number += 1
        staged = f"{self.root}/{STAGED}/{self.token}/{self._number}"
        written = Observation()
        rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
        if buckets:
            rows = rows.repartition(buckets, KEY)
        elif order_within:
            rows = rows.sortWithinPartitions(*partition_by, *order_within)
        writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
        if buckets:
            bucketed.write(writer, staged, buckets)
        else:
            writer.parquet(staged)
        return staged, written.get["rows"]

    def replace_table(self, df: DataFrame, path: str) -> int:
        """``df`` as the whole content of a table without partitions; its row count."""
        staged, rows = self.write(df)
        self.moves.append((staged, path))
        return rows

    def replace_partitions(
        self,
        df: DataFrame,
        path: str,
        partition_by: Sequence[str],
        replaces: Callable[[dict[str, str]], bool],
        gather: bool = False,
        order_within: Sequence[str] = (),
        buckets: int | None = None,
    ) -> int:
        """``df`` as the whole content of the partitions it replaces; its row count.

        Partitions that ``replaces`` selects but that get no new rows go, so running a month
        again never leaves rows of the earlier run behind.

        ``gather`` brings the rows of a partition together first, for inputs in no
        particular order: otherwise every task would write a file per partition. The
        rebalance splits a partition that is large, so a heavy month is no hot spot.
        ``order_within`` sorts each file, for readers that skip pages by these columns.
        """
        if gather and not buckets:
            df = df.hint("rebalance", *partition_by)
        staged, rows = self.write(df, partition_by, order_within, buckets)
        self.replace_folders(staged, path, partition_by, replaces)
        return rows

    def replace_folders(
        self, staged: str, path: str, partition_by: Sequence[str], replaces: Callable[[dict[str, str]], bool]
    ) -> None:
        """Partitions that are staged already as the whole content of those they replace."""
        files.make_folder(self.spark, path)  # a table without rows is there and empty
        new = partition_values(self.spark, staged, partition_by)
        self.moves += [(folder(staged, values), folder(path, values)) for values in new]
        for values in partition_values(self.spark, path, partition_by):
            if replaces(values) and values not in new:
                self.moves.append((None, folder(path, values)))

    def commit(self) -> None:
        """Make the new content the tables' content."""
        files.write_text(self.spark, f"{self.root}/{JOURNAL}/{self.token}", json.dumps(self.moves))
        _carry_out(self.spark, self.root, self.token, self.moves)


def _carry_out(spark: SparkSession, root: str, token: str, moves: Sequence[tuple[str | None, str]]) -> None:
    """All moves that did not happen yet, then the end of the journal."""
    for staged, target in moves:
        if staged is None:
            files.remove(spark, target)
        elif files.exists(spark, staged):  # else it has been moved
            files.remove(spark, target)
            files.rename(spark, staged, target)
    files.remove(spark, f"{root}/{JOURNAL}/{token}")
    files.remove(spark, f"{root}/{STAGED}/{token}")


def recover(spark: SparkSession, root: str) -> int:
    """Carry out publications that a lost job began; how many there were."""
    root = root.rstrip("/")
    journals = [path for path in files.matching(spark, f"{root}/{JOURNAL}/*") if not path.endswith(".part")]
    for path in journals:
        _carry_out(spark, root, path.rsplit("/", 1)[-1], json.loads(files.read_text(spark, path)))
    return len(journals)


def discard_unpublished(spark: SparkSession, root: str) -> None:
    """Remove what lost jobs staged but never published; for a writer, before it stages."""
    recover(spark, root)
    files.remove(spark, f"{root.rstrip('/')}/{STAGED}")
