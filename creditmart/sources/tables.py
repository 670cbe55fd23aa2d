"""Partitioned Parquet tables: month-wise replacement and pruned reads."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from creditmart.sources.publication import Publication, folder, partition_values

__all__ = ["partition_values", "preview", "read_partitions", "replace_partitions"]


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    replaces: Callable[[dict[str, str]], bool],
    gather: bool = False,
    order_within: Sequence[str] = (),
) -> int:
    """Make ``df`` the whole content of the partitions it replaces, in one publication."""
    published = Publication(df.sparkSession, path)
    rows = published.replace_partitions(df, path, partition_by, replaces, gather, order_within)
    published.commit()
    return rows


def read_partitions(
    spark: SparkSession,
    path: str,
    column: str,
    values: Sequence[str],
    schema: T.StructType | None = None,
) -> DataFrame | None:
    """Some partitions of a table; None if there are none.

    Only their folders are listed, however many the table has. Under a schema,
    columns that a partition lacks read as null; without one, the result has all
    columns that any of the partitions has.
    """
    if not values:
        return None
    folders = [folder(path, {column: value}) for value in values]
    reader = spark.read.option("basePath", path)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    return reader.parquet(*folders)


def preview(df: DataFrame, rows: int = 10, order_by: str | None = None) -> DataFrame:
    """A few rows to look at."""
    return (df.orderBy(order_by) if order_by else df).limit(rows)
