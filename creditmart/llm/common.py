"""What the operators share: tables, words, durable intermediate results, bytes of a column."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words; every other character belongs to a word.
WORD_GAP = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; none for a null or blank text."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_GAP))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one of spark.checkpoint.dir.

    Where the session names none, a temporary one is made if everything runs in one process,
    as in tests; on a cluster that is an error, since executors would not share it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and kept in the shared folder.

    A lost executor does not lose them, and what is built on them does not compute
    them again.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def raw_values(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a text column, one value at a time; null reads as empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def texts(column: pa.Array) -> Iterator[str]:
    """Values of a text column, one at a time; null reads as empty."""
    for value in column:
        yield value.as_py() or ""
