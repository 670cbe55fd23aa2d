"""Raw CSV extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart import fixed_values as fixed
from creditmart.sources import files

#: The text of a line that does not have the header's number of fields; null for other lines.
MALFORMED = "_malformed_line"
#: Fields that a line may have at most before the reader gives up.
MOST_FIELDS = 1 << 20


def discover(spark: SparkSession, folder: str) -> dict[str, str]:
    """Path of every extract in a folder, by source name (the file name's stem)."""
    paths = files.matching(spark, f"{folder.rstrip('/')}/*.csv")
    return {path.rsplit("/", 1)[-1].removesuffix(".csv"): path for path in paths}


def bronze_folder(source: str) -> str:
    """Known sources have their folder; others get a table named after them."""
    return fixed.BRONZE_FOLDERS.get(source, source)


def header(spark: SparkSession, paths: str | Sequence[str]) -> T.StructType:
    """The columns that the header names, all text. Reads one line."""
    return spark.read.options(header=True, enforceSchema=False).csv(paths).schema


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """All lines of an extract: its columns as text, named by the header, and ``MALFORMED``.

    No inference: it would scan the data once more, and the type of a column would depend on
    the other rows of the file. A part file whose header differs from the first one's is an
    error rather than shifted columns. A line with fewer or more fields than the header has
    its text in ``MALFORMED``; what can be read of it may stand in wrong columns. A quote that
    is never closed ends with its line.
    """
    schema = T.StructType([*header(spark, paths).fields, T.StructField(MALFORMED, T.StringType())])
    options = dict(
        header=True,
        enforceSchema=False,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=MALFORMED,
        # a reader of some columns only would not see that a line has too few or too many
        columnPruning=False,
        maxColumns=MOST_FIELDS,
    )
    return spark.read.schema(schema).options(**options).csv(paths)


def well_formed(lines: DataFrame) -> DataFrame:
    return lines.where(F.col(MALFORMED).isNull()).drop(MALFORMED)


def malformed(lines: DataFrame) -> DataFrame:
    """The text of the malformed lines, as ``line``."""
    # Spark refuses to read nothing but the text of such lines
    first = next(c for c in lines.columns if c != MALFORMED)
    return lines.where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("line"), F.col(first).alias("first_field"))


def read_extract(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The well-formed rows of an extract, all columns as text, named by the header."""
    return well_formed(read_lines(spark, paths))
