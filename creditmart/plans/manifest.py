"""What the extracts held when a run last took them in, by source, file and month.

A manifest row is a file's size and time, and the rows and digest of one month in it. A file
with the size and time that the manifest has is not read again. Months are compared by what
all files of a source hold of them together, so a source that is only cut into other files
has not changed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.functions import parsing
from creditmart.operators import changes
from creditmart.operators.pointintime import TIME
from creditmart.plans import layers
from creditmart.sources import extracts, files

SCHEMA = "source string, file string, size long, modified long, month string, rows long, digest string"
#: In place of a month: rows of a source without dates, malformed lines, rows outside the calendar.
UNDATED, MALFORMED, LEFT_OUT = "undated", "malformed", "left_out"
_FILE = "_file"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The stored manifest; empty before the first."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def _months(lines: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    if TIME not in lines.columns:
        month = F.lit(UNDATED)
    else:
        day = F.expr(parsing.to_date(TIME))
        inside = F.coalesce(layers.in_calendar(day, first, last), F.lit(False))
        month = F.when(inside, day.cast("string")).otherwise(LEFT_OUT)
    return lines.withColumn(changes.MONTH, F.when(F.col(extracts.MALFORMED).isNotNull(), MALFORMED).otherwise(month))


def scan(spark: SparkSession, folder: str, old: DataFrame) -> DataFrame:
    """The manifest of the extracts in a folder. Reads the files that ``old`` does not know as they are."""
    known = {(r.source, r.file, r.size, r.modified) for r in old.select("source", "file", "size", "modified").distinct().collect()}
    found, kept = [], []
    for source, path in extracts.discover(spark, folder).items():
        parts = files.parts(spark, path)
        fresh = [part for part in parts if (source, part.uri, part.size, part.modified) not in known]
        kept += [(source, part.uri) for part in parts if part not in fresh]
        if not fresh:
            continue
        lines = extracts.read_lines(spark, [part.path for part in fresh])
        named = _months(lines.withColumn(_FILE, F.input_file_name()), None, None)
        counted = changes.fingerprints(named, [_FILE, changes.MONTH], lines.columns).withColumnRenamed(_FILE, "file")
        rows = [(part.uri, part.size, part.modified) for part in fresh]
        about = spark.createDataFrame(rows, "file string, size long, modified long")
        # a file without rows is known too
        found.append(about.join(counted, "file", "left").withColumn("source", F.lit(source)))
    unchanged = old.join(spark.createDataFrame(kept, "source string, file string"), ["source", "file"], "left_semi")
    columns = [field.split()[0] for field in SCHEMA.split(", ")]
    for part in found:
        unchanged = unchanged.unionByName(part.select(*columns))
    return unchanged.select(*columns)


def changed_months(old: DataFrame, new: DataFrame) -> dict[str, set[str]]:
    """By source, the months that differ between two manifests; there are few months."""

    def whole(manifest: DataFrame) -> DataFrame:
        digest = F.sum(F.col("digest").cast("decimal(38,0)")).cast("string").alias("digest")
        counted = manifest.where("month IS NOT NULL").groupBy("source", "month")
        return counted.agg(F.sum("rows").alias("rows"), digest)

    months: dict[str, set[str]] = {}
    for row in changes.differing(whole(old), whole(new), ["source", "month"]).collect():
        months.setdefault(row.source, set()).add(row.month)
    return months


def files_with(manifest: DataFrame, source: str, months: set[str]) -> list[str]:
    """The files of a source that hold rows of some months."""
    rows = manifest.where((F.col("source") == source) & F.col("month").isin(sorted(months)))
    return sorted(row.file for row in rows.select("file").distinct().collect())
