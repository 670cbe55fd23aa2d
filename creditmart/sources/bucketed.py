"""Monthly tables whose files are cut and sorted by customer.

A customer's rows of every month lie in the files of one bucket, of the same bucket in all
tables. What reads such tables by customer (the timeline of the point-in-time features)
finds them dealt out and shuffles nothing. The write deals the rows out instead, once,
however often they are read.

Spark keeps the number of buckets with a table, not with its files, so readers register a
table over the folder. The number belongs to the folder for good: ``agreed`` holds it there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from creditmart.functions import quoted
from creditmart.operators.pointintime import KEY, TIME
from creditmart.sources import files


def agreed(spark: SparkSession, path: str, buckets: int | None) -> int | None:
    """The number of buckets of the tables under a folder; the first to ask sets it."""
    there = int(files.read_text(spark, path)) if files.exists(spark, path) else None
    if buckets is not None and there is not None and buckets != there:
        raise ValueError(f"the tables have {there} buckets, not {buckets}")
    if buckets is not None and there is None:
        files.write_text(spark, path, str(buckets))
    return there if buckets is None else buckets


def _name(path: str) -> str:
    return f"by_customer_{hashlib.md5(path.encode()).hexdigest()}"


def write(writer: DataFrameWriter, path: str, buckets: int) -> None:
    """Write to a folder in buckets; the rows have to be dealt out by customer into as many parts."""
    spark, name = writer._spark, _name(path)
    ordered = writer.bucketBy(buckets, KEY).sortBy(KEY, TIME)
    ordered.option("path", path).format("parquet").mode("overwrite").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the folder is not the catalog's


def read(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str], buckets: int
) -> DataFrame:
    """A monthly table as the catalog sees it: all months that are there now, in buckets."""
    name = _name(path)
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(partition_by)})"
        f" CLUSTERED BY ({KEY}) SORTED BY ({KEY}, {TIME}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)
