"""The loan types that the data have named so far: a small versioned table that runs merge into.

Indicator columns of all months come from its newest version, so a type that turns up in a
later month gives earlier months the same column. A version that is there never changes; a
merge that brings nothing new makes none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.operators import derivations
from creditmart.sources.publication import Publication, partition_values

SCHEMA = "loan_type string, first_period string"
#: Beyond so many types the data name something else, and no table should get a column for each.
MOST_TYPES = 1000


def versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(v["version"]) for v in partition_values(spark, path, ["version"]))


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(loan_type, first_period) of a version, the newest by default; empty before the first."""
    found = versions(spark, path)
    if not found:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(f"{path}/version={found[-1] if version is None else version}")


def named(financials: DataFrame, period) -> DataFrame:
    """Loan types of a table and the first period that names each."""
    lists = financials.groupBy(derivations.LOAN_TYPES).agg(F.min(period.cast("string")).alias("first_period"))
    types = lists.select(F.explode(derivations.LOAN_TYPES).alias("loan_type"), "first_period")
    return types.groupBy("loan_type").agg(F.min("first_period").alias("first_period"))


def merge(published: Publication, path: str, found: DataFrame) -> None:
    """A new version with the types of ``found`` too, where they add anything."""
    spark = published.spark
    old = read(spark, path)
    merged = old.unionByName(found).groupBy("loan_type").agg(F.min("first_period").alias("first_period"))
    if not merged.exceptAll(old).isEmpty():
        number = max(versions(spark, path), default=0) + 1
        published.replace_table(merged, f"{path}/version={number}")


def types(vocabulary: DataFrame) -> list[str]:
    """The types by name."""
    found = sorted(row.loan_type for row in vocabulary.select("loan_type").limit(MOST_TYPES + 1).collect())
    if len(found) > MOST_TYPES:
        raise ValueError(f"the data name more than {MOST_TYPES} loan types; give those that get a column as loan_types")
    return found
