"""Reports on the data: row counts, validity, retention, quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions import quoted
from creditmart.operators.validation import DROPPED, KEPT, OUTCOME, QUARANTINED

HIGH_QUALITY_FLAGS = ("valid_customer_id", "valid_annual_income", "valid_credit_mix")


def partition_counts(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows"))


def quality_report(df: DataFrame, source: str, by: str) -> DataFrame:
    """(source, by, flag, rows_valid, rows_invalid, rows_unknown, share_valid) of every flag.

    A flag that is null is unknown. The share is that of valid rows among the known
    ones; the counts beside it show how many are left out. One pass over the table: the
    counts of all flags are summed side by side and turned into rows afterwards.
    """
    flags = [c for c in df.columns if c.startswith("valid_")]
    counts = [
        F.struct(
            F.lit(flag).alias("flag"),
            F.count_if(F.expr(quoted(flag))).alias("rows_valid"),
            F.count_if(F.expr(f"NOT {quoted(flag)}")).alias("rows_invalid"),
            F.count_if(F.expr(f"{quoted(flag)} IS NULL")).alias("rows_unknown"),
        )
        for flag in flags
    ]
    rows = df.groupBy(by).agg(F.array(*counts).alias("counts")).select(by, F.inline("counts"))
    known = F.col("rows_valid") + F.col("rows_invalid")
    share = F.when(known > 0, F.col("rows_valid") / known)
    return rows.select(F.lit(source).alias("source"), "*", share.alias("share_valid"))


def retention_report(flagged: dict[str, DataFrame]) -> DataFrame:
    """Rows in, kept, dropped and quarantined per source table."""
    outcomes = reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(source).alias("source"), F.substring_index(OUTCOME, ":", 1).alias("fate"))
            for source, df in flagged.items()
        ],
    )

    def rows(fate: str):
        return F.count_if(F.col("fate") == fate).alias(f"rows_{fate}")

    return (
        outcomes.groupBy("source")
        .agg(F.count("*").alias("rows_in"), rows(KEPT), rows(DROPPED), rows(QUARANTINED))
        .withColumn("pct_kept", F.col("rows_kept") / F.col("rows_in"))
    )


def quarantine_counts(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy("source", "rule").agg(F.count("*").alias("rows"))


def high_quality(df: DataFrame, flags=HIGH_QUALITY_FLAGS) -> DataFrame:
    """Rows whose flags are all true."""
    return df.where(reduce(lambda a, b: a & b, [F.col(flag) for flag in flags]))
