"""Counts of a table's months, kept beside the table, and the reports that are read off them.

One row a count: (table, period, metric, flag, rows). The metrics of a silver table are the
rows that came in, stayed and were quarantined (the others were dropped), and for each flag
the valid, invalid and unknown ones. They add up over months, so a report over any range of
months reads these rows and no table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.functions import quoted
from creditmart.operators.validation import KEPT, QUARANTINED

COLUMNS = ["table", "period", "metric", "flag", "rows"]
SCHEMA = "table string, period string, metric string, flag string, rows long"
IN = "in"
STATES = ("valid", "invalid", "unknown")


def _states(flag: str) -> list[Column]:
    return [F.expr(quoted(flag)), F.expr(f"NOT {quoted(flag)}"), F.expr(f"{quoted(flag)} IS NULL")]


def _counts(df: DataFrame, table: str, period: Column, counted: dict[tuple[str, str | None], Column]) -> DataFrame:
    """One row per period and count, in one pass: counts are summed side by side and turned afterwards."""
    rows = [
        F.struct(F.lit(metric).alias("metric"), F.lit(flag).cast("string").alias("flag"), count.alias("rows"))
        for (metric, flag), count in counted.items()
    ]
    grouped = df.groupBy(period.cast("string").alias("period")).agg(F.array(*rows).alias("counts"))
    return grouped.select(F.lit(table).alias("table"), "period", F.inline("counts")).select(*COLUMNS)


def of_rows(df: DataFrame, table: str, period: Column, metric: str = "rows") -> DataFrame:
    """Rows of each period."""
    return _counts(df, table, period, {(metric, None): F.count(F.lit(1))})


def of_sorted_out(rows: DataFrame, table: str, period: Column) -> DataFrame:
    """Rows that stayed and that were quarantined, by their ``fate``, and for each flag the
    valid, invalid and unknown ones of those that stayed."""
    is_kept = F.col("fate") == KEPT
    counted: dict[tuple[str, str | None], Column] = {
        (KEPT, None): F.count_if(is_kept),
        (QUARANTINED, None): F.count_if(~is_kept),
    }
    for flag in (c for c in rows.columns if c.startswith("valid_")):
        for state, is_so in zip(STATES, _states(flag), strict=True):
            counted[state, flag] = F.count_if(is_kept & is_so)
    return _counts(rows, table, period, counted)


def quality_report(metrics: DataFrame) -> DataFrame:
    """(source, period, flag, rows_valid, rows_invalid, rows_unknown, share_valid) of every flag."""
    sums = [F.sum(F.when(F.col("metric") == state, F.col("rows")).otherwise(0)).alias(f"rows_{state}") for state in STATES]
    of_flag = metrics.where(F.col("metric").isin(*STATES))
    rows = of_flag.groupBy(F.col("table").alias("source"), "period", "flag").agg(*sums)
    known = F.col("rows_valid") + F.col("rows_invalid")
    return rows.withColumn("share_valid", F.when(known > 0, F.col("rows_valid") / known))


def retention_report(metrics: DataFrame) -> DataFrame:
    """Rows in, kept, dropped and quarantined per source table, over all periods."""
    fates = (IN, KEPT, QUARANTINED)
    sums = [F.sum(F.when(F.col("metric") == fate, F.col("rows")).otherwise(0)).alias(f"rows_{fate}") for fate in fates]
    rows = metrics.where(F.col("metric").isin(*fates)).groupBy(F.col("table").alias("source")).agg(*sums)
    dropped = F.col("rows_in") - F.col("rows_kept") - F.col("rows_quarantined")
    return rows.select(
        "source", "rows_in", "rows_kept", dropped.alias("rows_dropped"), "rows_quarantined",
        (F.col("rows_kept") / F.col("rows_in")).alias("pct_kept"),
    )


def together(metrics: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, metrics)
