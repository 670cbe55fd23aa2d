"""Default labels and training sets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart import fixed_values as fixed

LABEL_COLUMNS = ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]


def at_month(loans: DataFrame, mob: int) -> DataFrame:
    """Loans in their ``mob``-th month on book."""
    return loans.where(F.col("mob") == mob)


def _label(dpd: Column | int) -> Column:
    return F.coalesce(F.col("dpd") >= dpd, F.lit(False)).cast("int")


def label_loans(
    loans: DataFrame, dpd: int = fixed.LABEL_DPD, mob: int = fixed.LABEL_MOB
) -> DataFrame:
    """1 for loans ``dpd`` or more days past due at month ``mob``, else 0."""
    return (
        at_month(loans, mob)
        .withColumns({"label": _label(dpd), "label_def": F.lit(f"{dpd}dpd_{mob}mob")})
        .select(LABEL_COLUMNS)
    )


def label_sweep(
    loans: DataFrame,
    dpds: Sequence[int] = fixed.SWEEP_DPD,
    mobs: Sequence[int] = fixed.SWEEP_MOB,
) -> DataFrame:
    """Labels under every combination of thresholds and months, in one scan."""
    threshold = F.col("threshold")
    name = F.concat(threshold.cast("string"), F.lit("dpd_"), F.col("mob").cast("string"), F.lit("mob"))
    return (
        loans.where(F.col("mob").isin(list(mobs)))
        .withColumn("threshold", F.explode(F.array(*(F.lit(d) for d in dpds))))
        .withColumns({"label": _label(threshold), "label_def": name})
        .select(LABEL_COLUMNS)
    )


def label_distribution(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label_def", "label").agg(F.count("*").alias("loans"))


def training_set(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features at application joined with the outcome of the same loan."""
    outcome = labels.select(
        "loan_id", "label", "label_def", F.col("snapshot_date").alias("label_snapshot_date")
    )
    return features.join(outcome, "loan_id", "inner")


def time_split(
    df: DataFrame,
    splits: Sequence[tuple[str, str, str]] = tuple(fixed.TIME_SPLITS),
    column: str = "snapshot_date",
) -> DataFrame:
    """Name the split of each row by its date; rows after the last one are ``oot``.

    Rows before the first split keep a null name.
    """
    day = F.col(column)
    split = F.when(day > _date(splits[-1][2]), "oot")
    for name, first, last in splits:
        split = split.when(day.between(_date(first), _date(last)), name)
    return df.withColumn("split", split)


def _date(text: str) -> Column:
    return F.lit(dt.date.fromisoformat(text))
