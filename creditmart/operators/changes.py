"""What changed between two deliveries of a source, and which applications it can touch.

A table's content is summed up by a fingerprint per group: the number of rows and the sum
of a hash of each row. Sums do not depend on the order of rows or on how files cut the table,
and repeated rows do not cancel out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart import fixed_values as fixed
from creditmart.functions import quoted
from creditmart.operators.pointintime import KEY, TIME

ROWS, DIGEST = "rows", "digest"
MONTH = "month"


def row_hash(columns: Sequence[str]) -> Column:
    """60 bits of a row's MD5; a null differs from an empty text, and no value runs into the next."""
    values = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in map(_text, columns)]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *values)), 1, 15), 16, 10).cast("decimal(38,0)")


def _text(column: str) -> Column:
    return F.col(quoted(column)).cast("string")


def fingerprints(rows: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(``by``, rows, digest) of each group; the digest over all columns, or those given."""
    hashed = row_hash([c for c in columns or rows.columns if columns or c not in by])
    return rows.groupBy(*by).agg(F.count("*").alias(ROWS), F.sum(hashed).cast("string").alias(DIGEST))


def differing(old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups whose fingerprints differ, with those that only one side has."""
    sides = [side.select(*by, F.struct(ROWS, DIGEST).alias(name)) for side, name in ((old, "_old"), (new, "_new"))]
    matched = reduce(lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in by])
    joined = sides[0].alias("o").join(sides[1].alias("n"), matched, "full")
    # a group that one side lacks has no fingerprint there
    changed = joined.where(~F.col("_old").eqNullSafe(F.col("_new")))
    return changed.select(*(F.coalesce(f"o.{c}", f"n.{c}").alias(c) for c in by))


def changed_customers(old: DataFrame, new: DataFrame, by: Sequence[str] = (KEY, TIME)) -> DataFrame:
    """Customers (and days) whose rows differ between two versions of a source.

    Rows without a customer or a date never reach a feature and stay out.
    """
    there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by])
    return differing(*(fingerprints(version.where(there), list(by)) for version in (old, new)), by)


def touched_as_of(applications: DataFrame, changed: DataFrame, source: DataFrame) -> DataFrame:
    """(Customer_ID, snapshot_date) of applications that a change of a source read as of their
    date can touch: those from the changed day until the customer's next row in ``source``.

    ``source`` is the new version. Where rows of a later day are gone, that day is a change of
    its own, whose applications reach from it to the next row.
    """
    days = source.select(F.col(KEY).alias("_key"), F.col(TIME).alias("_day")).distinct()
    spans = (
        changed.select(KEY, F.col(TIME).alias("_from"))
        .distinct()
        .join(days, (F.col(KEY) == F.col("_key")) & (F.col("_day") > F.col("_from")), "left")
        .groupBy(F.col(KEY).alias("_key"), "_from")
        .agg(F.min("_day").alias("_until"))
    )
    inside = (F.col(TIME) >= F.col("_from")) & F.coalesce(F.col(TIME) < F.col("_until"), F.lit(True))
    return _applications(applications).join(spans, (F.col(KEY) == F.col("_key")) & inside, "left_semi")


def touched_look_back(applications: DataFrame, changed: DataFrame, days: int = fixed.LOOK_BACK_DAYS) -> DataFrame:
    """The same for a source whose last ``days`` days are averaged."""
    spans = changed.select(F.col(KEY).alias("_key"), F.col(TIME).alias("_from")).distinct()
    inside = F.col(TIME).between(F.col("_from"), F.date_add("_from", days))
    return _applications(applications).join(spans, (F.col(KEY) == F.col("_key")) & inside, "left_semi")


def touched_undated(applications: DataFrame, changed: DataFrame) -> DataFrame:
    """The same for a source without dates: all applications of a changed customer."""
    keys = changed.select(F.col(KEY).alias("_key")).distinct()
    return _applications(applications).join(keys, F.col(KEY) == F.col("_key"), "left_semi")


def _applications(applications: DataFrame) -> DataFrame:
    return applications.select(KEY, TIME).distinct()
