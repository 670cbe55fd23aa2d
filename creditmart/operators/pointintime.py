"""Point-in-time operators: what was known about a customer at a given date.

The as-of lookup and the look-back averages share one *timeline* per customer:
lookup dates and source rows, ordered by day, read by window frames. All frames
use the same partitioning and order, so several sources cost one shuffle, one
sort and one window pass, with no fan-out.

A customer may own a large part of a table, so nothing unreduced enters a
customer's window. Lookup dates are distinct and every source is reduced per
(customer, day) by aggregates that combine on the map side; a customer's group
is then bounded by the number of days in the calendar, whatever the row count.
Results come back by an equi-join on (customer, day) against a side with unique
keys, whose row side the adaptive skew join can split at will.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart import fixed_values as fixed
from creditmart.functions import quoted

KEY = "Customer_ID"
TIME = "snapshot_date"

_DAY = "_day"
_LOOKUP = "_is_lookup"
_CUSTOMER = "_customer"
_TOTALS = "_totals"
_PLACE = "_place"


@dataclass(frozen=True)
class State:
    """Latest row of ``frame`` on or before the lookup date, as a struct ``name``."""

    name: str
    frame: DataFrame

    def per_day(self) -> DataFrame:
        payload = ", ".join(quoted(c) for c in self.frame.columns if c != KEY)
        # of several rows on one day the greatest is taken, column by column
        latest = F.expr(f"max(struct({payload}))").alias(self.name)
        return _dated(self.frame).groupBy(KEY, TIME).agg(latest)

    def lookups(self) -> list[str]:
        return [f"last({self.name}, true) OVER ({_window('UNBOUNDED')}) AS {self.name}"]

    def answers(self) -> list[str]:
        return [self.name]


def daily_totals(frame: DataFrame, features: Sequence[str] = tuple(fixed.CLICK_FEATURES)) -> DataFrame:
    """Rows, and sum and count of each feature, per customer and day: what means over any span
    of days are made of. Stored by month, a month's rows are read once for all later windows."""
    totals = [F.expr(f"sum({quoted(f)})").alias(f"_sum_{f}") for f in features]
    counts = [F.expr(f"count({quoted(f)})").alias(f"_n_{f}") for f in features]
    return _dated(frame).groupBy(KEY, TIME).agg(F.expr("count(*) AS _rows"), *totals, *counts)


@dataclass(frozen=True)
class LookBack:
    """Means of ``features`` over the ``days`` before the lookup date, both ends in.

    ``frame`` has the rows, or, with ``of_totals``, their daily totals.
    """

    frame: DataFrame
    features: Sequence[str] = tuple(fixed.CLICK_FEATURES)
    days: int = fixed.LOOK_BACK_DAYS
    suffix: str = "last_6m"
    count_name: str = "clickstream_snapshot_count"
    of_totals: bool = False

    def totals(self) -> DataFrame:
        return self.frame if self.of_totals else daily_totals(self.frame, self.features)

    def per_day(self) -> DataFrame:
        """Rows, and the features' totals in one struct: most rows of a timeline have no clicks, and a
        null struct is one field to sort and to copy, where the totals would be two for each feature."""
        totals = [f"_{kind}_{feature}" for feature in self.features for kind in ("sum", "n")]
        return self.totals().select(KEY, TIME, "_rows", F.struct(*totals).alias(_TOTALS))

    def lookups(self) -> list[str]:
        # the totals of a frame's days, one more than ``days`` at most, are handed on and added up for the
        # lookups alone: window sums of every feature would be made anew for each row of the timeline
        window = _window(self.days)
        return [f"collect_list({_TOTALS}) OVER ({window}) AS {_TOTALS}", f"sum(_rows) OVER ({window}) AS _rows"]

    def answers(self) -> list[str]:
        def total(column: str) -> str:
            kind = kinds[column]
            added = f"CAST(total + coalesce(day.{quoted(column)}, 0) AS {kind})"
            return f"aggregate({_TOTALS}, CAST(0 AS {kind}), (total, day) -> {added})"

        kinds = dict(self.totals().dtypes)
        means = [
            f"CASE WHEN _rows > 0 THEN try_divide(CAST({total(f'_sum_{f}')} AS DOUBLE), {total(f'_n_{f}')}) END"
            f" AS avg_{f}_{self.suffix}"
            for f in self.features
        ]
        return [*means, f"coalesce(_rows, 0) AS {self.count_name}"]


def _window(days_before: int | str) -> str:
    return f"PARTITION BY {_PLACE}, {_CUSTOMER} ORDER BY {_DAY} RANGE BETWEEN {days_before} PRECEDING AND CURRENT ROW"


def _dated(frame: DataFrame) -> DataFrame:
    """Rows that can ever match: keyless or dateless ones would only pile up."""
    return frame.where(F.col(KEY).isNotNull() & F.col(TIME).isNotNull())


def timeline(lookups: DataFrame, sources: Sequence[State | LookBack]) -> DataFrame:
    """For every distinct (customer, date) of ``lookups``, what the sources knew then.

    Over sources that are stored by customer (``sources.bucketed``) nothing is shuffled.
    """
    wanted = _dated(lookups.select(KEY, TIME)).distinct().selectExpr("*", f"true AS {_LOOKUP}")
    # under a name of its own the key is one and the same column for the planner in all parts, and
    # the union keeps a partitioning that they share
    parts = [part.withColumnRenamed(KEY, _CUSTOMER) for part in (wanted, *(source.per_day() for source in sources))]
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    lookups = [column for source in sources for column in source.lookups()]
    answers = [column for source in sources for column in source.answers()]
    # sorted by a number first: ids begin alike, and a sort looks at the first bytes of its first key
    dated = rows.selectExpr("*", f"hash({_CUSTOMER}) AS {_PLACE}", f"unix_date({TIME}) AS {_DAY}")
    known = dated.selectExpr(_CUSTOMER, TIME, _LOOKUP, *lookups).where(_LOOKUP)
    return known.selectExpr(f"{_CUSTOMER} AS {KEY}", TIME, *answers)


def with_answers(left: DataFrame, known: DataFrame) -> DataFrame:
    """Left join of rows with what a timeline knows at their customer and date."""
    # here too the sort goes by a number first
    place = F.hash(KEY, TIME).alias(_PLACE)
    return left.select("*", place).join(known.select("*", place), [_PLACE, KEY, TIME], "left").drop(_PLACE)


def as_of_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join with the latest right row on or before each left date.

    Gives exactly one row per left row. Right columns whose names the left side
    already has are left out, except the right date, which comes as
    ``source_date``.
    """
    known = timeline(left, [State("state", right)])
    new = [c for c in right.columns if c not in left.columns]
    return with_answers(left, known).selectExpr(
        *(quoted(c) for c in left.columns),
        *(f"state.{quoted(c)} AS {quoted(c)}" for c in new),
        f"state.{TIME} AS source_date",
    )


def look_back_join(left: DataFrame, clicks: DataFrame, **window) -> DataFrame:
    """Left join with the clickstream averages of the look-back window."""
    look_back = LookBack(clicks, **window)
    known = timeline(left, [look_back])
    means = [f"avg_{f}_{look_back.suffix}" for f in look_back.features]
    return with_answers(left, known).selectExpr(
        *(quoted(c) for c in left.columns),
        *means,
        f"coalesce({look_back.count_name}, 0) AS {look_back.count_name}",
    )


def history_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join with *all* right rows on or before each left date.

    A left row with k earlier right rows comes k times. The matching rows are an
    inner join, of which the adaptive skew join can split both sides (a left
    join could split only the left one); left rows without a match are found
    through each customer's first date, which aggregates on the map side.
    """
    new = [c for c in right.columns if c not in left.columns]
    states = _dated(right).select(
        F.col(KEY).alias("_key"), F.col(TIME).alias("source_date"), *new
    )
    first = states.groupBy("_key").agg(F.min("source_date").alias("source_date"))
    known = (F.col(KEY) == F.col("_key")) & (F.col("source_date") <= F.col(TIME))
    matched = left.join(states, known, "inner").drop("_key")
    unmatched = left.join(first, known, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True).select(
        *left.columns, *new, "source_date"
    )


def bucketed_history_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """``history_join`` on (customer, month), for customers with a large part of all rows.

    The right side is keyed by the month of its date, the left side by every month from its
    customer's first one to its own; the dates are compared in the last of them only. So a
    customer's rows spread over as many keys as there are months, and with the skew join's
    splits over more. A left row is copied once per month, a match found once as before.
    """
    new = [c for c in right.columns if c not in left.columns]
    states = _dated(right).select(
        F.col(KEY).alias("_key"), F.col(TIME).alias("source_date"), F.trunc(TIME, "month").alias("_month"), *map(quoted, new)
    )
    first = states.groupBy("_key").agg(F.min("source_date").alias("_first"))
    # a key of its own gives the join a shuffle of its own, whose hot customers can be split
    first = first.select(F.concat("_key", F.lit("")).alias("_customer"), "_first")
    known = (F.col(KEY) == F.col("_customer")) & (F.col("_first") <= F.col(TIME))
    rows = left.select(F.struct(*map(quoted, left.columns)).alias("_row"), KEY, TIME)
    months = F.sequence(F.trunc("_first", "month"), F.trunc(TIME, "month"), F.expr("INTERVAL 1 MONTH"))
    probes = rows.join(first, known).select("_row", KEY, TIME, F.explode(months).alias("_bucket"))
    met = (F.col(KEY) == F.col("_key")) & (F.col("_bucket") == F.col("_month")) & (F.col("source_date") <= F.col(TIME))
    matched = probes.join(states, met).select("_row.*", *map(quoted, new), "source_date")
    unmatched = left.join(first, known, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True).select(*map(quoted, left.columns), *map(quoted, new), "source_date")


def customer_join(left: DataFrame, right: DataFrame, every_row: bool = False) -> DataFrame:
    """Left join on the customer alone, for a table without dates.

    Every left row comes once: of several right rows of a customer the greatest is
    taken, column by column. With ``every_row`` a left row comes once for each right row
    of its customer instead. The names the left side already has are dropped from the
    right one.
    """
    new = [c for c in right.columns if c not in left.columns]
    payload = F.struct(*(quoted(c) for c in new))
    rows = right.where(F.col(KEY).isNotNull())
    if every_row:
        rows = rows.select(KEY, payload.alias("_row"))
    else:
        rows = rows.groupBy(KEY).agg(F.max(payload).alias("_row"))
    # a key of its own gives the join a shuffle of its own, whose hot customers the adaptive
    # skew join can split; fed by the aggregate's partitions it could not
    rows = rows.select(F.concat(KEY, F.lit("")).alias("_key"), "_row")
    matched = F.col(KEY) == F.col("_key")
    joined = left.join(rows, matched, "left")
    if every_row:
        # an inner join lets both sides of a hot customer be split; a left join only the left one
        keys = rows.select("_key").distinct()
        joined = left.join(rows, matched).unionByName(left.join(keys, matched, "left_anti"), allowMissingColumns=True)
    return joined.select(*(quoted(c) for c in left.columns), *(f"_row.{quoted(c)}" for c in new))
