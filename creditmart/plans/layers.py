"""The three layers as lazy plans, from DataFrame to DataFrame.

Bronze keeps raw text with a real snapshot date; silver is typed, flagged and
enriched; gold holds labels and point-in-time features. Each plan covers all
months at once. Reading and writing tables is up to ``job``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart import fixed_values as fixed
from creditmart.functions import parsing, project, quoted
from creditmart.operators import derivations, encodings, labels, pointintime
from creditmart.operators.pointintime import KEY, TIME
from creditmart.operators.validation import DROPPED, KEPT, OUTCOME, apply_rules, kept_rows, type_columns
from creditmart.plans.specs import FINANCIALS, LOAN_DAILY, TableSpec

# ---- bronze -------------------------------------------------------------------


def in_calendar(day, first: dt.date | None, last: dt.date | None):
    """Is ``day`` the first of a month from ``first``'s month to ``last``? Without a limit, of any month."""
    inside = day == F.trunc(day, "month")
    if first:
        inside &= day >= F.trunc(F.lit(first), "month")
    return inside & (day <= F.lit(last)) if last else inside


def month_calendar(span: DataFrame) -> DataFrame:
    """All first days of a month from ``first`` to ``last`` (columns of ``span``).

    The span has to come from checked dates: they lie between fixed limits.
    """
    months = F.sequence(F.trunc("first", "month"), F.col("last"), F.expr("INTERVAL 1 MONTH"))
    return span.select(F.explode(months).alias("snapshot_date"))


def bronze(raw: DataFrame, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Raw rows of the calendar's snapshots, all columns as text but the snapshot date.

    A source without snapshot dates passes unchanged.
    """
    if "snapshot_date" not in raw.columns:
        return raw
    dated = project(raw, {"snapshot_date": parsing.to_date("snapshot_date")})
    return dated.where(in_calendar(F.col("snapshot_date"), first, last))


# ---- silver -------------------------------------------------------------------


def flagged(spec: TableSpec, raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Typed and checked rows, each with its outcome; nothing is removed yet."""
    return apply_rules(type_columns(raw, spec.types), spec.all_rules(as_of))


FATE, RULE = "fate", "rule"


def sorted_out(spec: TableSpec, flagged_rows: DataFrame) -> DataFrame:
    """Kept and quarantined rows with the table's derived columns, in one frame.

    ``fate`` is ``kept`` or ``quarantined`` and ``rule`` the column whose rule decided, so one
    write, partitioned by both, gives both tables from one scan.
    """
    fate = f"substring_index({OUTCOME}, ':', 1)"
    rule = f"CASE WHEN {OUTCOME} = '{KEPT}' THEN '-' ELSE substring_index({OUTCOME}, ':', -1) END"
    return spec.derive(project(flagged_rows, {FATE: fate, RULE: rule})).where(F.col(FATE) != DROPPED).drop(OUTCOME)


def silver(
    spec: TableSpec,
    raw: DataFrame,
    as_of: dt.date | None = None,
) -> DataFrame:
    """The kept rows with the table's derived columns."""
    return spec.derive(kept_rows(flagged(spec, raw, as_of)))


def loans_on_book(raw: DataFrame, mobs: Sequence[int], as_of: dt.date | None = None) -> DataFrame:
    """Silver loans in some of their months on book; rows of other months leave before any check."""
    # the month on book is the installment number, and rules neither change nor check that
    wanted = F.expr(parsing.to_int("installment_num")).isin(list(mobs))
    return silver(LOAN_DAILY, raw.where(wanted), as_of)


def loan_type_vocabulary(financials_raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Loan types named in the kept rows of a raw or bronze financials table."""
    return derivations.loan_type_vocabulary(silver(FINANCIALS, financials_raw, as_of))


# ---- gold ---------------------------------------------------------------------

APPLICATION_COLUMNS = ["loan_id", "Customer_ID", "snapshot_date", "mob"]


def applications(loans: DataFrame) -> DataFrame:
    """Loans at application time; exact repeats of an application collapse."""
    return labels.at_month(loans, 0).select(APPLICATION_COLUMNS).distinct()


def shared_applications(loans: DataFrame) -> DataFrame:
    """``applications`` of loans with customer and date, for a plan that reads them more than once.

    The shuffle of the repeats is the same one for all readers, so the loans are read and
    cleaned once. Without the repartition, which the planner takes out again because the rows
    already lie that way, a reader's own distinct would be moved below it.
    """
    known = F.col(KEY).isNotNull() & F.col(TIME).isNotNull()
    return applications(loans.where(known)).repartition(*APPLICATION_COLUMNS)


def attribute_features(attributes: DataFrame, with_flags: bool = False) -> DataFrame:
    return _features(encodings.occupation_group(attributes), "attributes", with_flags)


def financial_features(
    financials: DataFrame, with_flags: bool = False, with_loan_types: bool = False
) -> DataFrame:
    encoded = encodings.payment_behaviour(financials)
    encoded = encodings.credit_mix(encodings.minimum_payment(encoded))
    return _features(encoded, "financials", with_flags, with_loan_types)


def _features(encoded: DataFrame, table: str, with_flags: bool, with_loan_types: bool = False) -> DataFrame:
    """Encode first, drop the raw columns afterwards; the contract leaves out audit copies.

    Flags come on demand. The two that every table has carry the table's name.
    """
    shared = ("valid_customer_id", "valid_snapshot_date")
    columns = []
    for name in encodings.drop_non_predictive(encoded).columns:
        is_flag = name.startswith("valid_")
        if name.endswith("_original") or (is_flag and not with_flags):
            continue
        if name == derivations.LOAN_TYPES and not with_loan_types:
            continue
        columns.append(f"{name} AS {table}_{name}" if name in shared else quoted(name))
    if with_flags and "valid_credit_mix" in encoded.columns:
        columns.append("valid_credit_mix")
    return encoded.selectExpr(columns)


def feature_store(
    loans: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    clickstream: DataFrame,
    with_flags: bool = False,
    every_undated_row: bool = False,
    with_loan_types: bool = False,
    clicks_are_totals: bool = False,
) -> DataFrame:
    """One row per application with all that was known about its customer then.

    The three sources share one customer timeline, so the applications join
    once, on (customer, date), with a side that has unique keys. Attributes or
    financials without dates join on the customer alone: with the greatest of the
    customer's rows, or, with ``every_undated_row``, once with each of them.
    ``with_loan_types`` keeps the array of loan types that financials have, for indicators
    of types that are not known yet. With ``clicks_are_totals`` the clickstream comes as
    daily totals.
    """
    base = applications(loans)
    tables = {
        "attributes": attribute_features(attributes, with_flags),
        "financials": financial_features(financials, with_flags, with_loan_types),
    }
    states = []
    for table, frame in tables.items():
        if TIME in frame.columns:
            states.append(pointintime.State(table, frame))
        else:
            payload = F.struct(*(c for c in frame.columns if c != KEY)).alias(table)
            base = pointintime.customer_join(base, frame.select(KEY, payload), every_undated_row)
    clicks = pointintime.LookBack(clickstream, of_totals=clicks_are_totals)
    # loans give the same (customer, date) pairs as ``base``, without waiting for its distinct
    known = pointintime.timeline(labels.at_month(loans, 0), [*states, clicks])
    taken = {*APPLICATION_COLUMNS, *(f"avg_{f}_last_6m" for f in fixed.CLICK_FEATURES), clicks.count_name}
    columns = list(APPLICATION_COLUMNS)
    for table, frame in tables.items():
        for name in (c for c in frame.columns if c not in (KEY, TIME)):
            # a name that is taken gets the table in front, so that neither column is lost
            free = f"{table}_{name}" if name in taken else name
            columns.append(f"{table}.{quoted(name)} AS {quoted(free)}")
            taken.add(free)
    columns += [f"avg_{feature}_last_6m" for feature in fixed.CLICK_FEATURES]
    columns.append(f"coalesce({clicks.count_name}, 0) AS {clicks.count_name}")
    columns.append("date_format(snapshot_date, 'yyyy-MM-dd') AS feature_snapshot_date")
    return pointintime.with_answers(base, known).selectExpr(columns)
