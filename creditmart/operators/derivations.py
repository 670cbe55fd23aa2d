"""Columns derived from cleaned values: days past due, loan types, credit history."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions import checks, parsing, project, text_literal

LOAN_TYPES = "loan_types"


def days_past_due(loans: DataFrame) -> DataFrame:
    """Month on book, instalments missed, first missed date and days past due.

    What does not fit its type is unknown (null): more instalments than an int holds, a
    first missed date before year 1, and the days past due that would follow from them.
    """
    ratio = "try_divide(CAST(overdue_amt AS DOUBLE), CAST(due_amt AS DOUBLE))"
    missed = (
        "CASE WHEN overdue_amt IS NOT NULL AND due_amt > 0"
        f" THEN try_cast(ceil({ratio}) AS INT) ELSE 0 END"
    )
    first_missed = (
        "CASE WHEN installments_missed > 0 AND installments_missed < 12 * (year(snapshot_date) - 1)"
        " THEN add_months(snapshot_date, -installments_missed) END"
    )
    unknown = "overdue_amt > 0 AND (installments_missed IS NULL OR installments_missed > 0 AND first_missed_date IS NULL)"
    days = "CASE WHEN overdue_amt > 0 THEN datediff(snapshot_date, first_missed_date) END"
    dpd = f"CASE WHEN {unknown} THEN NULL ELSE coalesce({days}, 0) END"
    loans = project(loans, {"mob": "CAST(installment_num AS INT)", "installments_missed": missed})
    return project(project(loans, {"first_missed_date": first_missed}), {"dpd": dpd})


def loan_types(financials: DataFrame, column: str = "Type_of_Loan") -> DataFrame:
    """The loan types named, as the array ``loan_types``, and whether any is (``has_any_loan``)."""
    any_loan = f"CAST(coalesce({checks.names_a_loan_type(column)}, false) AS INT)"
    named = f"coalesce({parsing.loan_types(column)}, CAST(array() AS ARRAY<STRING>))"
    return project(financials, {LOAN_TYPES: named, "has_any_loan": any_loan})


def loan_type_vocabulary(financials: DataFrame) -> DataFrame:
    """Distinct loan types in the data and the number of rows naming each."""
    # Lists repeat across customers, so count equal lists first: the explode and
    # the second shuffle then work on distinct lists only.
    lists = financials.groupBy(LOAN_TYPES).agg(F.count("*").alias("rows"))
    return (
        lists.selectExpr(f"explode({LOAN_TYPES}) AS loan_type", "rows")
        .groupBy("loan_type")
        .agg(F.sum("rows").alias("customers"))
    )


def indicator_name(loan_type: str) -> str:
    return "has_" + re.sub("[ -]", "_", loan_type.lower())


def loan_type_indicators(financials: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """One 0/1 column per loan type of a given vocabulary, from the array of types.

    A type counts where a named type is it or has it as whole words. Spellings that
    share a column name (``Pay Loan``, ``Pay-Loan``) are combined. A row without an array
    (an application without financials) has nulls.
    """
    found: dict[str, list[str]] = {}
    for loan_type in vocabulary:
        words = text_literal(rf"(?<!\w){re.escape(loan_type)}(?!\w)")
        # equal names need no pattern
        test = f"array_contains({LOAN_TYPES}, {text_literal(loan_type)}) OR exists({LOAN_TYPES}, t -> t RLIKE {words})"
        found.setdefault(indicator_name(loan_type), []).append(test)
    return project(
        financials,
        {
            name: f"CASE WHEN {LOAN_TYPES} IS NOT NULL THEN CAST(coalesce({' OR '.join(tests)}, false) AS INT) END"
            for name, tests in found.items()
        },
    )


def credit_history(financials: DataFrame) -> DataFrame:
    """Credit history in months."""
    return project(
        financials, {"Credit_History_Age_Months": parsing.history_months("Credit_History_Age")}
    )
