"""Validity checks: each turns a value into a boolean SQL expression.

Null fails every check with ``false``, except the pattern checks, which answer
null with null ("not known").
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from creditmart import fixed_values as fixed
from creditmart.functions import text_literal

Check = Callable[[str], str]


def matches(pattern: str) -> Check:
    return lambda value: f"{value} RLIKE r'{pattern}'"


def within(low: float, high: float) -> Check:
    return lambda value: f"({value} IS NOT NULL AND {value} BETWEEN {low} AND {high})"


def within_or_null(low: float, high: float) -> Check:
    return lambda value: f"({value} IS NULL OR {value} BETWEEN {low} AND {high})"


def positive(value: str) -> str:
    return f"({value} IS NOT NULL AND {value} > 0)"


def non_negative(value: str) -> str:
    return f"({value} IS NOT NULL AND {value} >= 0)"


def one_of(values: Sequence[str]) -> Check:
    accepted = ", ".join(text_literal(value.upper()) for value in values)
    return lambda value: f"({value} IS NOT NULL AND {value} IN ({accepted}))"


def snapshot_in_range(as_of: dt.date | None) -> Check:
    """Between the earliest accepted snapshot and ``as_of`` (today if None)."""
    first = f"unix_date(DATE '{fixed.EARLIEST_SNAPSHOT}')"
    last = f"unix_date({'current_date()' if as_of is None else f"DATE '{as_of}'"})"
    # the distance from the middle, doubled: a date is often a long expression once the planner has
    # put a check into a filter, and a comparison with each end would parse it again
    return lambda value: f"coalesce(abs(2L * unix_date({value}) - ({first} + {last})) <= {last} - {first}, false)"


def names_a_loan_type(value: str) -> str:
    placeholder = text_literal(fixed.LOAN_TYPE_PLACEHOLDER)
    return f"({value} IS NOT NULL AND {value} <> {placeholder} AND length({value}) > 0)"
