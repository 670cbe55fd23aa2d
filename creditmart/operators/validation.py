"""Validation rules and what to do with values that fail them.

A rule is data: a column, a check, a flag to publish and a strategy. All rules
of a table compile to three narrow projections (prepare, check, handle), with
no shuffle and no extra pass. Every row ends with an *outcome*: ``kept``,
``dropped:<column>`` or ``quarantined:<column>``, decided by the first rule
that rejects it. Kept, dropped and quarantined rows are filters over that one
frame, so their counts always add up to the input.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.functions import parsing, project, quoted, text_literal

OUTCOME = "row_outcome"
KEPT = "kept"
DROPPED = "dropped"
QUARANTINED = "quarantined"


class Strategy(Enum):
    """What happens to a value, or its row, that fails a check."""

    DROP_ROW = "drop_row"
    FLAG_ONLY = "flag_only"
    DEFAULT_VALUE = "default_value"
    NULL_VALUE = "null_value"
    QUARANTINE = "quarantine"


_REJECTIONS = {Strategy.DROP_ROW: DROPPED, Strategy.QUARANTINE: QUARANTINED}


@dataclass(frozen=True)
class Rule:
    column: str
    check: Callable[[str], str]
    flag: str | None = None
    strategy: Strategy = Strategy.FLAG_ONLY
    default: float | None = None
    prepare: Callable[[str], str] | None = None


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Check and handle every ruled column that is present; add the row outcome.

    Rows are only marked, never removed: see ``kept_rows`` and
    ``quarantined_rows``. A null flag counts as invalid, so no row gets lost
    between the kept and the quarantined ones. All checks of a column see its
    prepared value, so one column takes at most one prepare and one change.
    """
    types = dict(df.dtypes)
    rules = [rule for rule in rules if rule.column in types]
    flags = [rule.flag or f"_check_{i}" for i, rule in enumerate(rules)]
    prepared = {r.column: r.prepare(quoted(r.column)) for r in rules if r.prepare}
    checked = {flag: rule.check(quoted(rule.column)) for flag, rule in zip(flags, rules)}

    handled: dict[str, str] = {}
    rejections: list[str] = []
    for flag, rule in zip(flags, rules):
        valid, value = f"coalesce({quoted(flag)}, false)", quoted(rule.column)
        if rule.strategy in _REJECTIONS:
            outcome = text_literal(f"{_REJECTIONS[rule.strategy]}:{rule.column}")
            rejections.append(f"CASE WHEN NOT {valid} THEN {outcome} END")
        elif rule.strategy is Strategy.NULL_VALUE:
            handled[rule.column] = f"CASE WHEN {valid} THEN {value} END"
        elif rule.strategy is Strategy.DEFAULT_VALUE and rule.default is not None:
            default = f"CAST({rule.default} AS {types[rule.column]})"
            handled[rule.column] = f"CASE WHEN {valid} THEN {value} ELSE {default} END"
    handled[OUTCOME] = f"coalesce({', '.join([*rejections, text_literal(KEPT)])})"

    internal = tuple(flag for flag, rule in zip(flags, rules) if rule.flag is None)
    if prepared:
        df = project(df, prepared)
    return project(project(df, checked), handled, without=internal)


def kept_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col(OUTCOME) == KEPT).drop(OUTCOME)


def quarantined_rows(flagged: DataFrame, source: str) -> DataFrame:
    """Quarantined rows with the table they came from and the rule they failed."""
    named = {"source": text_literal(source), "rule": f"substring_index({OUTCOME}, ':', -1)"}
    rejected = flagged.where(F.col(OUTCOME).startswith(f"{QUARANTINED}:"))
    return project(rejected, named).drop(OUTCOME)


_READERS = {"float": parsing.to_float, "int": parsing.to_int, "date": parsing.to_date}


def type_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the columns named in ``types``; keep the raw text of numbers.

    Columns missing from ``df`` are skipped and columns without a type pass
    through. Numbers get a ``<column>_original`` copy for audits.
    """
    typed: dict[str, str] = {}
    for name, found in df.dtypes:
        wanted = types.get(name)
        if wanted in ("float", "int"):
            typed[f"{name}_original"] = quoted(name)
        if wanted in _READERS and found != wanted:
            typed[name] = _READERS[wanted](quoted(name))
        elif wanted and found != wanted:
            typed[name] = f"CAST({quoted(name)} AS {wanted})"
    return project(df, typed)
