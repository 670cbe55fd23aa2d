"""Typed values out of dirty text.

ANSI mode stays on, so everything that may fail goes through a ``try_`` form:
text that cannot be read gives null and never stops a job.
"""

from __future__ import annotations

from creditmart import fixed_values as fixed
from creditmart.functions import text_literal


def strip_noise(value: str) -> str:
    """Text without the formatting characters people put into numbers."""
    # translate() drops a set of characters in one pass, without a regex
    return f"translate(CAST({value} AS STRING), {text_literal(fixed.NUMBER_NOISE)}, '')"


def to_float(value: str) -> str:
    return f"try_cast({strip_noise(value)} AS FLOAT)"


def to_int(value: str) -> str:
    """Integer part of a plain number; scientific notation and overflow give null."""
    text = strip_noise(value)
    # The sign, a zero, and the digits before the point: '28.9' -> '028', '-.5' -> '-0'.
    # Tried only where the plain cast gives nothing.
    whole = rf"regexp_replace({text}, r'^([+-]?)(\d*)\.\d*$', '$10$2')"
    return f"coalesce(try_cast({text} AS INT), try_cast({whole} AS INT))"


def to_date(value: str) -> str:
    """Date out of ``d/M/yy`` (two-digit years are 20yy) or ISO text."""
    # Turned into ISO and cast: parsing with a pattern throws and catches inside
    # the JVM for every text of the other form.
    slashes = r"^0*(\d{1,2})/0*(\d{1,2})/(\d\d)\z"
    text = f"CAST({value} AS STRING)"
    # the text is named once: it may be a long expression by itself
    return f"try_cast(regexp_replace({text}, r'{slashes}', '20$3-$2-$1') AS DATE)"


def standardise(value: str) -> str:
    return f"upper(trim({value}))"


def history_months(age: str) -> str:
    """``10 Years and 9 Months`` as 129; a missing part counts as 0, null stays null."""

    def part(pattern: str) -> str:
        # regexp_extract gives '' where nothing matches; with the zero that is a number, as casts that fail are slow
        return f"CAST(coalesce(try_cast(concat('0', regexp_extract({age}, r'{pattern}', 1)) AS INT), 0) AS BIGINT)"

    months = f"{part(fixed.YEARS_PATTERN)} * 12 + {part(fixed.MONTHS_PATTERN)}"
    return f"CASE WHEN {age} IS NOT NULL THEN try_cast({months} AS INT) END"


def credit_mix(value: str) -> str:
    """Standardised credit mix; the placeholder is null."""
    return standardise(f"nullif({value}, {text_literal(fixed.CREDIT_MIX_PLACEHOLDER)})")


def loan_type_text(value: str) -> str:
    """Trimmed loan-type list; an empty one is null."""
    return f"trim(nullif({value}, ''))"


def loan_types(value: str) -> str:
    """Array of the loan types named in a list such as ``Auto Loan, and Payday Loan``."""
    blanks = text_literal(" \t\n\x0b\f\r")
    parts = f"split(replace({value}, ' and ', ','), ',')"
    named = f"transform({parts}, part -> btrim(part, {blanks}))"
    return f"array_distinct(filter({named}, name -> contains(name, {text_literal(fixed.LOAN_TYPE_MARK)})))"
