"""SQL expressions over dirty text: parsing and validity checks.

Expressions are SQL text. Tables have dozens of columns, and a projection given
as text reaches the JVM in one call instead of one call per function.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    """A string as a SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def project(df: DataFrame, columns: dict[str, str], without: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with columns added or replaced, all in one projection."""
    old = [c for c in df.columns if c not in without]
    names = [*old, *(c for c in columns if c not in old)]
    return df.selectExpr(
        *(f"{columns[c]} AS {quoted(c)}" if c in columns else quoted(c) for c in names)
    )
