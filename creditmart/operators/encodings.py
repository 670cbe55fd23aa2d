"""Gold encodings of categorical columns. Inputs are upper-case silver values."""

from __future__ import annotations

from pyspark.sql import DataFrame

from creditmart import fixed_values as fixed
from creditmart.functions import project, text_literal


def _indicator(condition: str) -> str:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def occupation_group(df: DataFrame, column: str = "Occupation") -> DataFrame:
    titles = ", ".join(text_literal(title) for title in fixed.PMET_OCCUPATIONS)
    return project(df, {"is_PMET": _indicator(f"{column} IN ({titles})")})


def payment_behaviour(df: DataFrame, column: str = "Payment_Behaviour") -> DataFrame:
    """High spending as 0/1 and the payment size as 0 (small), 1, 2 (large)."""
    size = (
        f"CASE WHEN contains({column}, 'LARGE_VALUE') THEN 2"
        f" WHEN contains({column}, 'MEDIUM_VALUE') THEN 1 ELSE 0 END"
    )
    return project(
        df,
        {"spending_level": _indicator(f"contains({column}, 'HIGH_SPENT')"), "value_size": size},
    )


def minimum_payment(df: DataFrame, column: str = "Payment_of_Min_Amount") -> DataFrame:
    return project(
        df,
        {
            "payment_min_yes": _indicator(f"{column} = 'YES'"),
            "payment_min_nm": _indicator(f"{column} = 'NM'"),
        },
    )


def credit_mix(df: DataFrame, column: str = "Credit_Mix") -> DataFrame:
    return project(
        df,
        {f"credit_mix_{mix.lower()}": _indicator(f"{column} = '{mix}'") for mix in ("GOOD", "STANDARD", "BAD")},
    )


def drop_non_predictive(df: DataFrame) -> DataFrame:
    """Without identifiers and the raw categoricals that encodings replace."""
    return df.drop(*fixed.NON_PREDICTIVE_COLUMNS)
