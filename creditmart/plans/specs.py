"""The four source tables, declared: columns, types, rules and derivations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from creditmart import fixed_values as fixed
from creditmart.functions import checks, parsing, project
from creditmart.operators import derivations
from creditmart.operators.validation import Rule, Strategy


@dataclass(frozen=True)
class TableSpec:
    name: str
    source: str
    types: dict[str, str]
    rules: tuple[Rule, ...]
    derive: Callable[[DataFrame], DataFrame]
    id_strategy: Strategy = Strategy.FLAG_ONLY
    date_strategy: Strategy = Strategy.NULL_VALUE

    @property
    def bronze_folder(self) -> str:
        return fixed.BRONZE_FOLDERS[self.source]

    def all_rules(self, as_of: dt.date | None) -> list[Rule]:
        """Id rule, date rule, then the rules of the table: the order in which rows are rejected."""
        return [
            Rule("Customer_ID", checks.matches(fixed.CUSTOMER_ID_PATTERN), "valid_customer_id", self.id_strategy),
            Rule("snapshot_date", checks.snapshot_in_range(as_of), "valid_snapshot_date", self.date_strategy),
            *self.rules,
        ]

    def empty_raw(self, spark: SparkSession) -> DataFrame:
        """No rows, all columns: stands for an extract that did not arrive."""
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in self.types]))


# ---- loans --------------------------------------------------------------------

LOAN_DAILY = TableSpec(
    name="loan_daily",
    source="lms_loan_daily",
    types={
        "loan_id": "string",
        "Customer_ID": "string",
        "loan_start_date": "date",
        "tenure": "int",
        "installment_num": "int",
        "loan_amt": "float",
        "due_amt": "float",
        "paid_amt": "float",
        "overdue_amt": "float",
        "balance": "float",
        "snapshot_date": "date",
    },
    id_strategy=Strategy.DROP_ROW,
    date_strategy=Strategy.DROP_ROW,
    rules=(
        Rule("loan_amt", checks.positive, "valid_loan_amt"),
        *(
            Rule(amount, checks.non_negative, f"valid_{amount}")
            for amount in ("due_amt", "paid_amt", "overdue_amt", "balance")
        ),
    ),
    derive=lambda loans: derivations.days_past_due(loans),
)

# ---- clickstream ----------------------------------------------------------------

CLICKSTREAM = TableSpec(
    name="clickstream",
    source="feature_clickstream",
    types={
        "Customer_ID": "string",
        "snapshot_date": "date",
        **{feature: "int" for feature in fixed.CLICK_FEATURES},
    },
    rules=tuple(
        Rule(feature, checks.non_negative, f"valid_{feature}", Strategy.DEFAULT_VALUE, 0)
        for feature in fixed.CLICK_FEATURES
    ),
    derive=lambda clicks: clicks,
)

# ---- attributes -----------------------------------------------------------------


def _attributes(attributes: DataFrame) -> DataFrame:
    derived = {}
    if "Age" in attributes.columns:
        derived["Age_capped"] = (
            f"CASE WHEN Age < {fixed.AGE_FLOOR} THEN {fixed.AGE_BELOW_FLOOR}"
            f" WHEN Age > {fixed.AGE_CEILING} THEN {fixed.AGE_ABOVE_CEILING} ELSE Age END"
        )
    if "Occupation" in attributes.columns:
        derived["Occupation"] = parsing.standardise("Occupation")
    return project(attributes, derived)


ATTRIBUTES = TableSpec(
    name="attributes",
    source="features_attributes",
    types={
        "Customer_ID": "string",
        "Name": "string",
        "Age": "int",
        "SSN": "string",
        "Occupation": "string",
        "snapshot_date": "date",
    },
    rules=(
        Rule("Age", checks.within(*fixed.AGE_RANGE), "valid_age"),
        Rule("SSN", checks.matches(fixed.SSN_PATTERN), "valid_ssn"),
    ),
    derive=_attributes,
)

# ---- financials -----------------------------------------------------------------


def _financials(financials: DataFrame) -> DataFrame:
    if "Type_of_Loan" in financials.columns:
        financials = derivations.loan_types(financials)
    if "Credit_History_Age" in financials.columns:
        valid = checks.within(*fixed.CREDIT_HISTORY_MONTHS_RANGE)("Credit_History_Age_Months")
        financials = derivations.credit_history(financials)
        financials = project(financials, {"valid_credit_history_age": valid})
    return financials


FINANCIALS = TableSpec(
    name="financials",
    source="features_financials",
    types={
        "Customer_ID": "string",
        "Annual_Income": "float",
        "Monthly_Inhand_Salary": "float",
        "Num_Bank_Accounts": "int",
        "Num_Credit_Card": "int",
        "Interest_Rate": "float",
        "Num_of_Loan": "int",
        "Type_of_Loan": "string",
        "Delay_from_due_date": "int",
        "Num_of_Delayed_Payment": "int",
        "Changed_Credit_Limit": "float",
        "Num_Credit_Inquiries": "float",
        "Credit_Mix": "string",
        "Outstanding_Debt": "float",
        "Credit_Utilization_Ratio": "float",
        "Credit_History_Age": "string",
        "Payment_of_Min_Amount": "string",
        "Total_EMI_per_month": "float",
        "Amount_invested_monthly": "float",
        "Payment_Behaviour": "string",
        "Monthly_Balance": "float",
        "snapshot_date": "date",
    },
    id_strategy=Strategy.DROP_ROW,
    date_strategy=Strategy.DROP_ROW,
    rules=(
        # implausible incomes leave the table, unlikely ones are only flagged
        Rule(
            "Annual_Income",
            checks.within_or_null(*fixed.ANNUAL_INCOME_PLAUSIBLE),
            strategy=Strategy.QUARANTINE,
        ),
        Rule("Annual_Income", checks.within(*fixed.ANNUAL_INCOME_RANGE), "valid_annual_income"),
        Rule(
            "Monthly_Inhand_Salary",
            checks.within_or_null(*fixed.MONTHLY_SALARY_PLAUSIBLE),
            strategy=Strategy.QUARANTINE,
        ),
        Rule("Monthly_Inhand_Salary", checks.within(*fixed.MONTHLY_SALARY_RANGE), "valid_monthly_salary"),
        Rule(
            "Credit_Utilization_Ratio",
            checks.within(*fixed.CREDIT_UTILIZATION_RANGE),
            "valid_credit_utilization",
        ),
        Rule("Interest_Rate", checks.within(*fixed.INTEREST_RATE_RANGE), "valid_interest_rate"),
        Rule("Outstanding_Debt", checks.non_negative, "valid_Outstanding_Debt"),
        Rule("Monthly_Balance", checks.non_negative, "valid_Monthly_Balance"),
        Rule(
            "Total_EMI_per_month",
            checks.non_negative,
            "valid_Total_EMI_per_month",
            Strategy.DEFAULT_VALUE,
            0.0,
        ),
        Rule(
            "Amount_invested_monthly",
            checks.non_negative,
            "valid_Amount_invested_monthly",
            Strategy.DEFAULT_VALUE,
            0.0,
        ),
        Rule(
            "Payment_Behaviour",
            checks.one_of(fixed.PAYMENT_BEHAVIOURS),
            "valid_payment_behaviour",
            prepare=parsing.standardise,
        ),
        Rule(
            "Payment_of_Min_Amount",
            checks.one_of(fixed.MINIMUM_PAYMENT_ANSWERS),
            "valid_payment_of_min_amount",
            prepare=parsing.standardise,
        ),
        Rule("Credit_Mix", checks.one_of(fixed.CREDIT_MIXES), "valid_credit_mix", prepare=parsing.credit_mix),
        Rule(
            "Type_of_Loan",
            checks.names_a_loan_type,
            "valid_type_of_loan",
            prepare=parsing.loan_type_text,
        ),
    ),
    derive=_financials,
)

TABLES = {spec.name: spec for spec in (LOAN_DAILY, CLICKSTREAM, ATTRIBUTES, FINANCIALS)}
BY_SOURCE = {spec.source: spec for spec in TABLES.values()}
