"""Checks, strategies and row outcomes."""

import datetime as dt

import pytest

from creditmart import fixed_values as fixed
from creditmart.functions import checks, parsing
from creditmart.operators.validation import (
    OUTCOME,
    Rule,
    Strategy,
    apply_rules,
    kept_rows,
    quarantined_rows,
    type_columns,
)
from creditmart.plans import layers
from creditmart.plans.specs import ATTRIBUTES, CLICKSTREAM, FINANCIALS, LOAN_DAILY

AS_OF = dt.date(2024, 12, 31)
FINANCIAL_COLUMNS = list(FINANCIALS.types)


def check(spark, test, sql_type, items):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {sql_type}")
    return [row.v for row in sorted(df.selectExpr("i", f"{test('x')} AS v").collect())]


def test_customer_id(spark):
    ids = ["CUS_0x1a", "CUS_0xZZ", " CUS_0x1a", "cus_0x1a", None]
    assert check(spark, checks.matches(fixed.CUSTOMER_ID_PATTERN), "string", ids) == [True, False, False, False, None]


def test_ssn(spark):
    numbers = ["123-45-6789", "123-45-678", "#F%$D@*&8", None]
    assert check(spark, checks.matches(fixed.SSN_PATTERN), "string", numbers) == [True, False, False, None]


def test_snapshot_range(spark):
    days = [dt.date(2019, 12, 31), dt.date(2020, 1, 1), AS_OF, AS_OF + dt.timedelta(1), None]
    assert check(spark, checks.snapshot_in_range(AS_OF), "date", days) == [False, True, True, False, False]
    # without a day the check goes by today
    today = [dt.date.today() - dt.timedelta(2), dt.date.today() + dt.timedelta(2)]
    assert check(spark, checks.snapshot_in_range(None), "date", today) == [True, False]


def test_amounts(spark):
    amounts = [1.0, 0.0, -1.0, None]
    assert check(spark, checks.positive, "float", amounts) == [True, False, False, False]
    assert check(spark, checks.non_negative, "float", amounts) == [True, True, False, False]


def test_categories(spark):
    answers = ["Yes", " no ", "NM", None]
    prepared = lambda v: checks.one_of(fixed.MINIMUM_PAYMENT_ANSWERS)(parsing.standardise(v))
    assert check(spark, prepared, "string", answers) == [True, True, False, False]


@pytest.mark.parametrize(
    "strategy, kept",
    [
        (Strategy.DROP_ROW, [(1, 5)]),
        (Strategy.QUARANTINE, [(1, 5)]),
        (Strategy.FLAG_ONLY, [(1, 5), (2, -1), (3, None)]),
        (Strategy.DEFAULT_VALUE, [(1, 5), (2, 7), (3, 7)]),
        (Strategy.NULL_VALUE, [(1, 5), (2, None), (3, None)]),
    ],
)
def test_strategies(spark, strategy, kept):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "i int, x int")
    # a bare comparison: null for null, which counts as invalid
    flagged = apply_rules(df, [Rule("x", lambda v: f"{v} >= 0", "valid_x", strategy, 7)])
    rows = kept_rows(flagged)
    assert sorted((r.i, r.x) for r in rows.collect()) == kept
    assert rows.schema["x"].dataType.simpleString() == "int"
    quarantined = quarantined_rows(flagged, "t").collect()
    if strategy is Strategy.QUARANTINE:
        assert sorted((r.i, r.source, r.rule) for r in quarantined) == [(2, "t", "x"), (3, "t", "x")]
    else:
        assert quarantined == []


def test_default_without_value_changes_nothing(spark):
    df = spark.createDataFrame([(-1,)], "x int")
    rule = Rule("x", checks.non_negative, "valid_x", Strategy.DEFAULT_VALUE)
    assert kept_rows(apply_rules(df, [rule])).collect() == [(-1, False)]


def test_types_skip_missing_and_pass_extra_columns(spark):
    df = spark.createDataFrame([("_7", "free", "1/5/23")], "Age string, note string, snapshot_date string")
    row = type_columns(df, ATTRIBUTES.types).first().asDict()
    assert row == {"Age": 7, "note": "free", "snapshot_date": dt.date(2023, 5, 1), "Age_original": "_7"}


def financials(spark, **columns):
    """Financial rows that are valid but for the columns given."""
    valid = {c: "1" for c in FINANCIAL_COLUMNS} | {
        "Annual_Income": "50000",
        "Monthly_Inhand_Salary": "5000",
        "Credit_Mix": "Good",
        "Payment_of_Min_Amount": "Yes",
        "Payment_Behaviour": "Low_spent_Small_value_payments",
        "Credit_History_Age": "5 Years",
        "snapshot_date": "2023-01-01",
    }
    size = len(next(iter(columns.values())))
    rows = [
        [f"CUS_0x{i}" if c == "Customer_ID" else columns[c][i] if c in columns else valid[c] for c in FINANCIAL_COLUMNS]
        for i in range(size)
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in FINANCIAL_COLUMNS))


def test_income_outcomes(spark):
    raw = financials(
        spark,
        Annual_Income=["500", "24000000", "5000", None, "10000", "500", "50000"],
        Monthly_Inhand_Salary=["5000", "5000", "500", None, "1000", "50", "50"],
    )
    rows = sorted(layers.flagged(FINANCIALS, raw, AS_OF).collect(), key=lambda r: r.Customer_ID)
    assert [(r[OUTCOME], r.valid_annual_income, r.valid_monthly_salary) for r in rows] == [
        ("quarantined:Annual_Income", False, True),
        ("quarantined:Annual_Income", False, True),
        ("kept", False, False),
        ("kept", False, False),
        ("kept", True, True),
        # a row bad in both goes by the first rule only
        ("quarantined:Annual_Income", False, False),
        ("quarantined:Monthly_Inhand_Salary", True, False),
    ]


def test_financial_values(spark):
    raw = financials(
        spark,
        Total_EMI_per_month=[None, "10"],
        Outstanding_Debt=["-10", "0"],
        Credit_Mix=["_", " standard "],
        Payment_of_Min_Amount=["NM", "No"],
        Credit_Utilization_Ratio=["32.5", "0.5"],
        Interest_Rate=["100", "101"],
        Type_of_Loan=["", " Not Specified, Student Loan "],
        Credit_History_Age=["NA", "60 Years and 0 Months"],
    )
    bad, good = sorted(layers.silver(FINANCIALS, raw, AS_OF).collect(), key=lambda r: r.Customer_ID)
    assert (bad.Total_EMI_per_month, bad.valid_Total_EMI_per_month) == (0.0, False)
    assert (good.Total_EMI_per_month, good.valid_Total_EMI_per_month) == (10.0, True)
    assert (bad.Outstanding_Debt, bad.valid_Outstanding_Debt) == (-10.0, False)
    assert (bad.Credit_Mix, bad.valid_credit_mix, good.Credit_Mix, good.valid_credit_mix) == (None, False, "STANDARD", True)
    assert (bad.valid_payment_of_min_amount, good.valid_payment_of_min_amount) == (False, True)
    assert (bad.valid_credit_utilization, good.valid_credit_utilization) == (False, True)
    assert (bad.valid_interest_rate, good.valid_interest_rate) == (True, False)
    assert (bad.Type_of_Loan, bad.valid_type_of_loan, bad.has_any_loan) == (None, False, 0)
    assert (good.Type_of_Loan, good.valid_type_of_loan, good.has_any_loan) == ("Not Specified, Student Loan", True, 1)
    assert (bad.Credit_History_Age_Months, bad.valid_credit_history_age) == (0, True)
    assert (good.Credit_History_Age_Months, good.valid_credit_history_age) == (720, False)


def test_ages(spark):
    ages = ["-500", "8698", "120", "17", "18", "100", None]
    raw = spark.createDataFrame(
        [("CUS_0x1", "n", a, "1", " Lawyer", "2023-01-01") for a in ages],
        "Customer_ID string, Name string, Age string, SSN string, Occupation string, snapshot_date string",
    )
    rows = layers.silver(ATTRIBUTES, raw.coalesce(1), AS_OF).collect()
    assert [(r.valid_age, r.Age_capped) for r in rows] == [
        (False, 18),
        (False, 65),
        (False, 120),
        (False, 17),
        (True, 18),
        (True, 100),
        (False, None),
    ]
    assert {r.Occupation for r in rows} == {"LAWYER"}


def test_clickstream_defaults_and_null_dates(spark):
    columns = list(CLICKSTREAM.types)
    row = {c: "3" for c in columns} | {
        "Customer_ID": None,
        "snapshot_date": "2025-01-01",
        "fe_1": "-4",
        "fe_2": None,
        "fe_3": "junk",
    }
    raw = spark.createDataFrame([[row[c] for c in columns]], ", ".join(f"{c} string" for c in columns))
    clicks = layers.silver(CLICKSTREAM, raw, AS_OF).first()
    assert (clicks.fe_1, clicks.fe_2, clicks.fe_3, clicks.fe_4) == (0, 0, 0, 3)
    assert (clicks.valid_fe_1, clicks.valid_fe_4) == (False, True)
    assert (clicks.snapshot_date, clicks.valid_snapshot_date, clicks.valid_customer_id) == (None, False, None)


def test_loans_drop_bad_ids_and_dates(spark):
    columns = list(LOAN_DAILY.types)

    def loan(customer, day):
        return [{"Customer_ID": customer, "snapshot_date": day}.get(c, "1") for c in columns]

    raw = spark.createDataFrame(
        [loan("CUS_0x1", "2023-01-01"), loan(None, "2023-01-01"), loan("BAD", "2023-01-01"), loan("CUS_0x2", "x")],
        ", ".join(f"{c} string" for c in columns),
    )
    flagged = layers.flagged(LOAN_DAILY, raw, AS_OF)
    assert [r[OUTCOME] for r in flagged.collect()] == [
        "kept",
        "dropped:Customer_ID",
        "dropped:Customer_ID",
        "dropped:snapshot_date",
    ]
