"""Text to value: expected results per input, and agreement with plain casts."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from creditmart.functions import checks, parsing


def parse(spark, expression, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    rows = df.selectExpr("i", f"{expression} AS v").collect()
    return [row.v for row in sorted(rows)]


@pytest.mark.parametrize(
    "text, value",
    [
        ("_50000", 50000.0),
        ("50,000", 50000.0),
        ("$50000", 50000.0),
        ("28.9", 28.899999618530273),
        ("-500", -500.0),
        ("__-333333333333333333333333333__", -3.3333332949471825e26),
        ("1e3", 1000.0),
        ("-Infinity", float("-inf")),
        ("+inf", float("inf")),
        ("!@9#%8", None),
        ("_", None),
        ("", None),
        (None, None),
    ],
)
def test_float(spark, text, value):
    assert parse(spark, parsing.to_float("x"), [text]) == [value]


def test_int(spark):
    cases = {
        "28_": 28,
        "28.9": 28,
        "-500": -500,
        "-0.5": 0,
        ".5": 0,
        "5.": 5,
        "2147483647.9": 2147483647,
        "1e3": None,
        "3000000000": None,
        "1.2.3": None,
        "_": None,
        "": None,
        None: None,
    }
    assert parse(spark, parsing.to_int("x"), list(cases)) == list(cases.values())


def test_date(spark):
    cases = {
        "1/5/23": dt.date(2023, 5, 1),
        "01/05/23": dt.date(2023, 5, 1),
        "2023-01-01": dt.date(2023, 1, 1),
        "2023-01-01T10/2": dt.date(2023, 1, 1),
        "2023-1-5": dt.date(2023, 1, 5),
        "001/5/23": dt.date(2023, 5, 1),
        "29/2/24": dt.date(2024, 2, 29),
        "31/2/23": None,
        "0/1/23": None,
        "1/5/23\n": None,
        "2023-02-30": None,
        "1/5/2023": None,
        "soon": None,
        None: None,
    }
    assert parse(spark, parsing.to_date("x"), list(cases)) == list(cases.values())


def test_history_months(spark):
    cases = {
        "10 Years and 9 Months": 129,
        "1 Year and 1 Month": 13,
        "5 Months": 5,
        "10 Years": 120,
        "NA": 0,
        "60 Years and 0 Months": 720,
        "999999999 Years": None,
        None: None,
    }
    assert parse(spark, parsing.history_months("x"), list(cases)) == list(cases.values())


def test_loan_types(spark):
    cases = {
        "Auto Loan, Payday Loan, and Credit-Builder Loan": ["Auto Loan", "Payday Loan", "Credit-Builder Loan"],
        "Payday Loan, Payday Loan": ["Payday Loan"],
        "Personal Loan, and Credit Card": ["Personal Loan"],
        "Not Specified": [],
        None: None,
    }
    assert parse(spark, parsing.loan_types("x"), list(cases)) == list(cases.values())


def test_loan_type_text(spark):
    cases = {"": None, "  ": "", " A Loan ": "A Loan", None: None}
    assert parse(spark, parsing.loan_type_text("x"), list(cases)) == list(cases.values())


def test_not_a_number_passes_as_a_positive_amount(spark):
    (value,) = parse(spark, parsing.to_float("x"), ["NaN"])
    assert value != value
    assert parse(spark, checks.positive(parsing.to_float("x")), ["NaN", "n/a"]) == [True, False]


SPECIAL = st.sampled_from(["inf", "+Infinity", "-INF", "infinity", "1f", "1d", "0x1p3", "i", "na"])
NUMBER_LIKE = st.text(alphabet="0123456789+-._, $eE", max_size=12) | SPECIAL
DATE_LIKE = st.text(alphabet="0123456789/- T", max_size=12) | st.dates(
    dt.date(2000, 1, 1), dt.date(2099, 12, 31)
).map(lambda d: f"{d.day}/{d.month}/{d.year % 100:02}")
QUIET = settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@QUIET
@given(st.lists(NUMBER_LIKE, min_size=150, max_size=150))
def test_numbers_agree_with_lenient_casts(spark, texts):
    stripped = r"regexp_replace(x, '[_,$\\s]', '')"
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        ints = parse(spark, f"CAST({stripped} AS INT)", texts)
        floats = parse(spark, f"CAST({stripped} AS FLOAT)", texts)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert parse(spark, parsing.to_int("x"), texts) == ints
    assert parse(spark, parsing.to_float("x"), texts) == floats


@QUIET
@given(st.lists(DATE_LIKE, min_size=150, max_size=150))
def test_dates_agree_with_lenient_parsing(spark, texts):
    lenient = "CAST(coalesce(to_date(x, 'd/M/yy'), to_date(x, 'yyyy-MM-dd'), to_date(x)) AS STRING)"
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        expected = parse(spark, lenient, texts)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert parse(spark, f"CAST({parsing.to_date('x')} AS STRING)", texts) == expected
