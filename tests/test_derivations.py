"""Days past due, loan types, labels and encodings."""

import datetime as dt

import pytest

from creditmart.operators import derivations, encodings, labels


def dpd_rows(spark, rows):
    loans = spark.createDataFrame(
        [(i, 6, day, due, overdue) for i, (day, due, overdue) in enumerate(rows)],
        "i int, installment_num int, snapshot_date date, due_amt float, overdue_amt float",
    )
    return sorted(derivations.days_past_due(loans).collect())


@pytest.mark.parametrize(
    "due, overdue, missed",
    [
        (1000.0, 0.0, 0),
        (1000.0, 1.0, 1),
        (1000.0, 1000.0, 1),
        (1000.0, 2500.0, 3),
        (1000.0, -2500.0, -2),
        (0.0, 500.0, 0),
        (None, 5.0, 0),
        (5.0, None, 0),
        (0.1, 0.3, 4),  # single-precision amounts, divided in double precision
    ],
)
def test_installments_missed(spark, due, overdue, missed):
    (row,) = dpd_rows(spark, [(dt.date(2023, 7, 1), due, overdue)])
    assert row.installments_missed == missed
    assert row.mob == 6


def test_days_past_due(spark):
    cases = [
        (dt.date(2023, 3, 1), 100.0, 100.0),
        (dt.date(2024, 3, 1), 100.0, 100.0),
        (dt.date(2023, 4, 1), 100.0, 100.0),
        (dt.date(2023, 7, 1), 100.0, 300.0),
        (dt.date(2023, 7, 1), 100.0, 0.0),
    ]
    rows = dpd_rows(spark, cases)
    assert [r.dpd for r in rows] == [28, 29, 31, 91, 0]
    assert rows[3].first_missed_date == dt.date(2023, 4, 1)
    assert rows[4].first_missed_date is None


def test_absurd_amounts_are_unknown(spark):
    day = dt.date(2023, 7, 1)
    loans = spark.createDataFrame(
        [(6, day, 0.01, 1e30), (6, day, 0.1, 1e8), (6, day, 100.0, 100.0)],
        "installment_num int, snapshot_date date, due_amt float, overdue_amt float",
    )
    rows = derivations.days_past_due(loans).select("installments_missed", "first_missed_date", "dpd").collect()
    assert (rows[0].installments_missed, rows[0].first_missed_date, rows[0].dpd) == (None, None, None)
    assert (rows[1].first_missed_date, rows[1].dpd) == (None, None)
    assert (rows[2].installments_missed, rows[2].dpd) == (1, 30)


def test_vocabulary_and_indicators(spark):
    lists = [
        "Auto Loan, Payday Loan, and Credit-Builder Loan",
        "Payday Loan, Payday Loan",
        "Not Specified",
        None,
        "Personal Loan, and Credit Card",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, Type_of_Loan string")
    df = derivations.loan_types(df)
    counts = {r.loan_type: r.customers for r in derivations.loan_type_vocabulary(df).collect()}
    assert counts == {"Auto Loan": 1, "Payday Loan": 2, "Credit-Builder Loan": 1, "Personal Loan": 1}
    rows = derivations.loan_type_indicators(df, list(counts)).orderBy("i").collect()
    assert [r.has_payday_loan for r in rows] == [1, 1, 0, 0, 0]
    assert [r.has_credit_builder_loan for r in rows] == [1, 0, 0, 0, 0]
    assert [r.has_any_loan for r in rows] == [1, 1, 0, 0, 1]


def test_indicators_go_by_whole_words(spark):
    texts = [("Home Equity Loan",), ("Subequity Loan",), ("Some Loan (used)",), ("Pay`day Loan",)]
    df = derivations.loan_types(spark.createDataFrame(texts, "Type_of_Loan string"))
    named = ["equity Loan", "Equity Loan", "Some Loan (used)", "Pay`day Loan"]
    rows = derivations.loan_type_indicators(df, named).collect()
    assert [r.has_equity_loan for r in rows] == [1, 0, 0, 0]
    assert [r["has_some_loan_(used)"] for r in rows] == [0, 0, 1, 0]
    assert [r["has_pay`day_loan"] for r in rows] == [0, 0, 0, 1]


def test_any_number_of_loan_types(spark):
    df = derivations.loan_types(spark.range(1500).selectExpr("concat('Loan ', id) AS Type_of_Loan"))
    assert derivations.loan_type_vocabulary(df).count() == 1500


def test_labels(spark):
    loans = spark.createDataFrame(
        [("a", "c", 6, d, dt.date(2023, 7, 1)) for d in (0, 29, 30, 95, None)] + [("b", "c", 5, 95, dt.date(2023, 6, 1))],
        "loan_id string, Customer_ID string, mob int, dpd int, snapshot_date date",
    )
    rows = labels.label_loans(loans).collect()
    assert [r.label for r in rows] == [0, 0, 1, 1, 0]
    assert {r.label_def for r in rows} == {"30dpd_6mob"}
    sweep = labels.label_sweep(loans)
    assert sweep.count() == 15
    for dpd in (30, 60, 90):
        single = labels.label_loans(loans, dpd, 6)
        swept = sweep.where(sweep.label_def == f"{dpd}dpd_6mob")
        assert sorted(swept.collect()) == sorted(single.collect())


def test_time_split(spark):
    days = ["2022-12-01", "2023-01-01", "2023-09-01", "2023-10-01", "2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").selectExpr("CAST(d AS DATE) AS snapshot_date")
    names = [r.split for r in labels.time_split(df).collect()]
    assert names == [None, "train", "train", "validation", "validation", "test", "test", "oot"]


def test_encodings(spark):
    df = spark.createDataFrame(
        [
            ("LAWYER", "HIGH_SPENT_LARGE_VALUE_PAYMENTS", "YES", "GOOD"),
            ("WRITER", "!@9#%8", "NO", "STANDARD"),
            ("MEDIA_MANAGER", "LOW_SPENT_MEDIUM_VALUE_PAYMENTS", "NM", "BAD"),
            (None, None, None, None),
        ],
        "Occupation string, Payment_Behaviour string, Payment_of_Min_Amount string, Credit_Mix string",
    )
    df = encodings.credit_mix(encodings.minimum_payment(encodings.payment_behaviour(encodings.occupation_group(df))))
    rows = df.collect()
    assert [r.is_PMET for r in rows] == [1, 0, 1, 0]
    assert [(r.spending_level, r.value_size) for r in rows] == [(1, 2), (0, 0), (0, 1), (0, 0)]
    assert [(r.payment_min_yes, r.payment_min_nm) for r in rows] == [(1, 0), (0, 0), (0, 1), (0, 0)]
    assert [(r.credit_mix_good, r.credit_mix_standard, r.credit_mix_bad) for r in rows] == [
        (1, 0, 0),
        (0, 1, 0),
        (0, 0, 1),
        (0, 0, 0),
    ]
