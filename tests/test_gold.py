"""The feature store as a whole."""

import pytest
from pyspark.sql import functions as F

from creditmart.operators import labels, quality
from creditmart.plans import layers, queries
from creditmart.plans.specs import LOAN_DAILY, TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def features(spark):
    return queries.features(spark, SF, with_flags=True).cache()


def test_one_row_per_application(spark, features):
    applications = layers.applications(queries.loans(spark, SF))
    assert features.count() == applications.count()
    assert features.select("loan_id").distinct().count() == features.count()


def test_no_identifiers_and_no_audit_columns(spark):
    columns = queries.features(spark, SF).columns
    assert not {"Name", "SSN", "Credit_Mix", "Type_of_Loan", "Credit_History_Age"} & set(columns)
    assert not [c for c in columns if c.endswith("_original") or c.startswith("valid_")]
    assert len(set(columns)) == len(columns)


def test_months_on_book_chosen_early_are_those_of_silver(spark):
    """Whatever the installment number looks like, and with rows the rules drop."""
    texts = ["0", "_0", "0.9", " 0 ", "-0", "-.5", "0e0", "6", "6.", "$6", "16", "", "x", None]
    rows = [
        (f"LN{i}", customer, text, day)
        for i, text in enumerate(texts)
        for customer in ("CUS_0x1", "BAD", None)
        for day in ("2023-01-01", "1/2/23", "2031-01-01", "31/2/23", None)
    ]
    chosen = spark.createDataFrame(rows + rows[:40], "loan_id string, Customer_ID string, installment_num string, snapshot_date string")
    empty = LOAN_DAILY.empty_raw(spark)
    raw = empty.unionByName(chosen, allowMissingColumns=True)
    silver = layers.silver(LOAN_DAILY, raw, queries.AS_OF)
    for mobs in ([0], [6], [0, 6]):
        wanted = sorted(map(str, silver.where(F.col("mob").isin(mobs)).collect()))
        assert sorted(map(str, layers.loans_on_book(raw, mobs, queries.AS_OF).collect())) == wanted != []
    at_0 = layers.shared_applications(layers.loans_on_book(raw, [0], queries.AS_OF))
    assert sorted(map(str, at_0.collect())) == sorted(map(str, layers.applications(silver).collect()))


def test_repeated_applications_collapse(spark):
    loans = queries.loans(spark, SF)
    twice = layers.applications(loans.unionByName(loans))
    assert twice.count() == layers.applications(loans).count()


def test_nothing_from_the_future(spark):
    """Later snapshots of the sources change nothing for earlier applications."""
    loans, financials = queries.loans(spark, SF), queries.financials(spark, SF)
    attributes, clicks = queries.attributes(spark, SF), queries.clickstream(spark, SF)
    cut = "snapshot_date <= DATE '2022-06-01'"
    full = layers.feature_store(loans, attributes, financials, clicks)
    past = layers.feature_store(loans, attributes.where(cut), financials.where(cut), clicks.where(cut))
    assert sorted(map(str, full.where(cut).collect())) == sorted(map(str, past.where(cut).collect()))


def test_month_by_month_equals_all_at_once(spark):
    loans, financials = queries.loans(spark, SF), queries.financials(spark, SF)
    attributes, clicks = queries.attributes(spark, SF), queries.clickstream(spark, SF)
    month = "snapshot_date = DATE '2022-06-01'"
    full = layers.feature_store(loans, attributes, financials, clicks).where(month)
    single = layers.feature_store(loans.where(month), attributes, financials, clicks)
    assert full.count() > 0
    assert sorted(map(str, full.collect())) == sorted(map(str, single.collect()))


def test_missing_sources_leave_null_features(spark):
    loans = queries.loans(spark, SF)
    empty = {name: layers.silver(spec, spec.empty_raw(spark), queries.AS_OF) for name, spec in TABLES.items()}
    features = layers.feature_store(loans, empty["attributes"], empty["financials"], empty["clickstream"])
    assert features.count() == layers.applications(loans).count()
    row = features.first()
    assert (row.Age, row.Annual_Income, row.avg_fe_1_last_6m, row.clickstream_snapshot_count) == (None, None, None, 0)


def test_undated_source_joins_on_the_customer(spark):
    loans, clicks = queries.loans(spark, SF), queries.clickstream(spark, SF)
    attributes = queries.attributes(spark, SF).drop("snapshot_date", "valid_snapshot_date")
    sources = (loans, attributes, queries.financials(spark, SF), clicks)
    features = layers.feature_store(*sources)
    assert features.where("Occupation = 'LAWYER'").count() > 0
    applications = layers.applications(loans)
    matched = applications.join(attributes, "Customer_ID", "left_semi").count()
    assert features.count() == applications.count()
    # one row each, and that one of the customer's own
    of_customer = attributes.select("Customer_ID", F.col("Age").alias("_age"), F.col("Occupation").alias("_occupation"))
    same = F.col("Age").eqNullSafe(F.col("_age")) & F.col("Occupation").eqNullSafe(F.col("_occupation"))
    own = features.withColumnRenamed("Customer_ID", "_id").join(of_customer, same & (F.col("_id") == F.col("Customer_ID")), "left_semi")
    assert own.count() == matched > 0
    every = layers.feature_store(*sources, every_undated_row=True)
    expected = applications.join(attributes.select("Customer_ID", "Age"), "Customer_ID", "left")
    assert every.count() == expected.count() > features.count()
    assert every.where("Age IS NOT NULL").count() == expected.where("Age IS NOT NULL").count()


def test_training_set_pairs_a_loan_with_its_own_outcome(spark, features):
    outcome = labels.label_loans(queries.loans(spark, SF))
    rows = labels.training_set(features, outcome)
    assert rows.count() == features.join(outcome, "loan_id", "left_semi").count()
    assert rows.where("mob <> 0 OR months_between(label_snapshot_date, snapshot_date) <> 6").count() == 0


def test_high_quality(spark, features):
    flags = ["financials_valid_customer_id", "valid_annual_income", "valid_credit_mix"]
    good = quality.high_quality(features, flags)
    assert 0 < good.count() < features.count()
    assert good.where("Annual_Income < 10000").count() == 0


def test_counts_add_up(spark):
    for row in queries.QUERIES["retention_report"](spark, SF).collect():
        assert row.rows_in == row.rows_kept + row.rows_dropped + row.rows_quarantined


def test_quality_report_counts_unknown_values(spark):
    df = spark.createDataFrame([("d", True), ("d", False), ("d", None), ("e", None)], "day string, valid_x boolean")
    rows = {r.day: r for r in quality.quality_report(df, "t", "day").collect()}
    d, e = rows["d"], rows["e"]
    assert (d.source, d.flag, d.rows_valid, d.rows_invalid, d.rows_unknown, d.share_valid) == ("t", "valid_x", 1, 1, 1, 0.5)
    assert (e.rows_valid, e.rows_unknown, e.share_valid) == (0, 1, None)
