"""The job over small CSV extracts: layers, re-runs, odd inputs."""

import csv
import datetime as dt
import os

import pytest

from creditmart.plans import job, layers
from creditmart.plans.specs import TABLES
from creditmart.sources import extracts, tables

AS_OF = dt.date(2024, 12, 31)
JANUARY, JULY, AUGUST = dt.date(2023, 1, 1), dt.date(2023, 7, 1), dt.date(2023, 8, 1)


def write_csv(folder, source, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{source}.csv", "w", newline="") as file:
        writer = csv.DictWriter(file, fieldnames=list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)


def loan(number, customer, start_month, overdue_at=None, months=8):
    rows = []
    for mob in range(months):
        overdue = 100 if overdue_at is not None and mob >= overdue_at else 0
        month = start_month + mob
        rows.append(
            dict(
                loan_id=f"LN{number}",
                Customer_ID=customer,
                loan_start_date=f"2023-{start_month:02}-01",
                tenure="10",
                installment_num=str(mob),
                loan_amt="$1,000",
                due_amt="0" if mob == 0 else "100",
                paid_amt="100",
                overdue_amt=str(overdue),
                balance=str(1000 - 100 * mob),
                snapshot_date=f"1/{month}/23" if mob % 2 else f"2023-{month:02}-01",
            )
        )
    return rows


def defaults(spec_name, **values):
    return {c: "1" for c in TABLES[spec_name].types} | values


def attribute(customer, day, age):
    return defaults("attributes", Customer_ID=customer, Age=age, Occupation=" Lawyer", snapshot_date=day)


def financial(customer, day, **values):
    valid = dict(Annual_Income="50000_", Monthly_Inhand_Salary="4000", Credit_Mix="Good", Type_of_Loan="Auto Loan")
    return defaults("financials", Customer_ID=customer, snapshot_date=day, **(valid | values))


def click(customer, day, value):
    return defaults("clickstream", Customer_ID=customer, snapshot_date=day, fe_1=value)


LOANS = loan(1, "CUS_0x1", 1) + loan(2, "CUS_0x2", 1, overdue_at=6) + loan(3, "bad", 1)
RAW = {
    "lms_loan_daily": LOANS,
    "features_attributes": [attribute("CUS_0x1", "2023-01-01", "30_"), attribute("CUS_0x2", "2023-03-01", "40")],
    "features_financials": [
        financial("CUS_0x1", "2023-01-01"),
        financial("CUS_0x2", "2023-01-01", Annual_Income="500"),
    ],
    "feature_clickstream": [click("CUS_0x1", "2023-01-01", "4"), click("CUS_0x1", "1/2/23", "9")],
    "branches": [{"branch": "north"}, {"branch": "south"}],
}


@pytest.fixture
def raw(tmp_path):
    folder = str(tmp_path / "raw")
    for source, rows in RAW.items():
        write_csv(folder, source, rows)
    return folder


def run(spark, raw, tmp_path, **settings):
    defaults = dict(run_id="r", first=JANUARY, last=AUGUST, as_of=AS_OF)
    return job.run(spark, raw, str(tmp_path / "mart"), **(defaults | settings))


def content(df):
    return sorted(map(str, df.collect()))


def test_all_layers(spark, raw, tmp_path):
    done = run(spark, raw, tmp_path)
    labels = {r.loan_id: (r.label, r.label_def, r.snapshot_date) for r in done.label_store().collect()}
    assert labels == {"LN1": (0, "30dpd_6mob", JULY), "LN2": (1, "30dpd_6mob", JULY)}
    features = {r.loan_id: r for r in done.feature_store().collect()}
    assert set(features) == {"LN1", "LN2"}
    one, two = features["LN1"], features["LN2"]
    assert (one.Age, one.is_PMET, one.Annual_Income, one.has_auto_loan, one.credit_mix_good) == (30, 1, 50000.0, 1, 1)
    # the click of February and the attributes of March come after the application
    assert (one.avg_fe_1_last_6m, one.clickstream_snapshot_count) == (4.0, 1)
    assert (two.Age, two.Annual_Income, two.clickstream_snapshot_count) == (None, None, 0)
    assert one.feature_snapshot_date == "2023-01-01"
    rows = done.rows
    assert (rows["silver.loan_daily.in"], rows["silver.loan_daily.dropped"], rows["silver.loan_daily"]) == (24, 8, 16)
    assert (rows["silver.financials.quarantined"], rows["silver.financials"]) == (1, 1)
    quarantine = spark.read.parquet(done.path("quarantine")).collect()
    assert [(r.source, r.rule, r.Customer_ID) for r in quarantine] == [("financials", "Annual_Income", "CUS_0x2")]
    assert spark.read.parquet(done.path("bronze", "branches")).count() == 2


def test_running_again_changes_nothing(spark, raw, tmp_path):
    first = run(spark, raw, tmp_path)
    before = content(first.feature_store()), content(first.label_store()), content(spark.read.parquet(first.path("quarantine")))
    again = run(spark, raw, tmp_path)
    after = content(again.feature_store()), content(again.label_store()), content(spark.read.parquet(again.path("quarantine")))
    assert before == after
    assert again.rows == first.rows


def test_layers_one_by_one_and_month_ranges(spark, raw, tmp_path):
    whole = run(spark, raw, tmp_path)
    for layer in job.LAYERS:
        for first, last in ((JANUARY, JULY), (AUGUST, AUGUST)):
            parts = run(spark, raw, tmp_path, run_id="parts", only=[layer], first=first, last=last)
    assert content(parts.feature_store()) == content(whole.feature_store())
    assert content(parts.label_store()) == content(whole.label_store())
    for table in TABLES.values():
        assert content(parts.silver_table(table)) == content(whole.silver_table(table))


def test_corrected_extract_replaces_its_months(spark, raw, tmp_path):
    """Rows that are gone from an extract are gone from every table; other months stay."""
    run(spark, raw, tmp_path)
    write_csv(raw, "features_financials", [financial("CUS_0x2", "2023-02-01", Annual_Income="60000")])
    write_csv(raw, "lms_loan_daily", [r for r in LOANS if r["loan_id"] == "LN1" and r["snapshot_date"] != "2023-07-01"])
    again = run(spark, raw, tmp_path)
    assert tables.partition_values(spark, again.path("quarantine"), ["source", "rule", "period"]) == []
    financials = again.silver_table(TABLES["financials"]).collect()
    assert [(r.Customer_ID, r.Annual_Income) for r in financials] == [("CUS_0x2", 60000.0)]
    assert again.label_store().collect() == []
    assert [r.loan_id for r in again.feature_store().collect()] == ["LN1"]


def test_new_loan_types_join_the_vocabulary(spark, raw, tmp_path):
    run(spark, raw, tmp_path)
    write_csv(raw, "features_financials", [financial("CUS_0x2", "2023-02-01", Type_of_Loan="Student Loan")])
    later = run(spark, raw, tmp_path, first=dt.date(2023, 2, 1), last=dt.date(2023, 2, 1))
    assert {r.loan_type for r in later.vocabulary().collect()} == {"Auto Loan", "Student Loan"}
    rows = {r.Customer_ID: r for r in later.silver_table(TABLES["financials"]).collect()}
    assert (rows["CUS_0x1"].has_auto_loan, rows["CUS_0x1"].has_student_loan) == (1, 0)
    assert (rows["CUS_0x2"].has_auto_loan, rows["CUS_0x2"].has_student_loan) == (0, 1)


def test_missing_sources(spark, raw, tmp_path):
    for source in ("features_attributes", "features_financials", "feature_clickstream"):
        os.remove(f"{raw}/{source}.csv")
    done = run(spark, raw, tmp_path)
    rows = done.feature_store().collect()
    assert len(rows) == 2 and all(r.Age is None and r.clickstream_snapshot_count == 0 for r in rows)
    os.remove(f"{raw}/lms_loan_daily.csv")
    with pytest.raises(FileNotFoundError, match="loans"):
        run(spark, raw, tmp_path, run_id="other")
    with pytest.raises(FileNotFoundError, match="loans"):
        run(spark, raw, tmp_path, run_id="third", only=["gold"])


def test_source_without_dates(spark, raw, tmp_path):
    undated = [{k: v for k, v in r.items() if k != "snapshot_date"} for r in RAW["features_attributes"]]
    write_csv(raw, "features_attributes", undated)
    done = run(spark, raw, tmp_path)
    assert {r.loan_id: r.Age for r in done.feature_store().collect()} == {"LN1": 30, "LN2": 40}


def test_month_by_month_gives_the_same_loan_types(spark, raw, tmp_path):
    first = financial("CUS_0x1", "2023-01-01", Type_of_Loan="Second Home Loan")
    second = financial("CUS_0x2", "2023-02-01", Type_of_Loan="Home Loan")
    write_csv(raw, "features_financials", [first, second])
    settings = dict(loan_types=["Home Loan"])
    whole = run(spark, raw, tmp_path, **settings)
    for month in (JANUARY, dt.date(2023, 2, 1)):
        parts = run(spark, raw, tmp_path, run_id="parts", first=month, last=month, **settings)
    for done in (whole, parts):
        rows = {r.Customer_ID: r.has_home_loan for r in done.silver_table(TABLES["financials"]).collect()}
        assert rows == {"CUS_0x1": 1, "CUS_0x2": 1}


def test_undated_source_month_by_month(spark, raw, tmp_path):
    undated = [{k: v for k, v in r.items() if k != "snapshot_date"} for r in RAW["features_attributes"]]
    write_csv(raw, "features_attributes", undated + undated[:1])
    write_csv(raw, "lms_loan_daily", loan(1, "CUS_0x1", 1) + loan(2, "CUS_0x2", 2))
    whole = run(spark, raw, tmp_path)
    for month in (JANUARY, dt.date(2023, 2, 1)):
        parts = run(spark, raw, tmp_path, run_id="parts", first=month, last=month)
    assert sorted(r.loan_id for r in parts.feature_store().collect()) == ["LN1", "LN2"]
    assert content(parts.feature_store()) == content(whole.feature_store())


def test_all_months_by_default(spark, raw, tmp_path):
    done = run(spark, raw, tmp_path, first=None, last=None)
    assert done.rows["bronze.lms_loan_daily"] == len(LOANS)
    assert {r.loan_id for r in done.feature_store().collect()} == {"LN1", "LN2"}


def test_colliding_columns_are_kept(spark, raw, tmp_path):
    write_csv(raw, "features_attributes", [{**r, "note": "a"} for r in RAW["features_attributes"]])
    write_csv(raw, "features_financials", [{**r, "note": "f"} for r in RAW["features_financials"]])
    for name in ("features_attributes", "features_financials"):
        assert "note" in extracts.read_extract(spark, f"{raw}/{name}.csv").columns
    done = run(spark, raw, tmp_path)
    attributes, financials = (spark.read.parquet(done.path("silver", t)) for t in ("attributes", "financials"))
    loans = done.silver_table(TABLES["loan_daily"])
    clicks = done.silver_table(TABLES["clickstream"])
    frames = [frame.drop("period") for frame in (loans, attributes, financials, clicks)]
    row = layers.feature_store(*frames).where("loan_id = 'LN1'").first()
    assert (row.note, row.financials_note) == ("a", "f")


def test_many_partitions_take_one_observation(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(500).selectExpr("id", "CAST(id AS STRING) AS d")
    assert tables.replace_partitions(df, path, ["d"], lambda p: True) == 500
    assert tables.replace_partitions(df.where("id < 3"), path, ["d"], lambda p: True) == 3
    assert len(tables.partition_values(spark, path, ["d"])) == 3


def test_extra_and_missing_columns(spark, raw, tmp_path):
    rows = [{**{k: v for k, v in r.items() if k != "SSN"}, "note": "x"} for r in RAW["features_attributes"]]
    write_csv(raw, "features_attributes", rows)
    done = run(spark, raw, tmp_path)
    stored = spark.read.parquet(done.path("silver", "attributes"))
    assert "valid_ssn" not in stored.columns and {r.note for r in stored.collect()} == {"x"}
    assert done.silver_table(TABLES["attributes"]).where("valid_ssn IS NULL").count() == 2


def test_off_calendar_rows_stay_out(spark, raw, tmp_path):
    write_csv(raw, "feature_clickstream", [click("CUS_0x1", d, "1") for d in ("2023-01-15", "2022-12-01", "junk", "2023-02-01")])
    done = run(spark, raw, tmp_path, only=["bronze"])
    assert done.rows["bronze.feature_clickstream"] == 1
    assert done.rows["bronze.feature_clickstream.left_out"] == 3


def test_parameters(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="run_id"):
        job.run(spark, raw, str(tmp_path / "mart"), only=["silver"])
    with pytest.raises(ValueError, match="unknown"):
        job.run(spark, raw, str(tmp_path / "mart"), only=["platinum"])
    done = job.run(spark, raw, str(tmp_path / "mart"), only=["bronze"])
    dt.datetime.strptime(done.run_id, "%Y%m%d_%H%M%S")


def test_discovery(spark, raw):
    found = extracts.discover(spark, raw)
    assert set(found) == set(RAW)
    assert extracts.bronze_folder("lms_loan_daily") == "lms"
    assert extracts.bronze_folder("branches") == "branches"
    assert extracts.read_extract(spark, found["branches"]).dtypes == [("branch", "string")]
