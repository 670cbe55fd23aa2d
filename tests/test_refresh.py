"""Increments, publications, the stored vocabulary, malformed lines and metrics."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from creditmart.operators import changes, metrics, quality
from creditmart.plans import job, layers, manifest, vocabulary
from creditmart.plans.specs import FINANCIALS, TABLES
from creditmart.sources import extracts, files, publication, tables
from creditmart.sources.publication import Publication
from test_job import AS_OF, LOANS, RAW, attribute, click, content, financial, loan, write_csv

DAYS = [dt.date(2023, m, 1).isoformat() for m in range(1, 9)]
# loans that start in every month from January to August, of two customers
MORE_LOANS = [row for k in range(8) for row in loan(10 + k, f"CUS_0x{1 + k % 2}", 1 + k, months=3)]


@pytest.fixture
def raw(tmp_path):
    folder = str(tmp_path / "raw")
    sources = RAW | {
        "lms_loan_daily": MORE_LOANS,
        "features_attributes": [attribute(c, f"2023-0{m}-01", str(20 + m)) for m in (1, 4) for c in ("CUS_0x1", "CUS_0x2")],
    }
    for source, rows in sources.items():
        write_csv(folder, source, rows)
    return folder


def refreshed(spark, raw, tmp_path, run_id="r"):
    return job.refresh(spark, raw, str(tmp_path / "mart"), run_id, as_of=AS_OF)


def tables_of(done):
    frames = [done.label_store(), done.feature_store(), *(done.silver_table(spec) for spec in TABLES.values())]
    return [content(frame) for frame in frames]


def written_at(spark, done, table, column):
    path = done.path(*table)
    return {v[column]: files.parts(spark, publication.folder(path, v)) for v in tables.partition_values(spark, path, [column])}


def test_a_changed_file_touches_its_dependents_only(spark, raw, tmp_path):
    done = refreshed(spark, raw, tmp_path)
    assert done.rewritten["gold.feature_store"] == sorted(done.rewritten["silver.loan_daily"])
    before = written_at(spark, done, ("gold", "feature_store"), "feature_snapshot_date")
    silver_before = written_at(spark, done, ("silver", "attributes"), "period")

    # one customer's attributes of January change; the customer's next ones are of April
    changed = [attribute("CUS_0x1", "2023-01-01", "55")] + [r for r in attributes(raw) if (r["Customer_ID"], r["snapshot_date"]) != ("CUS_0x1", "2023-01-01")]
    write_csv(raw, "features_attributes", changed)
    again = refreshed(spark, raw, tmp_path)
    assert again.rewritten == {
        "bronze.features_attributes": ["2023-01-01"],
        "silver.attributes": ["2023-01-01"],
        "gold.label_store": [],
        # loans of this customer start in January, March, May and July
        "gold.feature_store": ["2023-01-01", "2023-03-01"],
    }
    after = written_at(spark, again, ("gold", "feature_store"), "feature_snapshot_date")
    assert {m for m in before if before[m] != after[m]} == {"2023-01-01", "2023-03-01"}
    silver_after = written_at(spark, again, ("silver", "attributes"), "period")
    assert silver_before["2023-04-01"] == silver_after["2023-04-01"]
    ages = {r.loan_id: r.Age for r in again.feature_store().collect()}
    assert (ages["LN10"], ages["LN11"], ages["LN12"], ages["LN14"]) == (55, 21, 55, 24)
    whole = refreshed(spark, raw, tmp_path, "whole")
    assert tables_of(again) == tables_of(whole)
    # nothing changed, nothing is written
    assert refreshed(spark, raw, tmp_path).rewritten == {}


def attributes(raw):
    import csv

    with open(f"{raw}/features_attributes.csv") as file:
        return list(csv.DictReader(file))


def test_clicks_loans_and_lost_refreshes(spark, raw, tmp_path, monkeypatch):
    refreshed(spark, raw, tmp_path)
    write_csv(raw, "feature_clickstream", [click("CUS_0x1", "2023-01-01", "4"), click("CUS_0x1", "1/2/23", "10")])
    write_csv(raw, "lms_loan_daily", [r for r in MORE_LOANS if r["loan_id"] != "LN17"])

    def lost(self, pending):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(job.Run, "_refresh_gold", lost)
        with pytest.raises(OSError, match="lost"):
            refreshed(spark, raw, tmp_path)
    again = refreshed(spark, raw, tmp_path)
    # the clicks of February changed: applications from then on for 180 days; the loan of August is gone
    touched = set(again.rewritten["gold.feature_store"])
    assert touched == {"2023-03-01", "2023-05-01", "2023-07-01", "2023-08-01", "2023-09-01", "2023-10-01"}
    assert not files.exists(spark, again.path("pending"))
    assert "LN17" not in {r.loan_id for r in again.feature_store().collect()}
    whole = refreshed(spark, raw, tmp_path, "whole")
    assert tables_of(again) == tables_of(whole)
    with pytest.raises(ValueError, match="all months"):
        job.refresh(spark, raw, str(tmp_path / "mart"), "r", first=AS_OF)


def test_touched_applications_against_rebuilt_features(spark):
    """An application whose state differs between two versions of a source is among the touched ones."""
    day = "date_add(DATE '2023-01-01', CAST({} AS INT))"
    applications = spark.range(400).selectExpr("concat('c', id % 20) AS Customer_ID", f"{day.format('id * 7 % 300')} AS snapshot_date")
    old = spark.range(300).selectExpr("concat('c', id % 20) AS Customer_ID", f"{day.format('id * 13 % 280')} AS snapshot_date", "id % 5 AS v")
    new = old.where("snapshot_date <> DATE '2023-03-01'").selectExpr(
        "Customer_ID", "snapshot_date", "IF(Customer_ID = 'c3' AND dayofmonth(snapshot_date) < 5, v + 1, v) AS v"
    )
    changed = changes.changed_customers(old, new)
    assert 0 < changed.count() < old.count()

    def state(source):
        joined = applications.distinct().alias("a").join(source.alias("s"), F.expr("a.Customer_ID = s.Customer_ID AND s.snapshot_date <= a.snapshot_date"), "left")
        rows = joined.groupBy("a.Customer_ID", "a.snapshot_date").agg(F.max(F.struct("s.snapshot_date", "s.v")).alias("state"))
        return {tuple(r)[:2]: r.state for r in rows.collect()}

    before, after = state(old), state(new)
    differ = {key for key in before if before[key] != after[key]}
    touched = {tuple(r) for r in changes.touched_as_of(applications, changed, new).collect()}
    assert differ <= touched and len(touched) < len(before)
    looked_back = {tuple(r) for r in changes.touched_look_back(applications, changed, 30).collect()}
    spans = [tuple(r) for r in changed.collect()]
    assert looked_back == {(c, d) for c, d in before for k, m in spans if c == k and dt.timedelta(0) <= d - m <= dt.timedelta(30)}



def test_fingerprints_tell_content_apart(spark):
    schema = "k string, a string, b string"
    base = [("x", "1", "2"), ("x", None, ""), ("y", "1", "2")]

    def of(rows):
        return {r.k: (r.rows, r.digest) for r in changes.fingerprints(spark.createDataFrame(rows, schema), ["k"]).collect()}

    assert of(base) == of(base[::-1])
    assert of(base)["y"] != of(base)["x"]
    for other in ([("x", "1", "2"), ("x", "", None), ("y", "1", "2")], [*base, base[0], base[0]], [("x", "12", ""), *base[1:]]):
        assert of(other)["x"] != of(base)["x"] and of(other)["y"] == of(base)["y"]


def test_a_publication_shows_old_or_new_rows_only(spark, tmp_path, monkeypatch):
    """Stopped after any number of steps, a reader sees all old months or all new ones."""
    schema = "id long, d string"
    old, new = [(1, "a"), (2, "b"), (3, "c")], [(10, "b"), (11, "c"), (12, "d")]
    names = ("rename", "remove")
    seen = set()
    for stop in range(0, 15, 2):
        root = str(tmp_path / f"root{stop}")
        first = Publication(spark, root)
        for path in ("one", "two"):
            first.replace_partitions(spark.createDataFrame(old, schema), f"{root}/{path}", ["d"], lambda p: True)
        first.commit()
        second = Publication(spark, root)
        for path in ("one", "two"):
            second.replace_partitions(spark.createDataFrame(new, schema), f"{root}/{path}", ["d"], lambda p: True)
        steps = iter(range(stop))

        def stopping(step):
            def run(*args):
                if next(steps, None) is None:
                    raise OSError("lost")
                return step(*args)

            return run

        with monkeypatch.context() as patched:
            for name in names:
                patched.setattr(files, name, stopping(getattr(files, name)))
            try:
                second.commit()
            except OSError:
                pass
        begun = publication.recover(spark, root)
        rows = [sorted(map(tuple, spark.read.schema(schema).parquet(f"{root}/{path}").collect())) for path in ("one", "two")]
        assert rows in ([old, old], [new, new])
        assert begun or rows == [old, old] or not os.path.exists(f"{root}/_journal/{second.token}")
        seen.add(rows == [new, new])
        publication.discard_unpublished(spark, root)
        assert not os.path.exists(f"{root}/_staged")
    assert seen == {True, False}


def test_a_type_that_turns_up_later_is_a_column_of_all_months(spark, raw, tmp_path):
    month = {"features_financials": [financial("CUS_0x1", "2023-01-01", Type_of_Loan="Auto Loan, Second Home Loan"), financial("CUS_0x2", "2023-02-01")]}
    write_csv(raw, "features_financials", month["features_financials"])
    settings = dict(run_id="v", as_of=AS_OF)
    first = job.run(spark, raw, str(tmp_path / "mart"), **settings)
    assert first.indicated_types() == ["Auto Loan", "Second Home Loan"]
    assert "has_home_loan" not in first.feature_store().columns
    write_csv(raw, "features_financials", [*month["features_financials"], financial("CUS_0x2", "2023-05-01", Type_of_Loan="Home Loan")])
    may = dt.date(2023, 5, 1)
    later = job.run(spark, raw, str(tmp_path / "mart"), first=may, last=may, **settings)
    types = {r.loan_type: r.first_period for r in later.vocabulary().collect()}
    assert types == {"Auto Loan": "2023-01-01", "Second Home Loan": "2023-01-01", "Home Loan": "2023-05-01"}
    assert vocabulary.versions(spark, later.path("vocabulary")) == [1, 2]
    rows = {r.loan_id: r for r in later.feature_store().collect()}
    # the month written before the type was known has its column, by whole words; no financials, no answer
    assert (rows["LN10"].has_home_loan, rows["LN10"].has_auto_loan, rows["LN11"].has_home_loan) == (1, 1, 0)
    assert rows["LN14"].has_home_loan == 1 and "loan_types" not in later.feature_store().columns
    assert later.silver_table(FINANCIALS).where("has_home_loan = 1").count() == 2
    with pytest.raises(ValueError, match="loan types"):
        vocabulary.types(spark.range(1001).selectExpr("concat('Loan ', id) AS loan_type"))


def test_malformed_lines_go_to_quarantine(spark, raw, tmp_path):
    path = f"{raw}/feature_clickstream.csv"
    with open(path) as file:
        head, good = file.read().splitlines()[:2]
    number = len(head.split(","))
    ragged = ["CUS_0x1,2023-01-01", good + ",one more", good + "," * 30_000, 'CUS_0x1,"2023-01-01,' + ",".join(["1"] * (number - 2))]
    with open(path, "w") as file:
        file.write("\n".join([head, good, *ragged, "", good.replace("CUS_0x1", '"CUS_0x2"')]) + "\n")
    lines = extracts.read_lines(spark, path)
    assert sorted(r.line for r in extracts.malformed(lines).collect()) == sorted(ragged)
    # readers of a single column see the same rows
    assert [r.Customer_ID for r in extracts.read_extract(spark, path).select("Customer_ID").collect()] == ["CUS_0x1", "CUS_0x2"]
    done = job.run(spark, raw, str(tmp_path / "mart"), run_id="r", as_of=AS_OF, only=["bronze"])
    rows = done.rows
    assert (rows["bronze.feature_clickstream"], rows["bronze.feature_clickstream.malformed_line"], rows["bronze.feature_clickstream.left_out"]) == (2, 4, 0)
    quarantine = spark.read.parquet(done.path("quarantine")).collect()
    assert {(r.source, r.rule, r.line) for r in quarantine} == {("feature_clickstream", "malformed_line", line) for line in ragged}
    # mended lines leave the quarantine
    write_csv(raw, "feature_clickstream", [click("CUS_0x1", "2023-01-01", "4")])
    again = job.run(spark, raw, str(tmp_path / "mart"), run_id="r", as_of=AS_OF, only=["bronze"])
    assert tables.partition_values(spark, again.path("quarantine"), ["source", "rule", "period"]) == []


def test_metrics_equal_the_recomputed_reports(spark, raw, tmp_path):
    write_csv(raw, "lms_loan_daily", LOANS)
    done = job.run(spark, raw, str(tmp_path / "mart"), run_id="r", as_of=AS_OF, only=["bronze", "silver"])
    reports, flagged = [], {}
    for name, spec in TABLES.items():
        kept = done.silver_table(spec).withColumn("period", F.col("period").cast("string"))
        reports += content(quality.quality_report(kept, name, "period"))
        flagged[name] = layers.flagged(spec, done.bronze_rows(spec), AS_OF)
    assert content(done.quality_report()) == sorted(reports)
    assert content(done.retention_report()) == content(quality.retention_report(flagged))
    counts = {(r.table, r.period): r.rows for r in done.partition_counts().collect()}
    assert counts["loan_daily", "2023-01-01"] == 3 and sum(n for (t, _), n in counts.items() if t == "loan_daily") == len(LOANS)
    assert done.rows["silver.loan_daily.dropped"] == 8
    assert set(done.metrics().columns) == set(metrics.COLUMNS)


def test_one_scan_gives_kept_and_quarantined_rows(spark, raw, tmp_path):
    done = job.run(spark, raw, str(tmp_path / "mart"), run_id="r", as_of=AS_OF, only=["bronze"])
    flagged = layers.flagged(FINANCIALS, done.bronze_rows(FINANCIALS), AS_OF)
    both = layers.sorted_out(FINANCIALS, flagged)
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Union" not in plan
    rows = {(r.fate, r.rule): r.Customer_ID for r in both.collect()}
    assert rows == {("kept", "-"): "CUS_0x1", ("quarantined", "Annual_Income"): "CUS_0x2"}


def test_manifest_reads_new_files_only(spark, tmp_path):
    folder = str(tmp_path / "raw")
    source = f"{folder}/features_attributes.csv"
    for part in ("a", "b"):
        write_csv(source, part, [attribute("CUS_0x1", f"2023-0{m}-01", part) for m in (1, 2)])
    old = manifest.scan(spark, folder, manifest.read(spark, str(tmp_path / "none"))).cache()
    assert {(r.month, r.rows) for r in old.collect()} == {("2023-01-01", 1), ("2023-02-01", 1)}
    assert manifest.scan(spark, folder, old).exceptAll(old).isEmpty()
    # one part is written anew with another row in February
    write_csv(source, "b", [attribute("CUS_0x1", "2023-01-01", "b"), attribute("CUS_0x1", "2023-02-01", "c")])
    new = manifest.scan(spark, folder, old)
    assert manifest.changed_months(old, new) == {"features_attributes": {"2023-02-01"}}
    assert len(manifest.files_with(new, "features_attributes", {"2023-02-01"})) == 2


def test_tables_by_customer_shuffle_nothing_below_the_timeline(spark, raw, tmp_path):
    from creditmart.operators import labels, pointintime

    settings = dict(as_of=AS_OF, run_id="b")
    plain = job.run(spark, raw, str(tmp_path / "plain"), **settings)
    # in two parts, so that a table's months come from several writes
    first = dict(first=None, last=dt.date(2023, 3, 1))
    job.run(spark, raw, str(tmp_path / "cut"), buckets=4, only=["bronze", "silver"], **settings)
    done = job.run(spark, raw, str(tmp_path / "cut"), only=["bronze", "silver"], **settings, **first)
    done = job.run(spark, raw, str(tmp_path / "cut"), only=["gold"], **settings)
    assert content(done.feature_store()) == content(plain.feature_store())
    assert content(done.label_store()) == content(plain.label_store())
    loans = done.silver_table(TABLES["loan_daily"])
    states = [pointintime.State(n, done.silver_table(TABLES[n]).drop("period")) for n in ("attributes", "financials")]
    clicks = pointintime.LookBack(done.click_totals(), of_totals=True)
    known = pointintime.timeline(labels.at_month(loans, 0), [*states, clicks])
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and plan.count("Bucketed: true") == 4 and "Exchange" not in plan
    with pytest.raises(ValueError, match="4 buckets"):
        job.run(spark, raw, str(tmp_path / "cut"), buckets=8, only=["silver"], **settings)
