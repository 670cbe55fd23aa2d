"""Every registered query against DuckDB on the same tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from creditmart.plans.queries import QUERIES
from oracles import ORACLE_SQL as ORACLES

SF = "/root/testdata/sf0.001"
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("orders", "customer", "events"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLES[name])
    columns = {column[0]: str(column[1]) for column in expected.description}
    assert {column: TYPES[kind] for column, kind in result.dtypes} == columns
    names = sorted(columns)
    positions = [list(columns).index(column) for column in names]
    rows = [tuple(row[i] for i in positions) for row in expected.fetchall()]
    assert ordered(map(tuple, result.select(names).collect())) == ordered(rows)
    assert rows


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_history_fans_out_and_the_latest_does_not(spark):
    rows = {name: QUERIES[name](spark, SF).count() for name in ("applications_mob0", "pit_join_attributes", "asof_attributes")}
    assert rows["pit_join_attributes"] > rows["asof_attributes"] == rows["applications_mob0"]


def test_building_a_query_reads_schemas_only(spark):
    context = spark.sparkContext
    context.setJobGroup("building", "building")
    try:
        for name in ("silver_financials", "feature_store", "training_set", "quality_report"):
            QUERIES[name](spark, SF)
        tracker = context.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup("building") for s in tracker.getJobInfo(job).stageIds]
        assert all(tracker.getStageInfo(s).name.startswith("parquet at") for s in stages)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
