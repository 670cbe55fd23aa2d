"""Point-in-time operators against brute force, and under heavy skew."""

import datetime as dt
import random

import pytest

from creditmart.operators import pointintime

APPLICATIONS = "loan_id string, Customer_ID string, snapshot_date date"
STATES = "Customer_ID string, snapshot_date date, Age int, Occupation string"
CLICKS = "Customer_ID string, snapshot_date date, a int, b int"


def day(month, number=1):
    return dt.date(2023, month, number)


@pytest.fixture(scope="module")
def data():
    """Random rows with keyless, dateless, repeated and tied ones; one customer holds half."""
    rng = random.Random(7)

    def customer():
        return rng.choice(["hot"] * 6 + ["b", "c", "d", "e", None])

    def date():
        return None if rng.random() < 0.05 else day(1) + dt.timedelta(rng.randrange(400))

    applications = [(f"L{i}", customer(), date()) for i in range(200)] + [("X", "nobody", day(5))]
    states = [(customer(), date(), rng.randrange(9), rng.choice("PQ")) for _ in range(150)]
    clicks = [(customer(), date(), rng.choice([None, 1, 2, 5]), rng.randrange(10)) for _ in range(300)]
    return applications, states, clicks


def earlier(state, customer, date):
    return customer is not None and date is not None and state[0] == customer and state[1] is not None and state[1] <= date


def key(row):
    return tuple((v is None, str(v)) for v in row)


def test_as_of_join(spark, data):
    applications, states, _ = data
    expected = []
    for loan, customer, date in applications:
        known = [s for s in states if earlier(s, customer, date)]
        # latest day, then the greatest row of that day
        best = max(known, key=lambda s: (s[1], s[2], s[3])) if known else (None,) * 4
        expected.append((loan, customer, date, best[2], best[3], best[1]))
    result = pointintime.as_of_join(
        spark.createDataFrame(applications, APPLICATIONS), spark.createDataFrame(states, STATES)
    )
    assert result.columns == ["loan_id", "Customer_ID", "snapshot_date", "Age", "Occupation", "source_date"]
    assert sorted(map(tuple, result.collect()), key=key) == sorted(expected, key=key)


def test_history_join(spark, data):
    applications, states, _ = data
    expected = []
    for loan, customer, date in applications:
        known = [(s[2], s[3], s[1]) for s in states if earlier(s, customer, date)]
        expected += [(loan, customer, date, *k) for k in known or [(None, None, None)]]
    result = pointintime.history_join(
        spark.createDataFrame(applications, APPLICATIONS), spark.createDataFrame(states, STATES)
    )
    assert sorted(map(tuple, result.collect()), key=key) == sorted(expected, key=key)


def test_look_back_join(spark, data):
    applications, _, clicks = data
    expected = []
    for loan, customer, date in applications:
        seen = [c for c in clicks if earlier(c, customer, date) and c[1] >= date - dt.timedelta(180)]
        means = []
        for i in (2, 3):
            numbers = [c[i] for c in seen if c[i] is not None]
            means.append(sum(numbers) / len(numbers) if numbers else None)
        expected.append((loan, customer, date, *means, len(seen)))
    result = pointintime.look_back_join(
        spark.createDataFrame(applications, APPLICATIONS),
        spark.createDataFrame(clicks, CLICKS),
        features=("a", "b"),
    )
    assert result.columns[3:] == ["avg_a_last_6m", "avg_b_last_6m", "clickstream_snapshot_count"]
    assert sorted(map(tuple, result.collect()), key=key) == sorted(expected, key=key)


def test_look_back_window_bounds(spark):
    applications = spark.createDataFrame([("L", "c", day(7))], APPLICATIONS)
    days = [day(1, 1), day(1, 2), day(7, 1), day(7, 2)]
    clicks = spark.createDataFrame([("c", d, i, 0) for i, d in enumerate(days)], CLICKS)
    (row,) = pointintime.look_back_join(applications, clicks, features=("a",)).collect()
    assert (row.avg_a_last_6m, row.clickstream_snapshot_count) == (1.5, 2)


def test_customer_join_keeps_left_names(spark):
    applications = spark.createDataFrame([("L", "c", day(7)), ("M", "x", day(7))], APPLICATIONS)
    states = spark.createDataFrame([("c", day(9), 3, "P")], STATES)
    rows = sorted(pointintime.customer_join(applications, states).collect(), key=lambda r: r.loan_id)
    assert [(r.loan_id, r.snapshot_date, r.Age) for r in rows] == [("L", day(7), 3), ("M", day(7), None)]


def test_hot_customer_is_reduced_before_the_window(spark):
    """A customer with most rows of every table enters the window once per day at most."""
    applications = spark.range(20000).selectExpr(
        "concat('L', id) AS loan_id",
        "IF(id % 3 < 2, 'hot', concat('c', id)) AS Customer_ID",
        "date_add(DATE '2023-01-01', CAST(id % 7 AS INT)) AS snapshot_date",
    )
    clicks = spark.range(30000).selectExpr(
        "IF(id % 3 < 2, 'hot', concat('c', id)) AS Customer_ID",
        "date_add(DATE '2023-01-01', CAST(id % 5 AS INT)) AS snapshot_date",
        "CAST(id % 10 AS INT) AS a",
        "1 AS b",
    )
    look_back = pointintime.LookBack(clicks, ("a", "b"))
    known = pointintime.timeline(applications, [look_back])
    assert known.where("Customer_ID = 'hot'").count() == 7
    result = pointintime.look_back_join(applications, clicks, features=("a", "b"))
    assert result.count() == 20000
    hot = result.where("Customer_ID = 'hot' AND snapshot_date = DATE '2023-01-07'").first()
    assert hot.clickstream_snapshot_count == 20000


def test_skewed_row_side_is_split(spark):
    """The join back on (customer, date) splits a hot pair instead of leaving it to one task."""
    applications = spark.range(60000).selectExpr(
        "concat('L', id) AS loan_id",
        "IF(id % 3 < 2, 'hot', concat('c', id)) AS Customer_ID",
        "IF(id % 3 < 2, DATE '2023-01-01', DATE '2023-02-01') AS snapshot_date",
    ).repartition(8)
    states = spark.range(60000).selectExpr(
        "IF(id = 0, 'hot', concat('c', id)) AS Customer_ID",
        "DATE '2023-01-01' AS snapshot_date",
        "CAST(id AS INT) AS Age",
        "'P' AS Occupation",
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        for join in (pointintime.as_of_join, pointintime.history_join, pointintime.customer_join):
            result = join(applications, states)
            rows = result.collect()
            assert len(rows) == 60000
            assert sum(r.Age == 0 for r in rows) == 40000
            assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_customer(spark):
    customer = "IF(id % 3 = 0, 'hot', concat('c', id % 50)) AS Customer_ID"
    day_of = "date_add(DATE '2021-01-15', CAST(id * {} % 1000 AS INT)) AS snapshot_date"
    applications = spark.range(900).selectExpr("concat('L', id) AS loan_id", customer, day_of.format(37), "0 AS mob")
    states = spark.range(2000).selectExpr(customer, day_of.format(53), "CAST(id % 90 AS INT) AS Age", "'P' AS Job")
    nobody = spark.createDataFrame([("N", None, day(7), 0), ("E", "early", dt.date(2020, 1, 1), 0)], applications.schema)
    early = spark.createDataFrame([("early", dt.date(2022, 1, 1), 1, "P"), (None, day(7), 2, "P"), ("hot", None, 3, "P")], states.schema)
    return applications.unionByName(nobody), states.unionByName(early)


def test_month_buckets_give_the_same_history(spark):
    applications, states = hot_customer(spark)
    plain = pointintime.history_join(applications, states)
    bucketed = pointintime.bucketed_history_join(applications, states)
    assert bucketed.columns == plain.columns
    assert bucketed.exceptAll(plain).isEmpty() and plain.exceptAll(bucketed).isEmpty()


def test_month_buckets_spread_a_hot_customer(spark):
    """A customer with a third of all rows is joined under as many keys as there are months."""
    applications, states = hot_customer(spark)
    plan = pointintime.bucketed_history_join(applications, states)._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in plan and "_month" in plan
    keyed = states.selectExpr("Customer_ID", "trunc(snapshot_date, 'month') AS month").where("Customer_ID IS NOT NULL AND month IS NOT NULL")
    largest = keyed.groupBy("Customer_ID", "month").count().agg({"count": "max"}).first()[0]
    assert keyed.where("Customer_ID = 'hot'").count() > 600 and largest < 60


def test_daily_totals_give_the_same_averages(spark):
    applications = spark.createDataFrame([("L", "c", day(7)), ("M", "c", day(3)), ("N", "x", day(7))], APPLICATIONS)
    rows = [("c", day(m, d), m * d, None if d == 2 else 5) for m in range(1, 8) for d in (1, 1, 2)] + [(None, day(7), 1, 1)]
    clicks = spark.createDataFrame(rows, CLICKS)
    direct = pointintime.look_back_join(applications, clicks, features=("a", "b"))
    # totals of two parts of the months, as a run stores them
    parts = [pointintime.daily_totals(clicks.where(part), ("a", "b")) for part in ("month(snapshot_date) < 4", "month(snapshot_date) >= 4")]
    stored = pointintime.look_back_join(applications, parts[0].unionByName(parts[1]), features=("a", "b"), of_totals=True)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, direct.collect()))


def test_look_back_over_other_kinds_of_numbers(spark):
    rows = [("c", day(1), 1.5, "1.50", 2**62), ("c", day(2), None, "2.25", 5), ("c", day(3), 4.0, None, 7), ("d", day(2), None, None, None)]
    clicks = spark.createDataFrame(rows, "Customer_ID string, snapshot_date date, a double, b string, c long")
    clicks = clicks.selectExpr("Customer_ID", "snapshot_date", "a", "CAST(b AS DECIMAL(38,2)) AS b", "c")
    applications = spark.createDataFrame([("L", "c", day(3)), ("M", "c", day(1)), ("N", "d", day(4)), ("O", "e", day(4))], APPLICATIONS)
    found = pointintime.look_back_join(applications, clicks, features=("a", "b", "c"))
    rows = {r.loan_id: tuple(r)[-4:] for r in found.collect()}
    assert rows == {"L": (2.75, 1.875, (2**62 + 12) / 3, 3), "M": (1.5, 1.5, 2.0**62, 1), "N": (None, None, None, 1), "O": (None, None, None, 0)}
