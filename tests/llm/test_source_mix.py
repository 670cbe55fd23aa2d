import hashlib
import random

import duckdb
import pytest

import __spark_entry__ as contract
from creditmart.llm import mixing

SF = "/root/testdata/sf0.01"


def water(sizes):
    """Targets by giving out shares and resharing what is above, again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, 0.0), set(), float(sum(sizes.values()))
    while left > 1e-9 and len(full) < len(names):
        share = left / sum(weights[s] for s in names if s not in full)
        left = 0.0
        for s in names:
            if s not in full:
                target[s] += share * weights[s]
                if target[s] >= 3 * sizes[s]:
                    left += target[s] - 3 * sizes[s]
                    target[s] = 3.0 * sizes[s]
                    full.add(s)
    return target


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    sources = ["a", "b", "c", "d", "é", "", None]
    return [(i, rng.choice(sources[: 1 + i % 7]), "w " * int(rng.expovariate(0.02))) for i in range(1500)] + [
        (5000, "tiny", "one"), (5001, "a", None), (5002, "a", ""), (7, "a", "w w"), (7, "a", "w w"), (None, "b", "x y"),
    ]


def test_targets_and_sample(spark, rows):
    found = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert len(found) == len(rows)
    sizes, taken, largest = {}, {}, {}
    for _, s, t in rows:
        n = len((t or "").split())
        sizes[s] = sizes.get(s, 0) + n
        largest[s] = max(largest.get(s, 0), n)
    goal = water(sizes)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(goal[r.source], rel=1e-9)
        assert r.taken == r.copies * r.size and r.taken <= 3 * r.size
        whole = int(r.target / r.source_size) if r.source_size else 0
        assert r.size == 0 or whole <= r.copies <= whole + 1
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, target in goal.items():
        assert abs(taken[s] - target) <= largest[s] / 2 + 1e-6
    again = mixing.mixed(spark.createDataFrame(rows[::-1], "doc_id long, source string, text string")).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_order_is_pareto(spark):
    rows = [(i, "a" if i % 2 else "b", "w w w") for i in range(400)]
    found = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()

    def u(i):
        return (int(hashlib.md5(f"mix-1:{i}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48

    for source in ("a", "b"):
        own = [r for r in found if r.source == source]
        least = min(r.copies for r in own)
        more = [u(r.doc_id) for r in own if r.copies > least]
        same = [u(r.doc_id) for r in own if r.copies == least]
        assert not more or max(more) < min(same)


def test_mix_repeats_documents_whole(spark):
    rows = [(1, "a", "x y", 7), (2, "b", "z " * 50, 8), (None, "b", "lost", 9), (3, "b", None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, copies int")
    found = mixing.mix(df)
    assert found.columns == df.columns
    assert {r.doc_id for r in found.collect()} <= {1, 2}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mixed(empty).collect() == [] and mixing.mix(empty).collect() == []


def test_against_duckdb(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    sql = contract.oracle_sql()["op10_source_mix"]
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    wanted = sorted(map(str, (dict(sorted(zip(names, row))) for row in result.fetchall())))
    found = contract.queries()["op10_source_mix"](spark, SF).collect()
    assert sorted(str(dict(sorted(r.asDict().items()))) for r in found) == wanted
