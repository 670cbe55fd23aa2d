"""Removal of earlier passages against a table of all windows."""

import hashlib
import random
import re

import pytest

from creditmart.llm import super_kmers
from creditmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LAST = (1 << 63) - 1


def brute(rows, window=20):
    """What stays of each row: a window falls if it has stood at a smaller (doc_id, start)."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    first = {}
    for (doc_id, _), of_row in zip(rows, words):
        for i in range(len(of_row) - window + 1):
            name, place = tuple(of_row[i : i + window]), (LAST if doc_id is None else doc_id, i)
            first[name] = min(place, first.get(name, place))
    out = []
    for (doc_id, _), of_row in zip(rows, words):
        gone = set()
        for i in range(len(of_row) - window + 1):
            if first[tuple(of_row[i : i + window])] < (LAST if doc_id is None else doc_id, i):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(of_row) if i not in gone)
        out.append((doc_id, len(of_row), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def outcome(df, **settings):
    return sorted((tuple(r)[:4] for r in super_kmers.deduplicated(df, **settings).collect()), key=str)


def test_query_against_all_windows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op12_super_kmers"](spark, SF)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    rows = sorted((tuple(r) for r in found.collect()), key=str)
    assert rows == brute([tuple(r) for r in docs])
    assert sum(r[2] > 0 for r in rows) >= 10


def texts():
    draw = random.Random(7)
    some = [" ".join(draw.choice("abcdefgh") + str(draw.randrange(40)) for _ in range(n)) for n in (80, 60, 45, 25, 20, 19)]
    passage = " ".join(f"p{i}" for i in range(30))
    return [
        (1, some[0]),
        (2, some[1] + " " + passage),
        (3, passage + "\n\t" + some[2]),
        (4, some[0]),
        (5, some[0].replace(" ", "  ")),
        (6, some[0] + " more " + some[0]),
        (7, None),
        (8, " \n"),
        (9, some[3]),
        (9, some[3]),
        (9, "x " + some[3]),
        (None, some[4]),
        (None, some[4] + " end"),
        (10, some[4]),
        (11, some[5]),
        (12, some[5]),
        (13, "z " * 3000),
        (14, "é ü " * 50 + passage),
        (15, "q " * 19 + passage[:100]),
        (-3, passage),
    ]


@pytest.mark.parametrize("settings", [{}, {"bucket_rows": 1}, {"gram": 3}, {"gram": 20}, {"gram": 2, "bucket_rows": 4}])
def test_odd_texts(spark, settings):
    rows = texts()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, order int").repartition(4)
    assert outcome(df, **settings) == brute(rows)


@pytest.mark.parametrize("bucket_rows", [20_000, 50])
def test_common_line_within_other_words(spark, bucket_rows):
    """One minimiser that every text has, in ever other words: one bucket of many strings."""
    line = " ".join(f"licence{i}" for i in range(14))
    draw = random.Random(3)
    rows = [(i, " ".join(f"w{draw.randrange(200)}" for _ in range(12)) + f" {line} " + " ".join(f"v{draw.randrange(3)}" for _ in range(10)))
            for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = outcome(df, bucket_rows=bucket_rows)
    assert found == brute(rows) and any(r[2] for r in found)


def test_super_kmers_cover_all_windows():
    words = [w.encode() for w in texts()[0][1].split()]
    minimisers, starts, windows = super_kmers.super_kmers(words, super_kmers._WordHashes())
    assert starts[0] == 0 and (starts[1:] == (starts + windows)[:-1]).all() and starts[-1] + windows[-1] == len(words) - 19
    assert (windows <= 20 - super_kmers.GRAM + 1).all() and len(minimisers) == len(starts)


def test_a_hot_passage_is_one_string(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"head{i} {passage} tail{i}") for i in range(3000)]
    found = super_kmers.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.kept for r in found} == {i: rows[0][1] if not i else f"head{i} tail{i}" for i in range(3000)}


def test_no_rows(spark):
    assert super_kmers.deduplicated(spark.createDataFrame([], "doc_id long, text string")).collect() == []
