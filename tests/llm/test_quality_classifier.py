import zlib

import numpy as np

from creditmart.llm import quality_classifier as classifier
from creditmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    found = QUERIES["op2_quality_classifier"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").collect()
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == r.quality for r in held) / len(held)
    share = max(np.mean([r.quality for r in held]), 1 - np.mean([r.quality for r in held]))
    assert right > 0.97 > share


def test_descent_separates():
    rows = [np.array([0, 2]), np.array([0, 3]), np.array([1, 2]), np.array([1, 3])]
    labels = np.array([1, 1, 0, 0])
    ratios = classifier.log_count_ratios(rows, labels)
    assert ratios[0] > 0 > ratios[1]
    weights, bias = classifier.descend(rows, labels, ratios)
    margins = [weights[r] @ classifier._scaled(r, ratios) + bias for r in rows]
    assert min(margins[:2]) > 0 > max(margins[2:])


def test_odd_inputs(spark):
    docs = spark.createDataFrame(
        [(i, "good words here" if i % 2 else "bad junk there", "c") for i in range(200)]
        + [(900, None, "c"), (901, "", "c"), (902, "good " * 50_000, "c"), (None, "bad junk", "c"), (1, "good words here", "c")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(200)] + [(None, 1, 0), (3, None, 0), (901, 7, 0)], "doc_id long, quality int, text int"
    )
    model = classifier.learn(docs, labels)
    found = {r.doc_id: r for r in classifier.scored(docs, model).collect()}
    assert found[1].predicted == 1 and found[2].predicted == 0 and found[None].predicted == 0
    assert found[900].score == found[901].score
    for none in (labels.where("quality = 5"), labels.where("quality = 1")):
        constant = classifier.learn(docs, none)
        assert len({r.score for r in classifier.scored(docs, constant).collect()}) == 1
    assert classifier.scored(docs.where("doc_id = -5"), model).collect() == []
    sampled = classifier.learn(docs, labels, sample_rows=50)
    assert {r.predicted for r in classifier.scored(docs.where("doc_id < 20 AND doc_id % 2 = 1"), sampled).collect()} == {1}
