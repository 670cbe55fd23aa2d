import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from creditmart.llm import suffix_dedup


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for doc_id, t in texts:
        covered = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        kept = bytes(b for b, c in zip(t, covered) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (not i or not covered[i - 1]))
        out.append((doc_id, len(t), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("alphabet", [2, 5, 200])
def test_suffix_array(alphabet):
    rng = np.random.default_rng(alphabet)
    for _ in range(150):
        values = rng.integers(1, alphabet + 1, int(rng.integers(0, 70)))
        wanted = sorted(range(len(values)), key=lambda i: values[i:].tolist())
        assert suffix_dedup.suffix_array(values).tolist() == wanted


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéö") for _ in range(rng.randint(1, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    passage, license = prose(rng, 40), prose(rng, 15)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 20)}" for _ in range(6)]
    texts += [f"{prose(rng, 5)} {license} {prose(rng, 5)}" for _ in range(30)]
    texts += [texts[3], texts[3], texts[4][:-5] + "x", "Des " * 200, "Des " * 90, "", None, "short", "ab" * 40, passage + passage]
    texts += [prose(rng, 4000)]
    return [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[5])]


@pytest.mark.parametrize("limits", [{}, {"block_bytes": 2000, "anchor_bytes": 900}])
def test_repeats(spark, rows, limits):
    df = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, key long")
    found = suffix_dedup.deduplicated(df, length=60, gram=20, **limits).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == brute(rows, 60)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in found)


def test_contract_length(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found = suffix_dedup.deduplicated(docs).drop("kept").collect()
    assert sorted(map(tuple, found), key=str) == brute([tuple(r) for r in docs.collect()], 400)


def test_empty_table(spark):
    assert suffix_dedup.deduplicated(spark.createDataFrame([], "doc_id long, text string")).collect() == []
