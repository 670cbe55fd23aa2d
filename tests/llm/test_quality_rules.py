import math
import re
from collections import Counter

import pytest
import regex
import xxhash

from creditmart.llm import quality_rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
CLEAN = "the quick brown fox jumps over the lazy dog while many small birds sing in some old green tree near us"
ROWS = [
    (1, CLEAN),
    (2, CLEAN.replace("fox", "cat") + ".\nAnd then a line.\n\nAnd then a line.\n \t\n"),
    (3, None),
    (4, ""),
    (5, " \n\t"),
    (6, "too short"),
    (7, "a b c d e " * 8),
    (8, "buy### now$$$ and&&& win%%% big*** money### for$$$ you&&& my%%% friend*** here###"),
    (9, " ".join(f"word{i}" for i in range(3000))),
    (10, CLEAN),
    (10, CLEAN),
    (11, "x y z a b c d e f g x y z a b q r s t u v w"),
]


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def chained(values):
    """Spark's xxhash64 over several strings: each is hashed with the hash before as seed."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode(), h)
    return signed(h)


def counts(text):
    words = WORDS.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    repeat = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [line for line in (text or "").split("\n") if WORDS.search(line)]
    return dict(
        n_words=len(words),
        word_chars=sum(map(len, words)),
        n_symbols=len(re.findall(r"[#*$%&|<>]", text or "")),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=len(repeat),
    )


def features(text):
    hashes = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in WORDS.findall(text or "")]
    marks = WORDS.findall(regex.sub(quality_rules.LETTERS, "", text or ""))
    return [h % quality_rules.BUCKETS for h in hashes + [chained(p) for p in zip(marks, marks[1:])]]


def trusted(text):
    c = counts(text)
    capitals = len(re.findall(r"[A-Z]{2,}", text or ""))
    exclaimed = len(re.findall(r"[!?]{2,}", regex.sub(quality_rules.LETTERS, "", text or "")))
    return (
        c["n_words"] >= 20 and 100 * c["n_symbols"] <= c["n_words"]
        and 100 * capitals <= 40 * c["n_words"] and 100 * exclaimed <= 5 * c["n_words"]
    )


@pytest.fixture(scope="module")
def judged(spark):
    df = spark.createDataFrame([(i, t, "mine") for i, t in ROWS], "doc_id long, text string, kept string")
    return quality_rules.judged(df).collect()


def test_counts(judged):
    found = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in judged)
    assert found == sorted((i, *counts(t).values()) for i, t in ROWS)


def test_ratio_and_verdict(judged):
    raw, target = Counter(), Counter()
    for _, text in ROWS:
        raw.update(features(text))
        if trusted(text):
            target.update(features(text))
    n, t = sum(raw.values()), sum(target.values())

    def ratio(text):
        fs = features(text)
        logs = [
            math.log((target[f] + 1) / (t + quality_rules.BUCKETS)) - math.log((raw[f] + 1) / (n + quality_rules.BUCKETS))
            for f in fs
        ]
        return sum(logs) / len(fs) if fs else 0.0

    texts = dict(ROWS)
    for r in judged:
        c = counts(texts[r.doc_id])
        failed = c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        assert r.base_failed == failed
        assert r.log_ratio == pytest.approx(ratio(texts[r.doc_id]), abs=1e-5)
        assert r.kept == (not failed and r.log_ratio >= quality_rules.MIN_RATIO)
    assert not {r.doc_id for r in judged if r.kept} & {3, 4, 5, 6, 7, 8}


def test_nothing_trusted_and_empty(spark):
    (row,) = quality_rules.judged(spark.createDataFrame([(1, "a " * 5)], "doc_id long, text string")).collect()
    assert row.log_ratio == 0.0 and not row.kept
    assert quality_rules.judged(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = quality_rules.judged(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").collect()
    clean = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert all(r.kept for r in clean) and sum(r.kept for r in bad) < 0.05 * len(bad)
