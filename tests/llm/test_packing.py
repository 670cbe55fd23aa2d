import zlib
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from creditmart.llm import packing

ODD = ["", None, " ", "a  b\n\n c ", "<|endoftext|> x", "日本 語 🙂", "a" * 3000, "Don't\tstop", "x\x00y"]


def coder():
    return Tokenizer.from_file(path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def case(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, tier int")
    return rows, packing.packed(df).collect()


def test_every_id_lies_in_one_piece(case):
    rows, found = case
    pieces = defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
    tokenizer = coder()
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_sequences_are_gapless_and_full(case):
    _, found = case
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append(r)
    padding = total = 0
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        total += at
    assert sorted(sequences) == list(range(len(sequences)))
    assert padding <= 0.02 * total + 2048


def test_steps_are_balanced(case):
    _, found = case
    steps, cost = defaultdict(set), defaultdict(int)
    for r in found:
        steps[r.step].add(r.sequence_id)
        cost[r.step] += r.length**2
    sizes = [len(s) for s in steps.values()]
    assert max(sizes) - min(sizes) <= 1
    assert max(cost.values()) <= 1.5 * min(cost.values())


@pytest.mark.parametrize("counts", [{}, {1: 5000}, {2048: 7}, {2047: 3, 1: 2, 1024: 5, 700: 9}, {n: n % 7 + 1 for n in range(1, 2049)}])
def test_plan_places_every_piece(counts):
    placed = defaultdict(int)
    for windows, inside in packing.plan(counts):
        assert windows > 0 and sum(n * k for n, k in inside) <= 2048
        for n, k in inside:
            placed[n] += windows * k
    assert placed == counts


def test_hot_length_and_empty_table(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "'the same words' AS text")
    found = packing.packed(df).collect()
    assert len({(r.sequence_id, r.offset) for r in found}) == 3000
    assert packing.packed(df.where("doc_id < 0")).collect() == []


def padded(kinds):
    fills = [(windows, sum(n * k for n, k in inside)) for windows, inside in kinds]
    return sum(windows * (2048 - fill) for windows, fill in fills if fill & (fill - 1))


def test_tiers_make_short_windows_and_little_padding(case):
    _, found = case
    random = np.random.default_rng(5)
    for _ in range(20):
        lengths = np.minimum(2048, random.lognormal(5.5, 1.2, 20_000).astype(int) + 1)
        counts = {int(n): int(k) for n, k in zip(*np.unique(lengths, return_counts=True), strict=True)}
        tiered, flat = packing.plan(counts), packing.plan(counts, tiers=(2048,))
        fills = defaultdict(int)
        for windows, inside in tiered:
            fills[sum(n * k for n, k in inside)] += windows
        assert fills[256] + fills[512] + fills[1024] > 100
        assert padded(tiered) <= max(padded(flat), 0.001 * lengths.sum()) + 2048
        # attention within windows costs less than without tiers
        cost = [sum(w * sum(n * k for n, k in inside) ** 2 for w, inside in kinds) for kinds in (tiered, flat)]
        assert cost[0] < cost[1]
    fills, contexts = defaultdict(int), {}
    for r in found:
        fills[r.sequence_id] += r.length
        contexts.setdefault(r.sequence_id, set()).add(r.context)
    for sequence, fill in fills.items():
        assert contexts[sequence] == {fill if fill in packing.TIERS else 2048}


def test_short_windows_give_way_to_gaps():
    """Small pieces that fill windows of their own are what long windows lack."""
    counts = {2000: 1000, 48: 200, 128: 2000, 1990: 500, 58: 10}
    placed = defaultdict(int)
    for windows, inside in packing.plan(counts):
        for n, k in inside:
            placed[n] += windows * k
    assert placed == counts
    assert padded(packing.plan(counts)) <= padded(packing.plan(counts, tiers=(2048,)))
