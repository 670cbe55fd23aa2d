"""Alignment against intersections of byte ranges, with the tokenizers' own libraries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditmart.llm import token_alignment as alignment
from creditmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a", "two  spaces \n\n and\ttabs", "<|endoftext|> x <s> </s>", "日本 語 🙂 ｆ", "▁ marks", "x\x00y",
       "ab " * 3000, "a" * 2000, "﻿bom ﬁ", "same words here", "same words here"]


def byte_alphabet():
    """The visible characters that byte-level vocabularies write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@pytest.fixture(scope="module")
def coders():
    a = Tokenizer.from_file(path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    return a, b, byte_alphabet()


def sides(text, coders):
    a, b, alphabet = coders
    if not text:
        return [], []
    one = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    two = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        two.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    same = all(b"".join(token for _, token in side) == raw for side in (one, two))
    return (one, two) if same else ([], [])


def ranges(side):
    at, out = 0, []
    for i, token in side:
        out.append((i, at, at + len(token)))
        at += len(token)
    return out


def brute(rows, coders):
    links, base = {}, {}
    for number, (doc_id, text) in enumerate(rows):
        one, two = map(ranges, sides(text, coders))
        held, at = [], 0
        for i, s, e in one:
            while at and two[at - 1][2] > s:
                at -= 1
            while at < len(two) and two[at][1] < e:
                if two[at][2] > s:
                    held.append((i, two[at][0]))
                at += 1
        common = sorted({e for *_, e in one} & {e for *_, e in two})
        written = []
        for start, end in zip([0, *common], common):
            inside = [",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (one, two)] if len(one) < 400 else None
            written.append("|".join(inside) if inside else "")
        digest = hashlib.sha256(";".join(written).encode()).hexdigest() if one and len(one) < 400 else ""
        links[number] = held
        base[number] = (doc_id, len(one), len(two), len(common), len(held), digest, bool(one) and len(one) >= 400)
    counts = Counter(pair for held in links.values() for pair in set(held))
    highest = defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    return [
        (*base[k][:5], sum(counts[p] == highest[p[0]] for p in held), sum(counts[p] for p in held), base[k][5], base[k][6])
        for k, held in links.items()
    ]


def agree(found, wanted):
    def key(row):
        return tuple((v is None, v) for v in row[:7])

    got = sorted([tuple(r) for r in found], key=key)
    assert len(got) == len(wanted)
    for row, (*expected, digest, unread) in zip(got, sorted(wanted, key=key)):
        assert row[:7] == tuple(expected)
        assert unread or row[7] == digest


@pytest.mark.parametrize("chunk_bytes", [alignment.CHUNK_BYTES, 300])
def test_odd_texts_against_brute_force(spark, coders, chunk_bytes):
    rows = [*enumerate(ODD), (None, "some text"), (3, "a")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, pair string, chunk int").repartition(3)
    agree(alignment.aligned(df, chunk_bytes=chunk_bytes).collect(), brute(rows, coders))


def test_query_against_brute_force(spark, coders):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = QUERIES["op13_token_alignment"](spark, SF)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = found.collect()
    agree(rows, brute([tuple(r) for r in docs.collect()], coders))
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups for r in rows)


@given(st.lists(st.integers(1, 5), min_size=1, max_size=60), st.lists(st.integers(1, 5), min_size=1, max_size=60))
def test_groups_end_at_common_ends(a, b):
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    total = min(ends_a[-1], ends_b[-1])
    ends_a, ends_b = (np.unique(np.append(e[e < total], total)) for e in (ends_a, ends_b))
    last_a, last_b = alignment.group_ends(ends_a, ends_b)
    common = np.intersect1d(ends_a, ends_b)
    for ends, last in ((ends_a, last_a), (ends_b, last_b)):
        assert (ends_b[last] == common[np.searchsorted(common, ends)]).all()


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.aligned(empty).collect() == []


def test_nothing_of_a_table_is_in_the_chunks_but_its_counts(spark):
    """A pair that all documents hold is one row per chunk, however many documents there are."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("the very same text").alias("text")).coalesce(1)
    chunks = alignment._aligned_chunks(docs, alignment.byte_level, alignment.pieces, 1 << 16)
    shape = chunks.agg(F.count("pair"), F.countDistinct("chunk"), F.countDistinct("pair")).first()
    assert shape[0] == shape[1] * shape[2]
    rows = alignment.aligned(docs, chunk_bytes=1 << 16).select("n_links", "count_sum").distinct().collect()
    assert [(r.count_sum) for r in rows] == [4000 * rows[0].n_links]
