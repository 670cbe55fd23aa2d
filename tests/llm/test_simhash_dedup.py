import re

import pytest
import xxhash

from creditmart.llm import simhash_dedup

TEXTS = {
    0: "one two three four five six seven eight nine ten",
    1: "ONE two three four five six seven eight nine ten",  # the same in lower case
    2: "",
    3: None,
    4: " \t\n",
    5: "short text",
    6: "Éa b c d e f g",  # only A-Z fold
    7: "a b c " * 500,
    8: "one two three four five six seven eight nine ten",
}


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(fps):
    """Component of each id by comparing all pairs."""
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in fps}


def test_fingerprints_and_components(spark):
    rows = [(i, t, "x") for i, t in TEXTS.items()]
    found = simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()
    fps = {i: fingerprint(t) for i, t in TEXTS.items()}
    assert {r.doc_id: r.fp % (1 << 64) for r in found} == fps
    assert {r.doc_id: r.component_id for r in found} == brute(fps)


def flipped(base, steps):
    """Fingerprints each a few bits from the one before: a chain, and some far away."""
    out, at = [base], base
    for bits in steps:
        for bit in bits:
            at ^= 1 << bit
        out.append(at)
    return out


@pytest.mark.parametrize("bucket_rows", [16_384, 3])
def test_links_lose_none(spark, bucket_rows):
    chain = flipped(0x0123456789ABCDEF, [(0, 63, 31), (5,), (17, 18, 19), (1, 2, 3, 4), (40, 41), (0, 20, 50), (8,)])
    near = [0xFFFF0000FFFF0000 ^ (1 << a) ^ (1 << b) for a in range(4) for b in range(30, 36)]
    fps = {i: fp for i, fp in enumerate([*chain, *near])}
    signed = {i: fp - (1 << 64) if fp >> 63 else fp for i, fp in fps.items()}
    df = spark.createDataFrame([(fp,) for fp in set(signed.values())], "fp long")
    edges = simhash_dedup.links(df, bucket_rows)
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    groups = {r.node: r.root for r in simhash_dedup.components(edges).collect()}
    root = {i: groups.get(fp, fp) for i, fp in signed.items()}
    wanted = brute(fps)
    assert {(a, b) for a in root for b in root if root[a] == root[b]} == {
        (a, b) for a in wanted for b in wanted if wanted[a] == wanted[b]
    }


def test_one_of_each_group(spark):
    rows = [(2, "a b c d e", 1), (1, "a b c d e", 2), (1, "a b c d e", 2), (3, "x y z u v", 3), (None, "q", 4)]
    kept = simhash_dedup.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string, more int"))
    assert sorted(map(tuple, kept.collect()), key=str) == [(1, "a b c d e", 2), (3, "x y z u v", 3), (None, "q", 4)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_dedup.near_duplicates(empty).collect() == []
    assert simhash_dedup.one_of_each_group(empty).collect() == []
