"""Blocks of segments stay below what one suffix sort takes."""

import random

from creditmart.llm import suffix_dedup


def test_a_nearly_full_block_before_a_large_anchor(spark):
    rng = random.Random(1)
    passage = rng.randbytes(500)
    sizes = {1: 1040, 2: 1550}  # thousands of bytes: just under BLOCK_BYTES, and under ANCHOR_BYTES
    rows = []
    for anchor, n in sizes.items():
        parts = [rng.randbytes(1000) for _ in range(n)]
        parts[0] = passage + parts[0][500:]
        parts[-1] = parts[-1][:500] + passage
        rows += [(i, anchor, i, 0, 601, 1, part) for i, part in enumerate(parts, len(rows))]
    schema = "key long, anchor long, whole long, start int, windows int, n long, part binary"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        blocks = suffix_dedup._sorted_blocks(spark.createDataFrame(rows, schema), 400, suffix_dedup.BLOCK_BYTES)
        found = sorted(map(tuple, blocks.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == [(0, 0, 101), (1039, 500, 101), (1040, 0, 101), (2589, 500, 101)]
