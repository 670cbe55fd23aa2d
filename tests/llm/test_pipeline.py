"""The pipeline against its stages done by hand, and over odd rows."""

from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from creditmart.llm import mixing, quality_rules, secret_scan, simhash_dedup
from creditmart.llm.tokenizing import encoder

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_dedup", "secret_scan", "source_mix", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, SF).cache()
    kept = {r.doc_id for r in quality_rules.judged(docs).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and good.columns == docs.columns
    distinct = stages["simhash_dedup"](spark, good, SF).cache()
    components = {r.component_id for r in simhash_dedup.near_duplicates(good).collect()}
    assert {r.doc_id for r in distinct.collect()} == components and distinct.count() == len(components)
    clean = stages["secret_scan"](spark, distinct, SF).cache()
    coder = encoder()
    assert clean.columns == docs.columns and clean.count() == len(components)
    assert not any(secret_scan.base_spans(r.text) for r in clean.collect())
    assert coder.n_vocab > 0
    mixed = stages["source_mix"](spark, clean, SF).cache()
    copies = {r.doc_id: r.copies for r in mixing.mixed(clean).collect() if r.copies}
    seen = defaultdict(int)
    for r in mixed.collect():
        seen[r.doc_id] += 1
    assert dict(seen) == copies and mixed.columns == docs.columns
    packed = stages["packing"](spark, mixed, SF).collect()
    tokens = defaultdict(int)
    for r in packed:
        tokens[r.doc_id] += r.length
    whole = {r.doc_id: r.doc_tokens for r in packed}
    assert {i: n * copies[i] for i, n in whole.items()} == tokens
    assert set(whole) == set(copies)
    assert len(corpus_pipeline.run(spark, SF).collect()) == len(packed)


def test_odd_rows(spark):
    text = " ".join(f"some word{i}" for i in range(40))
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (None, text, None, None, None), (2, None, "en", "a", 0),
            (3, "", "en", None, 0), (4, text + " more", None, "b", None), (5, "z " * 100_000, "en", "b", 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept string")
    clashing = ("_row", "_words", "_features", "_copies", "_kept", "_rank", "_id", "_own", "size", "fp", "target", "bucket")
    for name in clashing:
        df = df.withColumn(name, F.lit("mine"))
    for rows_of in (df, df.where("doc_id = 77")):
        docs = rows_of
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert name == "packing" or out.columns == df.columns
            assert name == "packing" or out.where("kept <> 'x' OR _row <> 'mine' OR target <> 'mine'").count() == 0
            docs = spark.createDataFrame(out.collect(), out.schema)
        assert rows_of is df or docs.count() == 0
