"""One query for each operator, over whole tables, and its SQL where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart.llm import (
    chat_format,
    html_extraction,
    mixing,
    nearest_neighbours,
    packing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    secret_scan,
    simhash_dedup,
    suffix_dedup,
    super_kmers,
    token_alignment,
)
from creditmart.llm.common import table


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents")).drop("kept")


def _held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~_held_out())
    model = quality_classifier.learn(docs, labels)
    found = quality_classifier.scored(docs, model)
    return found.select("doc_id", _held_out().alias("held_out"), "score", "predicted")


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judged(docs).drop("text", "log_ratio")


def packing_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat_format.read_back(chat_format.formatted(turns.unionByName(probe)))


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(table(spark, sf_dir, "pages"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scanned(table(spark, sf_dir, "documents"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _with_planted_run(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One row in ten repeats its words from some place on; a row without a doc_id none."""
    place = zlib.crc32(str(doc_id).encode())
    if doc_id is None or place % 10 or not words:
        return words
    place //= 10
    first = place % len(words)
    period = 1 + (len(words) - first) // (3 + place % 8)
    return [*words[:first], *(words[first + i % period] for i in range(len(words) - first))]


def periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.collapsed(table(spark, sf_dir, "documents"), rewrite=_with_planted_run)


def earlier_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return super_kmers.deduplicated(table(spark, sf_dir, "documents")).drop("kept")


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": repeats,
    "op2_quality_classifier": quality,
    "op3_simhash_dedup": simhash,
    "op4_quality_rules": rules,
    "op5_packing": packing_sequences,
    "op6_chat_format": chats,
    "op7_html_extraction": main_texts,
    "op8_secret_scan": secrets,
    "op9_nearest_neighbours": neighbours,
    "op10_source_mix": source_mix,
    "op11_periodic_runs": periodic,
    "op12_super_kmers": earlier_passages,
    "op13_token_alignment": alignment,
}

#: Fingerprints, hashed n-grams, token ids, trees and samples of hashes have no SQL; tests
#: hold those queries against brute force.
ORACLE_SQL: dict[str, str] = {
    "op10_source_mix": r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    (CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS DOUBLE) + 0.5)
      / 281474976710656.0 AS u
  FROM documents),
by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) AS full_size,
    CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS weight
  FROM by_source),
leveled AS (
  SELECT *,
    (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(full_size) OVER below, 0.0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0.0)) AS level
  FROM weighted
  WINDOW below AS (ORDER BY full_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size,
    CASE WHEN full_size > weight * level
      THEN weight * max(CASE WHEN full_size > weight * level THEN level END) OVER () ELSE full_size END AS target
  FROM leveled),
rates AS (
  SELECT *, least(3, coalesce(CAST(floor(target / nullif(source_size, 0)) AS BIGINT), 0)) AS copies FROM goals),
rests AS (
  SELECT *, greatest(target - copies * source_size, 0.0) AS rest,
    CASE WHEN source_size > 0 THEN target / source_size - copies ELSE 0.0 END AS p
  FROM rates),
ranked AS (
  SELECT s.doc_id, s.size, r.*,
    (s.u / (1 - s.u)) / (greatest(r.p, 1e-12) / (1 - least(r.p, 1 - 1e-12))) AS place
  FROM sized s JOIN rests r ON s.source IS NOT DISTINCT FROM r.source),
summed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM ranked WHERE size > 0)
SELECT doc_id, size, source_size, target,
  CAST(size * least(3, copies + CASE WHEN rest > 0 AND before + size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
UNION ALL
SELECT doc_id, size, source_size, target, CAST(0 AS BIGINT) FROM ranked WHERE size = 0""",
}
