"""Mixing sources to target weights by Pareto order sampling.

Built-in functions only. A source whose target is r times its size takes floor(r) whole
copies of every document for certain. What is left of its target is sampled: with
inclusion probability p = r - floor(r) and a uniform u that depends on the document
alone, documents come in the order of (u / (1 - u)) / (p / (1 - p)), and the sample is
as many of the first as fill the rest of the target to the nearest word.

A source may hold a third of all rows, so its documents are never sorted in one task.
Ranks are cut into ``BINS`` parts, sizes are summed per part on the map side, and only
the one part in which a source's target is reached is ordered document by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditmart.llm.common import durable, word_count

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BINS = 16_384
SEED = "mix-1"
#: Tables of one row per source are broadcast up to so many sources, and joined with a shuffle beyond.
BROADCAST_SOURCES = 50_000


def _per_source(rows: DataFrame) -> DataFrame:
    """A table of one row per source, broadcast where its counted size allows."""
    kept = durable(rows)
    return F.broadcast(kept) if kept.count() <= BROADCAST_SOURCES else kept


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from a document's id; the same in every run and engine."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, size): shares of all words by weight.

    Sources come by code point, null last, and weigh ``weights`` in turn. A target stops
    at ``max_copies`` times its source; the excess goes to the others by weight. With
    sources ordered by the level at which they are full, the level of the rest follows
    from running sums, without a loop. There is one row per source here, in one task.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.array(*map(F.lit, weights))[place % len(weights)].cast("double")
    full = (max_copies * F.col("source_size")).cast("double")
    ranked = by_source.withColumn("weight", weight).withColumn("full", full)
    order = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    ranked = ranked.withColumn("level", level).withColumn("open", F.col("full") > F.col("weight") * F.col("level"))
    rest = F.max(F.when(F.col("open"), F.col("level"))).over(everything)
    target = F.when(F.col("open"), F.col("weight") * rest).otherwise(F.col("full"))
    return ranked.select("source", "source_size", target.alias("target"))


def mixed(docs: DataFrame, size: Column | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of each row of ``docs``.

    ``size`` is the number of words unless given (null text: 0). Null sources are one
    source, the last. Documents of size 0 take no words. Rows that repeat an id share its random
    number and come one after the other; equal rows are interchangeable. A document has
    at most ``MAX_COPIES`` copies. An empty table gives an empty result.
    """
    size = word_count(F.col("text")) if size is None else size
    rows = durable(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            size.cast("long").alias("size"),
            uniform(F.col("doc_id")).alias("u"),
        )
    )
    goal = targets(rows).withColumns(
        {
            "same": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
            "copies": F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0)),
        }
    )
    goal = goal.withColumn("copies", F.least("copies", F.lit(MAX_COPIES)).cast("long"))
    goal = goal.withColumns(
        {
            "rest": F.greatest(F.col("target") - F.col("copies") * F.col("source_size"), F.lit(0.0)),
            "p": F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size") - F.col("copies")).otherwise(0.0),
        }
    )
    # one row per source, and no more sources than the caller's weights were made for
    keyed = rows.withColumn("same", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    odds = F.col("u") / (1 - F.col("u"))
    wanted = F.greatest(F.col("p"), F.lit(1e-12)) / (1 - F.least("p", F.lit(1 - 1e-12)))
    placed = keyed.join(_per_source(goal.drop("source")), "same").withColumn("rank", odds / wanted)
    placed = placed.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS).cast("int"))

    sums = placed.where("rest > 0 AND size > 0").groupBy("same", "bin", "rest").agg(F.sum("size").alias("bin_size"))
    running = Window.partitionBy("same").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    reached = sums.withColumn("before", F.coalesce(F.sum("bin_size").over(running), F.lit(0)).cast("long"))
    border = reached.where("before < rest AND before + bin_size >= rest").select(
        "same", F.col("bin").alias("border"), F.col("before").alias("border_before")
    )
    split = placed.join(_per_source(border), "same", "left")
    columns = ["doc_id", "source", "size", "source_size", "target", "copies"]
    whole = split.where("size = 0 OR rest <= 0 OR border IS NULL OR bin <> border")
    whole = whole.withColumn("extra", F.expr("size > 0 AND rest > 0 AND (border IS NULL OR bin < border)"))
    order = Window.partitionBy("same").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = split.where("size > 0 AND rest > 0 AND bin = border").withColumn(
        "sum_before", F.col("border_before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    )
    # the document in which the target falls is taken if most of it is below the target
    inside = inside.withColumn("extra", F.expr("sum_before + size / 2.0D <= rest"))
    both = whole.select(*columns, "extra").unionByName(inside.select(*columns, "extra"))
    copies = F.least(F.col("copies") + F.col("extra").cast("long"), F.lit(MAX_COPIES).cast("long"))
    both = both.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0).cast("long"))
    return both.withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` with every document as often as the mix takes it, all columns as they are.

    Documents of size 0 have no words to mix and leave, as do rows without a doc_id,
    which no decision can name.
    """
    found = mixed(docs.where("doc_id IS NOT NULL")).where("copies > 0")
    once = found.groupBy(F.col("doc_id").alias("_id")).agg(F.max("copies").cast("int").alias("_copies"))
    whole = docs.select(F.col("doc_id").alias("_own"), F.struct(*map(F.col, docs.columns)).alias("_row"))
    rows = whole.join(once, F.col("_own") == F.col("_id"))
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
