"""Quality rules on whole texts, and a log-likelihood ratio of hashed n-grams.

Built-in functions only. Everything about a text is computed inside its row; the one
shuffle carries n-gram counts, which are combined on the map side into at most
``BUCKETS`` rows a task. The ratio of the two multinomials is one array of ``BUCKETS``
numbers, so its size does not depend on the corpus.

The n-grams are words, and pairs of marks: what words leave without their letters
(commas, digits, symbols), each with the next. Marks are few, so their counts are firm at
any size of the corpus and tell prose from lists, shouting and symbols in every language.

Trusted texts, which make up the target multinomial, are those that pass strict rules
of form (``TRUSTED``); the raw multinomial counts every text. Rules need no join, so
that no text is moved to find the trusted ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import words

BUCKETS = 16_384
#: Added to each bucket of both multinomials.
SMOOTHING = 1.0
#: Documents whose mean log ratio is below are rejected.
MIN_RATIO = -0.60
#: Form of a text whose n-grams count for the target.
TRUSTED = (
    "n_words >= 20 AND 100 * n_symbols <= n_words"
    " AND 100 * n_capitals <= 40 * n_words AND 100 * n_exclaimed <= 5 * n_words"
)

#: What a word loses to leave its marks.
LETTERS = r"[\p{L}\p{M}]+"

WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(grams: Column) -> Column:
    """Words in windows that occur twice or more, from the array of window hashes."""

    def repeated_starts(ordered: Column) -> Column:
        def start_if_repeated(k: Column) -> Column:
            here = ordered[k]
            before = (k > 0) & (ordered[F.greatest(k - 1, F.lit(0))]["gram"] == here["gram"])
            last = F.size(ordered) - 1
            after = (k < last) & (ordered[F.least(k + 1, last)]["gram"] == here["gram"])
            return F.when(before | after, here["at"])

        marked = F.transform(F.sequence(F.lit(0), F.size(ordered) - 1), start_if_repeated)
        return F.sort_array(F.filter(marked, lambda at: at.isNotNull()))

    def covered(starts: Column) -> Column:
        def step(state: Column, at: Column) -> Column:
            more = F.least(F.lit(WINDOW_WORDS), at - state["last"])
            return F.struct(at.alias("last"), (state["n"] + more).alias("n"))

        nothing = F.struct(F.lit(-WINDOW_WORDS).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(starts, nothing, step, lambda state: state["n"])

    indexed = F.transform(grams, lambda gram, at: F.struct(gram.alias("gram"), at.alias("at")))
    count = _let(F.sort_array(indexed), lambda ordered: _let(repeated_starts(ordered), covered))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(count)


def _windows(items: Column, size: int) -> Column:
    """Hash of each run of ``size`` items of an array."""
    starts = F.sequence(F.lit(0), F.size(items) - size)
    runs = F.transform(starts, lambda i: F.xxhash64(*(items[i + k] for k in range(size))))
    return F.when(F.size(items) >= size, runs).otherwise(F.array().cast("array<bigint>"))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of the rules and, as ``_features``, hashed words and pairs of marks."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    own = docs.withColumns(
        {"_words": words(F.col("text")), "_lines": lines, "_marks": F.regexp_replace(text, LETTERS, "")}
    )
    own = own.withColumn("_mark_words", words(F.col("_marks")))
    own = own.withColumn("_hashes", F.transform("_words", lambda word: F.xxhash64(word)))
    own = own.withColumn("_grams", _windows(F.col("_hashes"), WINDOW_WORDS))
    pairs = _windows(F.col("_mark_words"), 2)
    return own.select(
        *docs.columns,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_marks", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_grams")).cast("long").alias("n_repeat_words"),
        F.regexp_count(text, F.lit(r"\p{Lu}\p{Lu}+")).cast("long").alias("n_capitals"),
        F.regexp_count("_marks", F.lit(r"[!?]{2,}")).cast("long").alias("n_exclaimed"),
        F.transform(F.concat("_hashes", pairs), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")).alias("_features"),
    )


def log_ratios(rows: DataFrame) -> DataFrame:
    """One row: log(target share / raw share) of every bucket, in order, as ``ratios``.

    Counts cover the features of all rows; without a trusted row every ratio is 0.
    """
    spark = rows.sparkSession
    marked = rows.select("_features", F.expr(f"CAST({TRUSTED} AS LONG)").alias("trusted"))
    # the outer form: the plain one adds a filter on the array, which would be computed twice
    seen = marked.select(F.explode_outer("_features").alias("bucket"), "trusted").where("bucket IS NOT NULL")
    counts = seen.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("target"))
    none = spark.range(BUCKETS).select(
        F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("raw"), F.lit(0).cast("long").alias("target")
    )
    total = counts.unionByName(none).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    whole = total.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("all"),
        F.sum("raw").alias("raws"),
        F.sum("target").alias("targets"),
    )

    def ratio(x: Column) -> Column:
        target = (x["target"] + SMOOTHING) / (F.col("targets") + SMOOTHING * BUCKETS)
        raw = (x["raw"] + SMOOTHING) / (F.col("raws") + SMOOTHING * BUCKETS)
        return F.when(F.col("targets") == 0, F.lit(0.0)).otherwise(F.ln(target) - F.ln(raw))

    return whole.select(F.transform("all", ratio).alias("ratios"))


def _verdicts(docs: DataFrame, min_ratio: float) -> DataFrame:
    """The rows of ``docs`` as the struct ``_row``, beside what was found about each."""
    rows = measured(docs.select(F.struct(*map(F.col, docs.columns)).alias("_row"), "text"))
    ratios = log_ratios(measured(docs.select("text"))).first()["ratios"]  # BUCKETS numbers, whatever the corpus
    table = F.split(F.lit(",".join(f"{ratio:.6f}" for ratio in ratios)), ",").cast("array<double>")
    mean = F.aggregate("_features", F.lit(0.0), lambda total, bucket: total + table[bucket])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    ratio = F.when(F.size("_features") == 0, F.lit(0.0)).otherwise(mean / F.size("_features"))
    scored = rows.withColumns({"base_failed": failed, "log_ratio": ratio})
    scored = scored.withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= min_ratio))
    # results leave through a generator, so that a filter on them is not moved below and computed again
    return scored.select("_row", F.inline_outer(F.array(F.struct(*RESULTS))))


def judged(docs: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, log_ratio and kept.

    Null, empty and blank texts have no words and fail the base rules; log_ratio is then
    0. Repeated rows are judged alike and each counts in the raw corpus. Other columns
    stay; one that is named like a result gives way to it. An empty table stays empty.
    """
    own = [F.col("_row").getField(c).alias(c) for c in docs.columns if c not in RESULTS]
    return _verdicts(docs, min_ratio).select(*own, *RESULTS)


def kept(docs: DataFrame, min_ratio: float = MIN_RATIO) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are."""
    return _verdicts(docs, min_ratio).where("kept").select("_row.*")


RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "log_ratio", "kept",
)
