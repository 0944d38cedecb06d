"""Quality rules in DataFrame operations only: text statistics, and a likelihood ratio of hashed n-grams.

The ratio compares two multinomials over hash buckets of words and word pairs: one from documents
labelled as good (the target), one from all documents (the raw corpus). A document's score is the mean
log ratio over its own n-grams, and every document is held against the same threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_side
from .packing import packed, unpacked

SPACE = r"[\x20\x09-\x0D]+"
#: Hash buckets; also the bound of what is sent to the driver and back.
BUCKETS = 1 << 14
#: N-grams of the raw corpus that are added to the target's, in the raw corpus's proportions: with little
#: trusted text the ratios are near 0.
PRIOR = float(BUCKETS)
#: Least mean log ratio of a kept document, in nats.
THRESHOLD = -0.1
WINDOW = 5


def words(text: Column) -> Column:
    """Words as an array; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def ngram_buckets(words_: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all words and all pairs of neighbouring words."""
    def bucket(gram: Column) -> Column:
        return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")

    pairs = F.when(F.size(words_) > 1, F.transform(
        F.sequence(F.lit(1), F.size(words_) - 1), lambda i: bucket(F.slice(words_, i, 2))))
    none = F.array().cast("array<int>")
    return F.concat(F.transform(words_, bucket), F.coalesce(pairs, none))


def fit_ratio(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text",
              buckets: int = BUCKETS, prior: float = PRIOR) -> list[float]:
    """Log ratio per bucket, from the n-grams of all documents.

    ``trusted`` holds the keys of the target documents; repeats and keys without a document don't
    count. Partial counts leave the tasks, and one row per bucket reaches the driver. Without any
    trusted document all ratios are 0, as then nothing is known about the target.
    """
    good = small_side(trusted.select(F.col(key).alias("_key")).where("_key is not null").distinct())
    grams = (docs.select(F.col(key).alias("_own"), words(F.col(text)).alias("_words"))
             .join(good, F.col("_own") == F.col("_key"), "left")
             .select(F.col("_key").isNotNull().cast("bigint").alias("_good"),
                     F.explode(ngram_buckets(F.col("_words"), buckets)).alias("_bucket")))
    counts = grams.groupBy("_bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("_good").alias("good")).collect()
    raw, target = [0] * buckets, [0] * buckets
    for row in counts:
        raw[row["_bucket"]], target[row["_bucket"]] = row["raw"], row["good"]
    size, total = sum(target), sum(raw)
    if not size:
        return [0.0] * buckets
    return [math.log((t * total / r + prior) / (size + prior)) if r else 0.0 for t, r in zip(target, raw)]


def mean_ratio(words_: Column, ratios: list[float]) -> Column:
    """Mean log ratio over a document's n-grams; 0 for a document without words."""
    # One literal: the optimiser folds it before the query runs.
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    grams = ngram_buckets(words_, len(ratios))
    total = F.aggregate(grams, F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    return F.when(F.size(words_) > 0, total / (2 * F.size(words_) - 1)).otherwise(0.0)


def repeated_places(pairs: Column) -> Column:
    """Of (hash, place) pairs sorted by hash, the places whose hash a neighbour shares, sorted."""
    def same(x: Column, other: Column) -> Column:
        return F.coalesce(other["h"] == x["h"], F.lit(False))

    twins = F.filter(pairs, lambda x, i: same(x, F.get(pairs, i - 1)) | same(x, F.get(pairs, i + 1)))
    return F.sort_array(F.transform(twins, lambda x: x["i"]))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the array ``_words``.

    Null text counts as a text without words. Only documents in which a window occurs twice sort
    their windows. Columns of ``docs`` with the added names are replaced.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_words"]
    kept = docs.drop(*added)
    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(content, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    n = F.size("_words")
    windows = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, WINDOW))))
    step = (kept.withColumn("_words", words(F.col(text))).withColumn("_lines", lines)
            .withColumn("_windows", windows))
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = (step.withColumn("_pairs", F.when(twice, pairs))
            .withColumn("_places", repeated_places(F.col("_pairs"))))
    covered = F.aggregate(
        F.transform("_places", lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col("_places"), i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda acc, x: acc + x)
    return step.select(
        *kept.columns, "_words", n.cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(content, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def judge(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text",
          buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Add the statistics, base_failed, ratio and kept.

    base_failed: fewer than 10 words, or more than a fifth of the words lie in repeated windows. Every
    other document is kept exactly if its mean log ratio is at least ``threshold``. Equal texts get
    equal verdicts; repeated and null keys are judged like any others; an empty table stays empty.
    """
    added = ("base_failed", "ratio", "kept")
    ratios = fit_ratio(docs, trusted, key, text, buckets)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (with_statistics(docs.drop(*added), text)
            .withColumn("base_failed", failed)
            .withColumn("ratio", mean_ratio(F.col("_words"), ratios))
            .withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))
            .drop("_words"))


def keep_good(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns, whatever their names."""
    rows = packed(docs, text, doc_id=F.col(key))
    judged = judge(rows, trusted.select(F.col(key).alias("doc_id")), **options)
    # A filter on the verdict alone would be moved below the steps that it is made of, each of which
    # would then be written out within the next; one that also needs a row number stays behind them.
    kept = judged.withColumn("_row", F.monotonically_increasing_id()).where(F.col("kept") & (F.col("_row") >= 0))
    return unpacked(kept, docs, text)
