"""Mixing sources to target weights, in DataFrame operations only.

Tokens are added up per source, each source gets a target by its weight, and a document is emitted
floor(rate) times plus once more with the probability of the fraction, where rate = target / tokens.
The decision is a hash of seed and key, so a rerun and a lost executor's retry take the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import with_ordinal_sorted
from ..session import materialize, small_side
from .packing import packed, unpacked

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: No source is repeated more often on average.
MOST = 3


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(docs: DataFrame, size: str, source: str = "source",
                   weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) for each distinct source, null last.

    Targets share the total by weight. A target above ``most`` times its source's size stops there
    and the excess is shared anew by weight, until none is above. Each round is one distributed sum
    over the table of sources, of which only the totals reach the driver. Sums are whole numbers,
    so the targets don't depend on the order of addition.
    """
    sums = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("bigint").alias("source_size"))
    sums = sums.withColumn("_null", F.col("source").isNull())
    # Binary comparison of UTF-8 is the order of code points.
    placed = with_ordinal_sorted(sums, ["_null", "source"], out="_place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_place") % len(weights) + 1).cast("int"))
    table = materialize(placed.select("source", "source_size", weight.cast("bigint").alias("_weight")), "sources")
    most_words = F.col("source_size") * most
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    fixed, share, level = 0, table.agg(F.coalesce(F.sum("_weight"), F.lit(0))).first()[0], None
    while share:
        level = (total - fixed, share)
        wide = "decimal(19,0)"
        above = (most_words.cast(wide) * F.lit(share).cast(wide)
                 <= F.lit(total - fixed).cast(wide) * F.col("_weight").cast(wide))
        capped, rest = table.agg(F.coalesce(F.sum(F.when(above, most_words)), F.lit(0)),
                                 F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0))).first()
        if (capped, rest) == (fixed, share):
            break
        fixed, share = capped, rest
    if level is None:
        target = F.lit(0.0)
    else:
        shared = F.lit(float(level[0])) * F.col("_weight") / F.lit(float(level[1]))
        target = F.least(most_words.cast("double"), shared)
    return table.select("source", "source_size", target.alias("target"))


def uniform(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) that depends on seed and keys only: 52 bits of an MD5."""
    text = F.concat_ws("|", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("\\N")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def with_copies(docs: DataFrame, size: str = "size", key: str = "doc_id", source: str = "source",
                weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = "mix-1") -> DataFrame:
    """Add source_size, target and ``copies``: how often the mix takes each document.

    Rows equal in ``key`` get the same number. A null source is a source of its own; an empty table
    and a source of no words give rate 0. Columns of ``docs`` with the added names are replaced.
    """
    kept = docs.drop("source_size", "target", "copies")
    targets = source_targets(kept, size, source, weights, most).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    more = (uniform(seed, F.col(key)) < rate - whole).cast("bigint")
    # Hot sources stay where they are if the table of sources is measured to be small.
    return (kept.join(small_side(targets), F.col(source).eqNullSafe(F.col("_source")), "left")
            .withColumn("copies", whole.cast("bigint") + more).drop("_source"))


def mix(docs: DataFrame, size: str | Column = "size", key: str = "doc_id", source: str = "source",
        text: str = "text", **options) -> DataFrame:
    """The mixed table: each row of ``docs`` as often as the mix takes it, with all its columns, whatever their names.

    ``size`` is a column or an expression over the columns of ``docs``.
    """
    size = F.col(size) if isinstance(size, str) else size
    rows = packed(docs, text, size=size, doc_id=F.col(key), source=F.col(source))
    placed = with_copies(rows, **options).where(F.col("copies") > 0)
    return unpacked(placed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), docs, text)
