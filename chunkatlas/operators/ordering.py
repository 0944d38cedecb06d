"""Positions, running sums, batches and first-k without a single-task sort.

A global ``row_number`` or running ``sum`` over an unpartitioned window sends every row to one
task. Both are done in two levels here: per block of neighbouring positions, and over the far
shorter table of block totals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import provider
from ..functions.dates import sub_micros
from ..session import materialize

#: Positions per block are 2 ** BLOCK_BITS: the most rows one window group holds.
BLOCK_BITS = 17
#: ``monotonically_increasing_id`` keeps the row number within a partition in its low bits.
_LOCAL_BITS = 33


def _before(value: Column, window: Window) -> Column:
    """Sum of ``value`` over the rows before the current one."""
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0)).cast("bigint")


def with_ordinal(df: DataFrame, rank: str = "search_rank", prefix: Sequence[str] = (),
                 out: str = "ordinal", base: int = 0,
                 sums: Mapping[str, tuple[str, int]] | None = None,
                 block_bits: int = BLOCK_BITS) -> DataFrame:
    """Number rows 0..n-1 in the order of ``(*prefix, rank)``.

    ``rank`` is a unique integer position (with gaps allowed) within each value of ``prefix``, and
    ``prefix`` is a short list of non-null columns with few values, such as the search number.
    ``sums`` maps an output column to a value column and a start: the start plus the sum of the
    value over all earlier rows.

    Blocks are cut from the rank itself, so no sampling pass is needed and the plan stays lazy: one
    exchange by block serves the join with the block totals and the window. A NULL in ``rank`` or
    ``prefix`` has no position and ends the job.
    """
    sums = dict(sums or {})
    keys = [*prefix, "_block"]
    unplaced = F.col(rank).isNull()
    for name in prefix:
        unplaced = unplaced | F.col(name).isNull()
    blocked = df.withColumn("_block", F.when(unplaced, F.raise_error(F.lit(
        f"NULL in {', '.join([*prefix, rank])}: a row without a position")).cast("bigint"))
        .otherwise(F.shiftright(F.col(rank), block_bits)))
    totals = blocked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(value).alias(f"_sum_{name}") for name, (value, _) in sums.items()])
    over_blocks, in_block = Window.orderBy(*keys), Window.partitionBy(*keys).orderBy(rank)
    starts = totals.select(
        *keys, _before(F.col("_n"), over_blocks).alias("_start"),
        *[_before(F.col(f"_sum_{name}"), over_blocks).alias(f"_start_{name}") for name in sums])
    columns = {out: F.col("_start") + F.row_number().over(in_block).cast("bigint")
               + F.lit(base - 1)}
    for name, (value, start) in sums.items():
        columns[name] = F.col(f"_start_{name}") + _before(F.col(value), in_block) + F.lit(start)
    return blocked.join(starts, keys).withColumns(columns).select(*df.columns, *columns)


def with_ordinal_sorted(df: DataFrame, order: Sequence[str | Column], out: str = "ordinal",
                        base: int = 0) -> DataFrame:
    """Number rows 0..n-1 in the order of any columns that together are unique.

    Spark's range-partitioned sort places the rows. The sorted rows are written once, since the
    boundaries it samples may differ between runs; the row number within a partition plus the rows
    in earlier partitions is the position.
    """
    placed = materialize(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright(F.col("_at"), _LOCAL_BITS)
    starts = (placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
              .select("_part", _before(F.col("_n"), Window.orderBy("_part")).alias("_start")))
    # At most one row per shuffle partition.
    return (placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn(out, F.col("_start") + F.col("_at").bitwiseAND((1 << _LOCAL_BITS) - 1)
                        + F.lit(base))
            .drop("_at", "_part", "_start"))


def order_by_start(prefix: Sequence[str] = (), rank: str = "search_rank") -> list[Column]:
    """Start time to the nanosecond, then search order."""
    return [F.col("begin"), sub_micros(F.col("begin_raw")), *map(F.col, prefix), F.col(rank)]


def assign_batches(links: DataFrame, rules: Sequence[tuple[str, str]], default: str,
                   size: int = 48, rank: str = "search_rank", url: str = "url") -> DataFrame:
    """Batch number from 1, number of batches, own provider and the provider of the batch's head."""
    total = links.agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("bigint")).scalar()
    # A window group holds one batch.
    in_batch = Window.partitionBy("batch_no").orderBy("ordinal")
    return (with_ordinal(links, rank)
            .withColumn("batch_no", F.expr(f"ordinal div {size} + 1"))
            .withColumn("batch_total", total)
            .withColumn("provider", provider(F.col(url), rules, default))
            .withColumn("batch_provider", F.first("provider").over(in_batch)))


def delete_batches(deletes: DataFrame, size: int = 1000, key: str = "key") -> DataFrame:
    """Number the keys of a delete plan in batches from 0, each of at most ``size`` keys."""
    return (with_ordinal_sorted(deletes, [key], out="_n")
            .withColumn("batch_no", F.expr(f"_n div {size}")).drop("_n"))


def first_k(df: DataFrame, k: int, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The first k rows, overall or per group. Each task passes on at most k rows (per group)."""
    if not by:
        return df.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
