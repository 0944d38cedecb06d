"""Sharding by jump consistent hashing: stable keys to shards without a ring table.

A key's shard depends on the key and the number of shards only. Going from n to n + 1 shards moves a
key either nowhere or into the new shard, and on average 1 / (n + 1) of all keys move.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Blocks per shard within which slots are numbered.
BLOCKS = 1024


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, by the published algorithm, for all keys at once."""
    state = keys.astype(np.uint64)
    shard = np.full(len(state), -1, np.int64)
    after = np.zeros(len(state), np.int64)
    open_ = np.arange(len(state))
    while len(open_):
        shard[open_] = after[open_]
        state[open_] = state[open_] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((state[open_] >> np.uint64(33)).astype(np.float64) + 1.0)
        after[open_] = ((shard[open_] + 1) * step).astype(np.int64)
        open_ = open_[after[open_] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Shard 0 .. shards - 1 of a column of any hashable type; null keys share one shard."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def place(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump(hashed.to_numpy(), shards).astype(np.int32))

    return place(F.xxhash64(key))


def with_shards(df: DataFrame, key: str, shards: int, order: list[str] | None = None) -> DataFrame:
    """Add ``shard``, ``grown_shard`` (with one shard more) and ``slot``, gapless from 0 per shard.

    No shard is sorted as a whole: slots are numbered within hash blocks of a shard, and a block
    starts where the earlier ones end. The table of starts has at most shards * BLOCKS rows, which
    bounds its broadcast. ``order`` (the key by default) settles the order within a block and should
    be unique; rows equal in it are interchangeable. A block is hashed from all of ``order``, so rows
    that share a key but not the rest are spread. An empty table gives an empty table; columns of
    ``df`` named shard, grown_shard or slot are replaced.
    """
    order = order or [key]
    kept = df.drop("shard", "grown_shard", "slot")
    placed = (kept.withColumn("shard", shard_of(F.col(key), shards))
              .withColumn("grown_shard", shard_of(F.col(key), shards + 1))
              .withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(BLOCKS)).cast("int")))
    sizes = placed.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "_block",
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("shard", "_block").orderBy(*order))
    return (placed.withColumn("_row", inside).join(F.broadcast(starts), ["shard", "_block"])
            .withColumn("slot", F.col("_start") + F.col("_row").cast("bigint") - 1)
            .select(*kept.columns, "shard", "grown_shard", "slot"))
