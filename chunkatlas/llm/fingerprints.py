"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the sorted array of the k smallest distinct 48-bit hashes of a text's word shingles. It can
be merged across parts, and estimates resemblance, containment and the number of distinct shingles.
A sketch of fewer than k hashes is the whole set, and its estimates are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import local_frame
from .text import shingle_sets, slices

K = 128
SHINGLE = 5
_BITS = 48
#: Stands for a null key in the order of keys.
_NULL = -(1 << 63)
#: Rows that are in Python at once.
_ROWS = 512
_LIST = pa.list_(pa.int64())
_NAMES = ["doc_id", "n_chars", "edited_sha256", "sketch", "edited_sketch", "next_sketch"]


def sketches(texts: list[bytes], k: int = K, n: int = SHINGLE) -> list[np.ndarray]:
    """Sketches of neighbouring texts, a slice of bounded size at a time."""
    out: list[np.ndarray] = []
    for lo, hi in slices(texts):
        # The hashes are sorted, so their leading bits are too.
        out += [np.unique(s[:2 * k] >> np.uint64(64 - _BITS))[:k].astype(np.int64)
                for s in shingle_sets(texts[lo:hi], n)]
    return out


def with_sketch(docs: DataFrame, text: str = "text", k: int = K, n: int = SHINGLE) -> DataFrame:
    """Add ``sketch``. Null and empty texts have an empty sketch, and equal texts have equal ones."""
    kept = docs.drop("sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content = [(t or "").encode() for t in batch.column(text).to_pylist()]
            yield batch.append_column("sketch", pa.array(sketches(content, k, n), pa.list_(pa.int64())))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{schema}, sketch array<bigint>")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two parts."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both have. 1 if both are empty."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) > 0, both / F.size(union)).otherwise(1.0)


def distinct(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) / the k-th hash as a fraction."""
    full = F.lit(float(k - 1)) / (F.get(a, F.lit(k - 1)) / F.lit(float(1 << _BITS)))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(full)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has; 1 if a is empty."""
    both = resemblance(a, b, k) * distinct(merged(a, b, k), k)
    return F.when(F.size(a) > 0, F.least(F.lit(1.0), both / distinct(a, k))).otherwise(1.0)


def merge_parts(parts: DataFrame, key: str, sketch: str = "sketch", k: int = K,
                spread: int = 64) -> DataFrame:
    """(key, sketch) of many parts per key.

    Parts are dealt by key and one of ``spread`` slots, merged there one by one, and then by key: a
    group's task holds one sketch, and a key that a third of all parts share is merged in many tasks.
    """
    columns = parts.select(F.col(key), F.col(sketch).alias("sketch"))
    kind = columns.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        last, have = None, None
        for batch in batches:
            schema = pa.schema([batch.schema.field(0), pa.field("sketch", pa.list_(pa.int64()))])
            keys, values, done = batch.column(0).to_pylist(), batch.column(1), []
            for i, at in enumerate(keys):
                more = np.asarray(values[i].values if values[i].is_valid else [], np.int64)
                if have is not None and at == last:
                    have = np.unique(np.concatenate((have, more)))[:k]
                    continue
                if have is not None:
                    done.append((last, have))
                last, have = at, np.unique(more)[:k]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if have is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], schema.field(0).type),
                                              pa.array([have], schema.field(1).type)], schema=schema)

    out = f"`{key}` {kind}, sketch array<bigint>"
    slot = F.pmod(F.xxhash64("sketch"), F.lit(spread))
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = columns.repartition(n, F.col(key), slot).sortWithinPartitions(key)
    once = dealt.mapInArrow(run, out)
    return once.repartition(n, F.col(key)).sortWithinPartitions(key).mapInArrow(run, out)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K,
                       n: int = SHINGLE) -> DataFrame:
    """(key, n_chars, edited_sha256, sketch, edited_sketch, next_sketch) of each document.

    ``key`` is an integer column; null comes before all numbers, and ties are ordered by text. A
    document's neighbour is the next in this order, the first after the last. Null text counts as
    empty; an empty table gives an empty table.

    Each range of keys is one sorted stream, with the next range's first document behind it, so no
    order of the whole table is made. Ranges are cut at quantiles of the key, four per shuffle
    partition, and only the cuts and the ranges' first keys reach the driver.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 4 * parts
    rows = docs.select(F.col(key).cast("bigint").alias("_key"),
                       F.coalesce(F.col(text), F.lit("")).alias("_text"))
    found = rows.agg(F.percentile_approx("_key", [i / ranges for i in range(1, ranges)], 10 * ranges))
    cuts = np.array(sorted(set(found.first()[0] or [])), np.int64)

    @F.pandas_udf("int")
    def bucket(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.fillna(_NULL).astype(np.int64), "right"), dtype="int32")

    order = F.coalesce(F.col("_key"), F.lit(_NULL))
    rows = rows.withColumn("_order", order).withColumn("_range", bucket(F.col("_order")))
    heads = sorted((r["_range"], r["at"]) for r in
                   rows.groupBy("_range").agg(F.min("_order").alias("at")).collect())
    behind = [(at, r, heads[i - 1][0]) for i, (r, at) in enumerate(heads)]
    first = local_frame(spark, behind, "_order bigint, _range int, _before int")
    # As many rows as there are ranges.
    ahead = (rows.join(F.broadcast(first), ["_order", "_range"])
             .groupBy("_order", F.col("_before").alias("_range")).agg(F.min("_text").alias("_text")))
    stream = rows.withColumn("_ahead", F.lit(False)).unionByName(ahead.select(
        F.lit(None).cast("bigint").alias("_key"), "_text", "_order", "_range", F.lit(True).alias("_ahead")))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                part = batch.slice(lo, _ROWS)
                texts = part.column(1).to_pylist()
                keys, ahead_ = part.column(0).to_pylist(), part.column(4).to_pylist()
                rows_ = list(zip(keys, texts, ahead_, sketches([t.encode() for t in texts], k, n)))
                if held:
                    rows_.insert(0, held)
                held = rows_[-1]
                pairs = [(a, b) for a, b in zip(rows_, rows_[1:]) if not a[2]]
                changed = [edited(a[1], b[1]).encode() for a, b in pairs]
                yield pa.RecordBatch.from_arrays([
                    pa.array([a[0] for a, _ in pairs], pa.int64()),
                    pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()),
                    pa.array([a[3] for a, _ in pairs], _LIST),
                    pa.array(sketches(changed, k, n), _LIST),
                    pa.array([b[3] for _, b in pairs], _LIST)], _NAMES)

    return (stream.select("_key", "_text", "_order", "_range", "_ahead")
            .repartition(parts, "_range").sortWithinPartitions("_range", "_ahead", "_order", "_text")
            .mapInArrow(walk, "doc_id bigint, n_chars bigint, edited_sha256 string, sketch array<bigint>, "
                              "edited_sketch array<bigint>, next_sketch array<bigint>")
            .withColumnRenamed("doc_id", key))


def as_text(sketch: Column) -> Column:
    """A sketch as hexadecimal text."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), _BITS // 4, "0")), "")
