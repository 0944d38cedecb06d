"""MinHash near-duplicates with odd sketches.

MinHash samples of a text's shingle set are banded: sets that share a band are candidates. The samples
are also folded into a bitmap of parities; the number of bits in which two bitmaps differ estimates the
similarity of similar sets closely, which drops most false candidates before full sets are compared.
Every link that counts is confirmed on full sets.

With 256 samples, 32 bands of 4 (of the first 128) miss a pair of similarity 0.8 with probability 5e-8,
and the estimate of such a pair, whose standard deviation is about 0.025, is below 0.68 about once in a
million times. Both are less likely for more similar pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, small_side
from .packing import packed, unpacked
from .graph import components
from .text import mix, shingle_sets, slices, stream

SAMPLES, BANDS, BAND_ROWS = 256, 32, 4
BITS = 1024
ESTIMATE = 0.68
TILE = 256
_U = np.uint64
_MULTIPLY = stream(3, SAMPLES) | _U(1)
_ADD = stream(4, SAMPLES)
_SALT = stream(5, SAMPLES)
_ROWS = 1024


def set_ids(sets: list[np.ndarray]) -> list[bytes]:
    """16 bytes that identify a set: two sums of independent hashes of its elements."""
    return [np.array([mix(s ^ _SALT[0]).sum(dtype=_U), mix(s ^ _SALT[1]).sum(dtype=_U) + _U(len(s))],
                     _U).tobytes() for s in sets]


def samples(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples, one row per non-empty set."""
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), SAMPLES), _U)
    for i in range(SAMPLES):
        out[:, i] = np.minimum.reduceat(flat * _MULTIPLY[i] + _ADD[i], starts)
    return out


def bands(sampled: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, different for different bands."""
    used = sampled[:, :BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS)
    keys = mix((used * (_MULTIPLY[:BAND_ROWS])).sum(axis=2, dtype=_U) + _SALT[:BANDS])
    return keys.view(np.int64)


def odd_sketch(sampled: np.ndarray) -> np.ndarray:
    """Bitmaps in which the bit of each sample is flipped, as rows of 64-bit words."""
    place = (mix(sampled ^ _SALT) % _U(BITS)).astype(np.int64) + np.arange(len(sampled))[:, None] * BITS
    parity = np.bincount(place.ravel(), minlength=len(sampled) * BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(-1, BITS), axis=1).view(_U)


def estimate(odd: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarities of all pairs of two groups of odd sketches."""
    differ = np.zeros((len(odd), len(others)), np.int64)
    for w in range(odd.shape[1]):
        differ += np.bitwise_count(odd[:, w, None] ^ others[None, :, w])
    share = np.minimum(2.0 * differ / BITS, 1 - 1e-9)
    return 1 + BITS * np.log1p(-share) / (4.0 * SAMPLES)


def signatures(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(key, n_shingles, set_id, bands, odd); the last three are null for a text without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                texts = [(t or "").encode() for t in part.column(1).to_pylist()]
                size, ids, keys, odd = [], [], [], []
                for lo, hi in slices(texts):
                    sets = shingle_sets(texts[lo:hi], n)
                    full = [s for s in sets if len(s)]
                    size += map(len, sets)
                    if full:
                        sampled = samples(full)
                        found = iter(zip(set_ids(full), bands(sampled), odd_sketch(sampled)))
                    for s in sets:
                        one = next(found) if len(s) else (None, None, None)
                        ids.append(one[0])
                        keys.append(one[1])
                        odd.append(None if one[2] is None else one[2].tobytes())
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(size, pa.int64()), pa.array(ids, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(odd, pa.binary())],
                    ["key", "n_shingles", "set_id", "bands", "odd"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"key {kind}, n_shingles bigint, set_id binary, bands array<bigint>, odd binary")


def full_sets(docs: DataFrame, key: str, text: str, n: int, wanted: DataFrame) -> DataFrame:
    """(set_id, elements) of the wanted keys' texts, once per set; elements are sorted 64-bit hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                texts = [(t or "").encode() for t in batch.slice(at, _ROWS).column(0).to_pylist()]
                sets = [s for lo, hi in slices(texts) for s in shingle_sets(texts[lo:hi], n) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_ids(sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["set_id", "elements"])

    picked = docs.select(F.col(key).alias("_own"), F.col(text).alias("_text")).join(
        small_side(wanted.select(F.col("key").alias("_key"))), F.col("_own").eqNullSafe(F.col("_key")), "left_semi")
    return picked.select("_text").mapInArrow(run, "set_id binary, elements binary").dropDuplicates(["set_id"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union.

    A set a with many partners is dealt to several tasks by a hash of the partner, and its elements
    go along once per task. A task streams over the partners and holds the elements of one set a.
    """
    dealt = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(64)).cast("int"))
    partners = dealt.join(sets.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "elements")
    heads = (dealt.select("a", "salt").distinct().join(sets.withColumnRenamed("node", "a"), "a")
             .select("a", "salt", F.lit(None).cast("bigint").alias("b"), "elements"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.zeros(0, _U)
        for batch in batches:
            found = []
            for a, b, elements in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                other = np.frombuffer(elements, _U)
                if b is None:
                    have = other
                elif alike(have, other, percent):
                    found.append((a, b))
            yield _pairs(found)

    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (heads.unionByName(partners).repartition(parts, "a", "salt")
            .sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
            .mapInArrow(run, "a bigint, b bigint"))


def alike(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    at = np.minimum(np.searchsorted(one, other), len(one) - 1)
    both = int((one[at] == other).sum())
    return 100 * both >= percent * (len(one) + len(other) - both)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5,
                    percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) per row of ``docs``.

    Texts link if their sets of n-word shingles (ASCII letters in lower case; a text of fewer words is
    one shingle) have a similarity of at least ``percent`` / 100. component_id is the least key that
    links lead to; kept is key = component_id. A null or wordless text links with nothing and is kept.
    Rows with equal key and set are equal rows, so each of them is kept; a null key is never the least
    unless all of its component are null, and then the row is kept.

    Equal sets are one node, so thousands of copies cost one comparison. In each bucket of a band all
    nodes are first held against the bucket's least node: pairs grow with the bucket, not its square.
    Where a bucket's nodes are then in different components, the nodes that such buckets connect are
    searched for links between components, in tiles of about ``TILE`` nodes that bring their full sets
    along. Nodes of a group's largest component meet only those outside it. No candidate is left out,
    no bucket has a cap, and a tile passes on only as many links as join its components.
    """
    signed = materialize(signatures(docs, key, text, n), "signatures")
    # The node number is fixed by writing it.
    nodes = materialize(signed.where("set_id is not null").groupBy("set_id").agg(
        F.min("key").alias("key"), F.first("bands").alias("bands"), F.first("odd").alias("odd"))
        .withColumn("node", F.monotonically_increasing_id()), "sets")
    roots = components(_links(docs, key, text, n, percent, nodes))
    placed = nodes.select("set_id", "key", "node").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("key").alias("component_id"))
    of_set = placed.join(least, "root").select("set_id", "component_id")
    with_set = signed.where("set_id is not null").select("key", "n_shingles", "set_id").join(of_set, "set_id")
    alone = signed.where("set_id is null").select("key", "n_shingles", "set_id", F.col("key").alias("component_id"))
    return (with_set.unionByName(alone)
            .select(F.col("key").alias(key), "n_shingles", "component_id",
                    F.col("key").eqNullSafe(F.col("component_id")).alias("kept")))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5,
                percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the least key.

    Only equal or near-equal texts go: rows that share a key but not their text are rows like any others. Null
    keys all stay. The rows are numbered by writing them, so the row that is judged is the row that stays;
    all their columns stay, whatever their names.
    """
    rows = materialize(packed(docs, text, key=F.col(key), row=F.monotonically_increasing_id()), "rows")
    rows = rows.withColumn("id", F.struct(F.col("key").isNull().alias("none"), "key", "row"))
    gone = near_duplicates(rows, "id", "text", n, percent).where(~F.col("kept") & ~F.col("id.none")).select("id.row")
    return unpacked(rows.join(small_side(materialize(gone, "gone")), "row", "left_anti"), docs, text)


def _links(docs: DataFrame, key: str, text: str, n: int, percent: int, nodes: DataFrame) -> DataFrame:
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = materialize(banded.groupBy("bucket").agg(
        F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "leader"), "buckets")
    members = materialize(banded.join(small_side(shared), "bucket"), "members")
    stars = materialize(members.where("node != leader").select(
        F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi")
    sets = materialize(full_sets(docs, key, text, n, wanted)
                       .join(nodes.select("set_id", "node"), "set_id").select("node", "elements"), "elements")
    first = materialize(confirm(stars, sets, percent), "links")
    second = materialize(_across(members, nodes, sets, components(first), percent), "links")
    return first.unionByName(second)


def _across(members: DataFrame, nodes: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components that share a bucket: enough of them to join what they join."""
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    open_ = placed.join(mixed.select("bucket"), "bucket").select("node", "leader", "root").distinct()
    groups = components(open_.select(F.col("leader").alias("a"), F.col("node").alias("b"))).select(
        "node", F.col("root").alias("group"))
    rows = materialize(open_.select("node", "root").distinct().join(groups, "node"), "open")
    counts = rows.groupBy("group", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("group").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("all"))
    tiles = largest.select(
        "group", F.col("most.root").alias("main"),
        F.expr(f"cast((all - most.n - 1) div {TILE} + 1 as int)").alias("rest_tiles"),
        F.expr(f"cast((most.n - 1) div {TILE} + 1 as int)").alias("main_tiles"))
    is_main, slot = F.col("root") == F.col("main"), F.xxhash64("node")
    dealt = rows.join(tiles, "group").withColumn("tile", F.when(
        is_main, F.col("rest_tiles") + F.pmod(slot, F.col("main_tiles"))).otherwise(
        F.pmod(slot, F.col("rest_tiles"))).cast("int"))
    meets = F.sequence(F.lit(0), F.when(is_main, F.col("rest_tiles") - 1).otherwise(
        F.col("rest_tiles") + F.col("main_tiles") - 1))
    spread = (dealt.join(nodes.select("node", "odd"), "node").join(sets, "node")
              .withColumn("other", F.explode(meets))
              .select("group", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"),
                      "tile", "node", "root", "odd", "elements"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if group and group[0][:3] != row[:3]:
                    yield _pairs(_joins(group, percent))
                    group = []
                group.append(row)
        yield _pairs(_joins(group, percent))

    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (spread.repartition(parts, "group", "lo", "hi").sortWithinPartitions("group", "lo", "hi")
            .mapInArrow(run, "a bigint, b bigint"))


def _joins(group: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Confirmed links between the two tiles of a group, until they join all components that any link joins."""
    if not group:
        return []
    lo, hi = group[0][1:3]
    left = [r for r in group if r[3] == lo]
    right = left if lo == hi else [r for r in group if r[3] == hi]
    if not left or not right:
        return []
    odd, sets = [[np.frombuffer(r[6], _U) for r in side] for side in (left, right)], [
        [np.frombuffer(r[7], _U) for r in side] for side in (left, right)]
    likeness = estimate(np.array(odd[0]), np.array(odd[1]))
    likeness[np.array([r[5] for r in left])[:, None] == np.array([r[5] for r in right])[None, :]] = -1
    if lo == hi:
        likeness[~np.tri(len(left), k=-1, dtype=bool)] = -1
    i, j = np.nonzero(likeness >= ESTIMATE)
    # The likeliest first: they join most components at once, and joined ones need no further test.
    order = np.argsort(-likeness[i, j], kind="stable")
    leads: dict[int, int] = {}

    def lead(x: int) -> int:
        while x in leads:
            x = leads[x]
        return x

    found = []
    for x, y in zip(i[order].tolist(), j[order].tolist()):
        a, b = sorted((lead(left[x][5]), lead(right[y][5])))
        if a != b and alike(sets[0][x], sets[1][y], percent):
            leads[b] = a
            found.append((left[x][4], right[y][4]))
    return found
