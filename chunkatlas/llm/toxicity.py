"""Toxicity: a linear classifier of character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the n-grams of its code points (ASCII letters in lower case, white space as one kind of
character, a space before and after the text) that occur in it at all, hashed to 2**BITS numbers. Over all rows
with a training label the tasks count in how many texts of each class a feature is. Its log-count ratio is the
logarithm of its smoothed share among texts of label 1 over that among texts of label 0. The FEATURES
features with the highest chi-square statistic are the classifier's inputs, each scaled by its ratio. Weights
are fitted by logistic regression with a quadratic penalty on at most EACH texts of each class, those with the
lowest hashes of their keys, weighted so that each class has its share of all training rows.

The counts cover all training rows and the scores all texts; only the fit of the weights is bounded, by EACH and
FEATURES. What reaches the driver is at most FEATURES counts and 2 * EACH rows of at most FEATURES numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import local_frame, materialize, small_side
from .text import SLICE, slices, stream
from .wordtable import squeeze, unsqueeze

SIZES = (3, 4, 5, 6)
BITS = 20
FEATURES = 4096
EACH = 2048
#: Weight of the quadratic penalty beside the sum of the rows' losses.
PENALTY = 3.0
#: Feature numbers that travel together when counts are added up.
_SLAB = 1 << 14
_ROWS = 512
_U = np.uint64
_FACTORS = stream(11, max(SIZES)) | _U(1)
_PLAIN = np.arange(0x80, dtype=np.uint32)
_PLAIN[65:91] += 32
_PLAIN[9:14] = 32


@dataclass(frozen=True)
class Model:
    """Feature numbers in ascending order, what each adds to the log odds, and the log odds without any."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def probability(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(sums + self.bias, -500, 500)))


def grams(pieces: list[str], owners: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size of n-gram the feature numbers of all occurrences and the numbers of their texts."""
    codes = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(p) for p in pieces])
    plain = codes < 0x80
    codes = np.where(plain, _PLAIN[codes * plain], codes).astype(_U)
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), np.diff(ends, prepend=0))
    left = ends[piece] - np.arange(len(codes))
    sums = np.zeros(len(codes), _U)
    for j in range(max(SIZES)):
        sums = sums[:len(codes) - j] + codes[j:] * _FACTORS[j]
        if j + 1 in SIZES:
            inside = left[:len(sums)] > j
            yield (sums[inside] >> _U(64 - BITS)).astype(np.int32), owners[piece[:len(sums)][inside]]


def _pieces(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray]]:
    """The padded texts together if short, else pieces of them that overlap so that no n-gram is cut."""
    padded = [f" {t} " for t in texts]
    if sum(map(len, padded)) <= 2 * SLICE:
        yield padded, np.arange(len(texts))
        return
    for i, text in enumerate(padded):
        for at in range(0, max(1, len(text) - max(SIZES) + 1), SLICE):
            yield [text[at:at + SLICE + max(SIZES) - 1]], np.array([i])


def present(texts: list[str], place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of each text, as texts' numbers and feature numbers, in order.

    With ``place`` only features that it gives a number of 0 or more, as these numbers.
    """
    some = [np.zeros(0, np.int64)]
    for pieces, owners in _pieces(texts):
        for found, owner in grams(pieces, owners):
            if place is not None:
                found = place[found]
                hit = np.flatnonzero(found >= 0)
                found, owner = found[hit], owner[hit]
            some.append((owner.astype(np.int64) << 32) | found)
        if len(some) > 4 * len(SIZES):
            some = [np.unique(np.concatenate(some))]
    pairs = np.unique(np.concatenate(some))
    return pairs >> 32, pairs & 0xFFFFFFFF


def distinct(texts: list[str], seen: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The number of each text and its distinct features, in no order.

    Occurrences are told apart without sorting: ``seen``, a table by feature, takes each one's place in the
    text, and the one that stands there last is kept.
    """
    if sum(map(len, texts)) + 2 * len(texts) > 2 * SLICE:
        owner, found = present(texts)
        yield from enumerate(np.split(found, np.searchsorted(owner, np.arange(1, len(texts)))))
        return
    pieces, owners = next(_pieces(texts))
    sizes = [(found, np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()) for found, owner in grams(pieces, owners)]
    for i in range(len(texts)):
        every = np.concatenate([found[cuts[i]:cuts[i + 1]] for found, cuts in sizes])
        place = np.arange(len(every), dtype=seen.dtype)
        seen[every] = place
        yield i, every[seen[every] == place]


def _parts(batches: Iterator[pa.RecordBatch], *columns: int) -> Iterator[tuple[list, ...]]:
    """Slices of bounded size of the batches' rows; the first column is the text."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = [batch.column(c).slice(at, _ROWS).to_pylist() for c in columns]
            texts = [t or "" for t in part[0]]
            for lo, hi in slices(texts):
                yield texts[lo:hi], *(p[lo:hi] for p in part[1:])


def class_counts(rows: DataFrame) -> DataFrame:
    """feature, ones, zeros: in how many texts of each label a feature is. ``rows`` has text and label."""
    slabs = (1 << BITS) // _SLAB

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = np.zeros((2, 1 << BITS), np.int64), np.zeros(1 << BITS, np.int32)
        for texts, labels in _parts(batches, 0, 1):
            for i, found in distinct(texts, seen):
                sums[labels[i]][found] += 1
        cut = sums.reshape(2, slabs, _SLAB)
        used = np.flatnonzero(cut.any(axis=(0, 2))).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([squeeze(cut[:, s].ravel()) for s in used], pa.binary())], ["slab", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None

        def closed() -> pa.RecordBatch:
            used = np.flatnonzero(sums.any(axis=0))
            return pa.RecordBatch.from_arrays([pa.array(used + now * _SLAB, pa.int64()), pa.array(sums[1][used]),
                                               pa.array(sums[0][used])], ["feature", "ones", "zeros"])

        for batch in batches:
            for slab, counts in zip(*(batch.column(c).to_pylist() for c in (0, 1))):
                if slab != now:
                    if now is not None:
                        yield closed()
                    now, sums = slab, np.zeros((2, _SLAB), np.int64)
                sums += unsqueeze(counts, np.int64).reshape(2, _SLAB)
        if now is not None:
            yield closed()

    parts = rows.select("text", "label").mapInArrow(count, "slab int, counts binary")
    return (parts.repartition(slabs, "slab").sortWithinPartitions("slab")
            .mapInArrow(add, "feature bigint, ones bigint, zeros bigint"))


def best_features(counts: DataFrame, ones: int, zeros: int, limit: int = FEATURES) -> list[tuple[int, float]]:
    """(feature, log-count ratio) of the features with the highest chi-square statistic, by feature."""
    a, b = F.col("ones").cast("double"), F.col("zeros").cast("double")
    total, both = float(ones + zeros), a + b
    gap = a * (zeros - b) - b * (ones - a)
    spread = both * (total - both) * float(ones) * float(zeros)
    rated = counts.select(
        "feature", F.when(spread > 0, total * gap * gap / spread).otherwise(0.0).alias("chi"),
        (F.log((a + 1) / (ones + 2)) - F.log((b + 1) / (zeros + 2))).alias("ratio"))
    rows = rated.where("chi > 0 AND ratio != 0").orderBy(F.desc("chi"), "feature").limit(limit).collect()
    return sorted((r["feature"], r["ratio"]) for r in rows)


def fit(lists: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, ratios: np.ndarray,
        penalty: float = PENALTY, steps: int = 200) -> tuple[np.ndarray, float]:
    """Logistic regression on rows that hold the features of ``lists``, each worth its ratio, by L-BFGS."""
    at = np.concatenate(lists).astype(np.int64)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    worth, sign, k = ratios[at], labels * 2.0 - 1, len(ratios)
    share, penalty = weights / weights.sum(), penalty / len(lists)

    def value(x: np.ndarray) -> tuple[float, np.ndarray]:
        margin = sign * (np.bincount(row, x[at] * worth, len(lists)) + x[k])
        slope = -sign * share / (1 + np.exp(np.clip(margin, -500, 500)))
        grad = np.append(np.bincount(at, slope[row] * worth, k) + penalty * x[:k], slope.sum())
        return float(share @ np.logaddexp(0, -margin) + penalty / 2 * x[:k] @ x[:k]), grad

    x = np.zeros(k + 1)
    now, grad = value(x)
    history: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        way, alphas = grad.copy(), []
        for s, y, r in reversed(history):
            alphas.append(r * (s @ way))
            way -= alphas[-1] * y
        if history:
            s, y, _ = history[-1]
            way *= (s @ y) / (y @ y)
        else:
            way /= max(1.0, float(np.abs(grad).sum()))
        for (s, y, r), alpha in zip(history, reversed(alphas)):
            way += s * (alpha - r * (y @ way))
        size, down = 1.0, float(grad @ way)
        while size > 1e-10:
            there = x - size * way
            after, grad_there = value(there)
            if after <= now - 1e-4 * size * down:
                break
            size /= 2
        else:
            break
        s, y = there - x, grad_there - grad
        gained = now - after
        x, now, grad = there, after, grad_there
        if s @ y > 1e-12:
            history = [*history[-9:], (s, y, 1 / float(s @ y))]
        if gained < 1e-9:
            break
    return x[:k] * ratios, float(x[k])


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          each: int = EACH, limit: int = FEATURES) -> Model:
    """The classifier of rows of ``docs`` whose key has a label in ``labels``.

    Of a key with several labels the highest counts; null labels and keys have none. Without rows of both
    classes every text gets the share of label 1, and 0 without any row.
    """
    spark = docs.sparkSession
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
             .groupBy(F.col(key).cast("bigint").alias("key")).agg(F.max(F.col(label) > 0).cast("int").alias("label")))
    known = materialize(known, "labels")
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    sizes = {r["label"]: r["n"] for r in rows.select("key").join(small_side(known), "key").groupBy("label")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    if not ones or not zeros:
        share = 1.0 if ones else 0.0
        return Model(np.zeros(0, np.int64), np.zeros(0), 500.0 if share else -500.0)
    best = best_features(class_counts(rows.join(small_side(known), "key")), ones, zeros, limit)
    features, ratios = np.array([f for f, _ in best], np.int64), np.array([r for _, r in best])
    place = np.full(1 << BITS, -1, np.int32)
    place[features] = np.arange(len(features))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, marks, keys in _parts(batches, 0, 1, 2):
            owner, at = present(texts, place)
            cuts = np.searchsorted(owner, np.arange(1, len(texts)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(marks, pa.int32()),
                 pa.array([x.astype(np.int32).tobytes() for x in np.split(at, cuts)], pa.binary())], ["key", "label", "found"])

    by_hash = [F.xxhash64("key"), "key"]
    present_keys = known.join(rows.select("key").distinct(), "key", "left_semi")
    sample = (present_keys.where("label = 1").orderBy(*by_hash).limit(each)
              .unionAll(present_keys.where("label = 0").orderBy(*by_hash).limit(each)))
    picked = local_frame(spark, [tuple(r) for r in sample.select("key", "label").collect()], "key bigint, label int")
    # One row per key: of rows with a repeated key the one with the lowest text hash.
    got = (rows.join(F.broadcast(picked), "key").select("text", "label", "key")
           .mapInArrow(learn, "key bigint, label int, found binary")
           .groupBy("key").agg(F.min(F.struct("found", "label")).alias("row")).select("key", "row.*").orderBy("key").collect())
    marks = np.array([r["label"] for r in got])
    share = np.where(marks == 1, ones / max(1, (marks == 1).sum()), zeros / max(1, (marks == 0).sum()))
    weights, bias = fit([np.frombuffer(r["found"], np.int32) for r in got], marks, share, ratios)
    return Model(features, weights, bias)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score (0 to 1) of every row; null and empty texts have no features, only the model's bias.

    Equal texts have equal scores whatever their other columns, which are not read. Null and repeated keys
    stay rows of their own. A task holds a slice of about 1 MB of texts, or one longer text.
    """
    place = np.full(1 << BITS, -1, np.int32)
    place[model.features] = np.arange(len(model.features))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, keys in _parts(batches, 0, 1):
            owner, at = present(texts, place)
            sums = np.bincount(owner, model.weights[at], len(texts)) if len(at) else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(model.probability(sums))],
                                             ["key", "score"])

    return (docs.select(F.col(text).alias("text"), F.col(key).cast("bigint").alias("key"))
            .mapInArrow(run, "key bigint, score double").withColumnRenamed("key", key))


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the key as text falls in a fold; a null key counts as the text ``\\N``."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("\\N")).cast("binary")) % folds == fold
