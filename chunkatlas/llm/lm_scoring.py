"""Language-model scoring with a probabilistic suffix tree, beside plain word counts.

The tree's symbols are the bytes of the running text: its words, ASCII letters in lower case, with one 0x20 between
them and 0x0A at the end. Contexts are the up to DEPTH bytes before a symbol, whatever word they belong to; before a
text's first byte stand 0x0A. A context becomes a state by its divergence from its parent, the context shorter by a
byte: each occurrence is predicted from the others of its context, smoothed with the parent's distribution, and the
log-likelihood gained over the parent's predictions has to pass ``GAIN``. A context seen once gains nothing, and one
that only repeats its parent's distribution loses, however often it is seen. A state's distribution is smoothed with
its parent's, and a symbol is scored in the state of the longest suffix.

A text is scored word by word, a word being its bytes and the 0x20 or 0x0A after it: the tree's probability of the
word is smoothed into the distribution of the trained words (Witten and Bell: with the weight of the number of kinds
of words, against that of the number of words), so that common words need not be spelled. The score is the logarithm
of the mean of two probabilities of the whole text: of its words in this mixture, and of its bytes in the tree alone,
where a text that follows learnt contexts closely is likelier than its words one by one. Both sum to 1.

A window is a symbol with the DEPTH bytes before it, as one number. One pass over the texts makes blocks: each sends
each of its windows and each of its words once, with their counts in trained texts, and keeps its texts. All
counts, states and probabilities are Spark tables; the driver gets none. Windows that only other texts have are in the
tables with a count of 0, so each window finds its own probability.
"""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .text import mix
from .wordtable import buckets_for, squeeze, unpack, unsqueeze

DEPTH = 4
#: Least log-likelihood that a state gains over its parent, in nats.
GAIN = 3.0
#: Bytes of text after which a block of windows is closed; longer texts are cut into pieces that keep their contexts.
BLOCK_BYTES = 2 << 20
_PAD = b"\n" * DEPTH
_LN10 = math.log(10)
_U = np.uint64
_MASKS = [_U((1 << (8 * n)) - 1) for n in range(9)]


def running(text: str | None) -> bytes:
    """The symbols of a text."""
    return b" ".join((text or "").encode().lower().split()) + b"\n"


def windows(data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct windows, sorted, of pieces laid end to end, and the number of each place's window.

    The first DEPTH bytes of each piece are context only. Windows grow byte by byte and are numbered anew each
    time, so they are mostly found by tables instead of a sort.
    """
    buf = np.frombuffer(data, np.uint8)
    own = np.ones(len(buf), bool)
    starts = np.cumsum(sizes) - sizes
    own[(starts[:, None] + np.arange(DEPTH)).ravel()] = False
    symbols, last = _numbered(buf, 256)
    names, place = symbols.astype(_U), last
    for length in range(1, DEPTH + 1):
        code = place[:-1].astype(np.int64) * len(symbols) + last[length:]
        if length == DEPTH:
            code = code[own[DEPTH:]]
        kinds, place = _numbered(code, len(names) * len(symbols))
        names = (names[kinds // len(symbols)] << _U(8)) | symbols[kinds % len(symbols)].astype(_U)
    return names, place


def _numbered(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct codes, which are below ``limit``, and the number of each."""
    if limit > 4 * BLOCK_BYTES:
        return np.unique(codes, return_inverse=True)
    there = np.zeros(limit, bool)
    there[codes] = True
    names = np.flatnonzero(there)
    numbers = np.empty(limit, np.int32)
    numbers[names] = np.arange(len(names), dtype=np.int32)
    return names, numbers[codes]


def _buckets(values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of sorted windows by bucket, and their buckets in that order."""
    bucket = (mix(values) % _U(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def _split(order: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for part in np.split(np.arange(len(order)), np.flatnonzero(np.diff(bucket)) + 1):
        if len(part):
            yield int(bucket[part[0]]), order[part]


_BLOCK = "block binary, bucket int, data binary, more binary, keys array<bigint>, ids array<string>, sizes array<int>"
_KINDS = {"block": pa.binary(), "bucket": pa.int32(), "data": pa.binary(), "more": pa.binary(),
          "keys": pa.list_(pa.int64()), "ids": pa.list_(pa.string()), "sizes": pa.list_(pa.int32())}


def _block(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS.values())], list(_KINDS))


def pieces_of(text: str | None) -> Iterator[bytes]:
    """The symbols of a text in pieces of whole words, each after the DEPTH bytes before it."""
    whole = _PAD + running(text)
    lo = DEPTH
    while lo < len(whole):
        hi = len(whole)
        if hi - lo > BLOCK_BYTES:
            hi = whole.find(b" ", lo + BLOCK_BYTES) + 1 or hi
        yield whole[lo - DEPTH:hi]
        lo = hi


def units(pieces: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The words of pieces, and how many each has. The text without words has the empty word."""
    found = [p[DEPTH:].split() or [b""] for p in pieces]
    return [w for f in found for w in f], np.array([len(f) for f in found], np.int64)


def numbered_words(words: list[bytes], buckets: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words, the number of each word's, their order by bucket, and the buckets in that order."""
    numbers: dict[bytes, int] = {}
    place = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    bucket = np.fromiter((zlib.crc32(w) % buckets for w in numbers), np.int32, len(numbers))
    order = np.argsort(bucket, kind="stable")
    return list(numbers), place, order, bucket[order]


def block_rows(docs: DataFrame, key: str, text: str, buckets: int, mark: Column) -> DataFrame:
    """Per block of text: its windows by bucket, each once, sorted, with their counts in marked texts; its words
    likewise, in the buckets from ``buckets`` on; and, in the bucket 2 * ``buckets``, the text, its pieces' keys and
    sizes, and a name of its own for each row of ``docs``, which a written table keeps.
    """
    def close(pieces: list[tuple[int, str, bool, bytes]]) -> pa.RecordBatch:
        keys, ids, marks, texts = zip(*pieces)
        data, sizes = b"".join(texts), np.array(list(map(len, texts)), np.int64)
        names, place = windows(data, sizes)
        counts = np.bincount(place[np.repeat(marks, sizes - DEPTH)], minlength=len(names)).astype(np.uint32)
        name = hashlib.blake2b(data + ids[0].encode(), digest_size=16).digest()
        rows = [(name, own, squeeze(names[at]), squeeze(counts[at]), None, None, None)
                for own, at in _split(*_buckets(names, buckets))]
        found, held = units(texts)
        words, place, order, bucket = numbered_words(found, buckets)
        counts = np.bincount(place[np.repeat(marks, held)], minlength=len(words)).astype(np.uint32)
        rows += [(name, buckets + own, zstandard.ZstdCompressor(level=3).compress(b"\n".join([words[i] for i in at.tolist()])),
                  squeeze(counts[at]), None, None, None) for own, at in _split(order, bucket)]
        packed = zstandard.ZstdCompressor(level=3).compress(data)
        return _block([*rows, (name, 2 * buckets, packed, None, keys, ids, sizes.tolist())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, held, task, number = [], 0, uuid.uuid4().hex, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for own, content, marked in zip(*(part.column(i).to_pylist() for i in range(3))):
                    number += 1
                    for piece in pieces_of(content):
                        pieces.append((own, f"{task}-{number}", marked, piece))
                        held += len(piece)
                        if held >= BLOCK_BYTES:
                            yield close(pieces)
                            pieces, held = [], 0
        if pieces:
            yield close(pieces)

    return (docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), mark.alias("mark"))
            .mapInArrow(run, _BLOCK))


def counted_words(rows: DataFrame) -> DataFrame:
    """Per row of words the sums of all rows' counts for each of its words; and, in one row per bucket, the number of
    words with a count, the sum of their counts, and the count of the empty word, which is in neither."""
    def answered(group: list[tuple]) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        places, counts = [], []
        for _, _, words, packed in group:
            places.append(np.array([known.setdefault(w, len(known)) for w in unpack(words)], np.int64))
            counts.append(unsqueeze(packed, np.uint32).astype(np.int64))
        total = np.zeros(len(known), np.int64)
        for at, n in zip(places, counts):
            total[at] += n
        empty = int(total[known[b""]]) if b"" in known else 0
        first = [int((total > 0).sum()) - (empty > 0), int(total.sum()) - empty, empty]
        return pa.RecordBatch.from_arrays([
            pa.array([g[0] for g in group], pa.binary()), pa.array([g[1] for g in group], pa.int32()),
            pa.array([squeeze(total[at]) for at in places], pa.binary()),
            *(pa.array([n] + [0] * (len(group) - 1), pa.int64()) for n in first)], ["block", "bucket", "data", "kinds", "total", "empty"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, now = [], None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if row[1] != now:
                    if group:
                        yield answered(group)
                    group, now = [], row[1]
                group.append(row)
        if group:
            yield answered(group)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.select("block", "bucket", "data", "more").repartition(parts, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(run, "block binary, bucket int, data binary, kinds bigint, total bigint, empty bigint"))


def window_counts(blocks: DataFrame, buckets: int) -> DataFrame:
    """(pair, n) of all windows, those without a count included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for values, counts in zip(*(batch.column(i).to_pylist() for i in range(2))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unsqueeze(values, np.int64)), pa.array(unsqueeze(counts, np.uint32).astype(np.int64))], ["pair", "n"])

    return (blocks.where(F.col("bucket") < buckets).select("data", "more").mapInArrow(run, "pair bigint, n bigint")
            .groupBy("pair").agg(F.sum("n").alias("n")))


def probabilities(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(pair, p): each window's probability of its symbol in the state of its longest suffix.

    Level by level, each context's pairs are joined with the same symbol's probability in the parent. A
    pair has at most 256 extensions by a byte and a context at most 256 symbols, so no key is hot.
    """
    out = None
    for length in range(depth + 1):
        own = counts
        if length < depth:
            pair = F.col("pair").bitwiseAND(F.lit((1 << (8 * (length + 1))) - 1))
            own = counts.groupBy(pair.alias("pair")).agg(F.sum("n").alias("n"))
        if out is None:
            own = own.withColumn("parent", F.lit(1 / 256))
        else:
            shorter = F.col("pair").bitwiseAND(F.lit((1 << (8 * length)) - 1))
            own = own.withColumn("_suffix", shorter).join(
                out.select(F.col("pair").alias("_suffix"), F.col("p").alias("parent")), "_suffix").drop("_suffix")
        context = Window.partitionBy("context")
        n = F.col("n").cast("double")
        seen = own.withColumn("context", F.shiftrightunsigned("pair", 8)).select(
            "pair", "n", "parent", "context", F.sum(n).over(context).alias("total"),
            F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).over(context).alias("kinds"))
        # Each occurrence predicted from the context's others.
        weight = F.col("kinds") + 1.0
        apart = F.when(F.col("n") > 0, n * F.log((n - 1 + weight * F.col("parent")) / (F.col("total") - 1 + weight) / F.col("parent")))
        step = seen.select("*", F.sum(F.coalesce(apart, F.lit(0.0))).over(context).alias("gain"))
        kept = F.lit(True) if not length else F.col("gain") >= GAIN
        smooth = (n + (F.col("kinds") + 1.0) * F.col("parent")) / (F.col("total") + F.col("kinds") + 1.0)
        out = step.select("pair", F.when(kept, smooth).otherwise(F.col("parent")).alias("p"))
    return out


def word_scores(blocks: DataFrame, words: DataFrame, buckets: int, kinds: int, total: int, empty: int,
                ends: int) -> DataFrame:
    """(id, key, n_tokens, n_known, base_score, score) of each row of ``docs`` that the blocks were made of."""
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, p = batch.column(0).to_numpy().view(_U), batch.column(1).to_numpy()
            yield _block([(None, own, squeeze(values[at]), squeeze(np.log10(p[at])), None, None, None)
                          for own, at in _split(*_buckets(values, buckets))])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, learnt, names, logs = None, [], None, None
        for batch in batches:
            rows = []
            for block, bucket, data, more in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if bucket != now:
                    now, learnt, names = bucket, [], None
                if block is None:
                    learnt.append((unsqueeze(data, _U), unsqueeze(more, np.float64)))
                    continue
                if names is None:
                    names, logs = (np.concatenate(c) for c in zip(*learnt))
                    order = np.argsort(names)
                    names, logs, learnt = names[order], logs[order], []
                found = logs[np.searchsorted(names, unsqueeze(data, _U))].astype(np.float32)
                rows.append((block, bucket, squeeze(found), None, None, None, None))
            yield _block(rows)

    tokens, spoken = total + ends, total + empty
    scale = np.log10(tokens + 0.5 * (kinds + (ends > 0) + 1))
    end = np.log10(ends + 0.5) - scale

    def scored(data: bytes, sizes: np.ndarray, got: dict[int, bytes]) -> list[np.ndarray]:
        """n_tokens, n_known, base_score, and the logs of both models, of each piece."""
        names, place = windows(data, sizes)
        logs = np.empty(len(names))
        for own, at in _split(*_buckets(names, buckets)):
            logs[at] = unsqueeze(got[own], np.float32)
        logs = logs[place]
        cuts = np.cumsum(sizes)
        texts = [data[hi - size:hi] for hi, size in zip(cuts.tolist(), sizes.tolist())]
        found, held = units(texts)
        words, place, order, bucket = numbered_words(found, buckets)
        counts = np.empty(len(words), np.int64)
        for own, at in _split(order, bucket):
            counts[at] = unsqueeze(got[buckets + own], np.int64)
        counts = counts[place]
        own = np.ones(len(data), bool)
        own[((cuts - sizes)[:, None] + np.arange(DEPTH)).ravel()] = False
        symbols = np.frombuffer(data, np.uint8)[own]
        stops = np.flatnonzero((symbols == 32) | (symbols == 10))
        spelled = np.add.reduceat(logs, np.concatenate(([0], stops[:-1] + 1)))
        closing = symbols[stops] == 10
        share = np.where(closing, ends, spoken - ends) / max(1, spoken)
        with np.errstate(divide="ignore"):
            whole = np.log10(counts * share)
        mixed = np.logaddexp(whole * _LN10, (spelled + np.log10(kinds + 1)) * _LN10) / _LN10 - np.log10(spoken + kinds + 1)
        piece = np.repeat(np.arange(len(sizes)), held)
        real = np.array([w != b"" for w in words], bool)[place]
        ended = np.bincount(piece, closing, len(sizes)).astype(np.int64)
        base = np.where(real, np.log10(counts + 0.5) - scale, 0.0)
        return [np.bincount(piece, real, len(sizes)).astype(np.int64) + ended,
                np.bincount(piece, real & (counts > 0), len(sizes)).astype(np.int64) + ended * int(ends > 0),
                np.bincount(piece, base, len(sizes)) + ended * end, np.bincount(piece, mixed, len(sizes)),
                np.bincount(piece, spelled, len(sizes))]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, got = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                block, bucket, data, _, keys, ids, sizes = (batch.column(c)[i].as_py() for c in range(7))
                if block != now:
                    now, got = block, {}
                if bucket < 2 * buckets:
                    got[bucket] = data
                    continue
                columns = scored(zstandard.ZstdDecompressor().decompress(data), np.array(sizes, np.int64), got)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys, pa.int64()), *map(pa.array, columns)],
                                                 ["id", "key", "n_tokens", "n_known", "base_score", "mixed", "spelled"])

    learnt = probabilities(materialize(window_counts(blocks, buckets), "grams")).mapInArrow(pack, _BLOCK)
    none = {"more": F.lit(None).cast("binary"), "keys": F.lit(None).cast("array<bigint>"),
            "ids": F.lit(None).cast("array<string>"), "sizes": F.lit(None).cast("array<int>")}
    answers = (blocks.where(F.col("bucket") < buckets).withColumn("more", none["more"]).unionByName(learnt)
               .repartition(parts, "bucket").sortWithinPartitions("bucket", F.col("block").asc_nulls_first())
               .mapInArrow(answer, _BLOCK))
    counts = words.select("block", "bucket", "data").withColumns(none)
    rows = (blocks.where(F.col("bucket") == 2 * buckets).unionByName(answers).unionByName(counts)
            .repartition(parts, "block").sortWithinPartitions("block", "bucket")
            .mapInArrow(add, "id string, key bigint, n_tokens bigint, n_known bigint, base_score double, mixed double, spelled double"))
    sums = rows.groupBy("id").agg(F.first("key").alias("key"), *(F.sum(c).alias(c) for c in (
        "n_tokens", "n_known", "base_score", "mixed", "spelled")))
    less = F.pow(F.lit(10.0), -F.abs(F.col("mixed") - F.col("spelled")))
    return sums.withColumn("score", F.greatest("mixed", "spelled") + F.log10((1 + less) / 2))


def held_out(key: Column, folds: int = 5, fold: int = 1) -> Column:
    """Whether CRC-32 of the key as text falls in the fold that isn't trained on; null counts as empty text."""
    content = F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")
    return F.pmod(F.crc32(content), F.lit(folds)) == fold


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 5, fold: int = 1) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    Tokens are the words, ASCII letters in lower case, and one end. base_score adds up smoothed word
    frequencies; score is the model's log10 probability of the same words in their order. A null or empty
    text is the end alone. If nothing is trained on, every token is unknown and the tree is uniform. ``key``
    is an integer column, which may be null or repeated; each row keeps its own score. Other columns are not
    read, whatever their names, and a table without rows gives none. A task holds a block of about 2 MB, or
    one longer word.
    """
    buckets = buckets_for(docs)
    own = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    train = ~held_out(F.col("key"), folds, fold)
    blocks = materialize(block_rows(own, "key", "text", buckets, train), "blocks")
    ends = own.where(train).count()
    words = materialize(counted_words(blocks.where((F.col("bucket") >= buckets) & (F.col("bucket") < 2 * buckets))), "words")
    kinds, total, empty = words.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("kinds", "total", "empty"))).first()
    scored = word_scores(blocks, words, buckets, kinds, total, empty, ends)
    return scored.select(F.col("key").alias(key), held_out(F.col("key"), folds, fold).alias("held_out"), "n_tokens", "n_known",
                         F.lit(total + ends).cast("bigint").alias("train_tokens"), "base_score", "score")
