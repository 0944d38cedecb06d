"""Phrase collocations by prefix-free parsing.

A text becomes its words, with a mark between pieces and WINDOW marks at its end. Where the hash of WINDOW
neighbouring words (or marks) is a multiple of SPACING, a chunk ends with them and the next chunk starts with
them, so that chunks overlap by WINDOW words and equal passages are cut alike wherever they stand. The parse
is a dictionary of distinct chunks with their frequencies. An n-gram of up to WINDOW + 1 words belongs to the
chunk in which it starts before the overlap, and it lies whole in that chunk; so counting the n-grams inside
distinct chunks, each weighted by its chunk's frequency, counts every occurrence once.

The n-grams of a dictionary block are first counted by their 64-bit hashes: each block sends sorted hashes and
weights, cut into ranges, and a range's task answers each block with one bit per hash, set if the hash has
``least`` occurrences in all blocks. An n-gram with that many always passes; only those that pass are counted as
text, and the exact counts decide. Chunks and n-grams travel once per block, so a phrase that is in every text
is no hot key.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, small_side
from .text import _ODD, mix, slices, word_spans
from .wordtable import squeeze, unsqueeze

#: Words that neighbouring chunks share, and the mean number of words between cuts.
WINDOW = 2
SPACING = 12
LONGEST = WINDOW + 1
LEAST = 10
#: A longer candidate takes a phrase's place with this share of its occurrences, in percent.
SHARE = 50
#: Bytes of text after which a block is closed; bytes of text per bucket of chunks; hashes per range.
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 12 << 20
RANGE_HASHES = 1 << 21
_ROWS = 512
_MARK = b"\xff"
_U = np.uint64
_TABLE = bytearray(range(256))
for _byte in b".,;:!?\n\v\f\r":
    _TABLE[_byte] = _MARK[0]
for _byte in range(65, 91):
    _TABLE[_byte] += 32
_TABLE = bytes(_TABLE)
_MARK_HASH = word_spans([_MARK], False)[0][0]
_TAIL = b" " + b" ".join([_MARK] * WINDOW)

_CHUNKS = "lang string, bucket int, n int, chunks binary, counts binary"
_BLOCKS = "lang string, block binary, n_words bigint, n_hashes bigint, chunks binary, counts binary"


def marked(text: bytes) -> bytes:
    """The words and marks of a text, one space between them. 0xFF is in no UTF-8 text."""
    words = text.translate(_TABLE).replace(_MARK, b" \xff ").split()
    return b" ".join(words) + _TAIL if words else _TAIL[1:]


def chunks_of(texts: list[bytes]) -> list[bytes]:
    """The chunks of marked texts, in order."""
    joined = b"".join(texts)
    hashes, starts, ends, edges = word_spans(texts, False)
    triggers = mix(hashes[:-1] * _U(_ODD) + hashes[1:]) % _U(SPACING) == 0
    # The first WINDOW words of a text begin its first chunk, the last WINDOW marks end its last one.
    first, last = edges[:-1], edges[1:] - WINDOW
    cut = np.zeros(len(hashes), bool)
    cut[:-1] = triggers
    for side in range(1, WINDOW):
        cut[edges[1:] - side] = False
    cut[first] = cut[last] = True
    at = np.flatnonzero(cut)
    begins, stops = at[:-1], at[1:]
    same = ~np.isin(begins, last)
    return [joined[a:b] for a, b in zip(starts[begins[same]].tolist(), ends[stops[same] + WINDOW - 1].tolist())]


def grams(chunks: list[bytes], seed: int) -> tuple[np.ndarray, ...]:
    """Of all n-grams that start before the overlap: hash, first byte, end byte, chunk's number and words."""
    hashes, starts, ends, edges = word_spans(chunks, False)
    owner = np.repeat(np.arange(len(chunks)), np.diff(edges))
    word = hashes != _MARK_HASH
    at = np.flatnonzero(word & (np.arange(len(hashes)) < edges[1:][owner] - WINDOW))
    out, rolled = [], mix(hashes[at] + _U(seed))
    for n in range(1, LONGEST + 1):
        out.append((rolled, starts[at], ends[at + n - 1], owner[at], np.full(len(at), n, np.int8)))
        if n < LONGEST:
            on = word[at + n]
            at, rolled = at[on], rolled[on]
            rolled = mix(rolled * _U(_ODD) + hashes[at + n])
    return tuple(np.concatenate(column) for column in zip(*out))


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _pack(chunks: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"\n".join(chunks))


def _unpack(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


def _record(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))


def _weighted(hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order and the sums of their weights."""
    order = np.argsort(hashes)
    hashes, weights = hashes[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, int)
    return hashes[first], np.add.reduceat(weights, first) if len(first) else weights


def chunk_rows(docs: DataFrame, buckets: int) -> DataFrame:
    """Each block's distinct chunks with their numbers of occurrences, by language and bucket."""
    kinds = {"lang": pa.string(), "bucket": pa.int32(), "n": pa.int32(), "chunks": pa.binary(), "counts": pa.binary()}

    def closed(found: dict[str, dict[bytes, int]]) -> pa.RecordBatch:
        rows = []
        for lang, counts in found.items():
            by_bucket = defaultdict(list)
            for chunk in counts:
                by_bucket[zlib.crc32(chunk) % buckets].append(chunk)
            rows += [(lang, bucket, len(some), _pack(some), squeeze(np.array([counts[c] for c in some], np.int64)))
                     for bucket, some in by_bucket.items()]
        return _record(rows, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = defaultdict(lambda: defaultdict(int)), 0
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                langs = part.column(0).to_pylist()
                texts = [marked(t or b"") for t in part.column(1).cast(pa.binary()).to_pylist()]
                by_lang = defaultdict(list)
                for lang, text in zip(langs, texts):
                    by_lang[lang].append(text)
                for lang, own in by_lang.items():
                    for lo, hi in slices(own):
                        counts = found[lang]
                        for chunk in chunks_of(own[lo:hi]):
                            counts[chunk] += 1
                held += sum(map(len, texts))
                if held >= BLOCK_BYTES:
                    yield closed(found)
                    found, held = defaultdict(lambda: defaultdict(int)), 0
        yield closed(found)

    return docs.mapInArrow(run, _CHUNKS)


def dictionary(chunks: DataFrame) -> DataFrame:
    """The distinct chunks of all blocks, in blocks of their own, with their frequencies."""
    kinds = {"lang": pa.string(), "block": pa.binary(), "n_words": pa.int64(), "n_hashes": pa.int64(),
             "chunks": pa.binary(), "counts": pa.binary()}

    def closed(lang: str, counts: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        names = list(counts)
        # About half a block each, so that a block's n-grams are few at a time.
        for lo, hi in slices(names, BLOCK_BYTES // 2):
            own, weights = names[lo:hi], np.array([counts[c] for c in names[lo:hi]], np.int64)
            owner = _starts(own)
            packed = _pack(own)
            name = hashlib.blake2b(lang.encode() + b"\n" + packed, digest_size=16).digest()
            yield _record([(lang, name, int(weights[owner].sum()), LONGEST * len(owner), packed, squeeze(weights))], kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, {}
        for batch in batches:
            for lang, bucket, chunks, weights in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if (lang, bucket) != now:
                    if now:
                        yield from closed(now[0], counts)
                    now, counts = (lang, bucket), {}
                for chunk, n in zip(_unpack(chunks), unsqueeze(weights, np.int64).tolist()):
                    counts[chunk] = counts.get(chunk, 0) + n
        if now:
            yield from closed(now[0], counts)

    parts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (chunks.select("lang", "bucket", "chunks", "counts").repartition(parts, "lang", "bucket")
            .sortWithinPartitions("lang", "bucket").mapInArrow(run, _BLOCKS))


def _starts(chunks: list[bytes]) -> np.ndarray:
    """For each word before the overlap the number of its chunk."""
    hashes, _, _, edges = word_spans(chunks, False)
    owner = np.repeat(np.arange(len(chunks)), np.diff(edges))
    return owner[(hashes != _MARK_HASH) & (np.arange(len(hashes)) < edges[1:][owner] - WINDOW)]


def hash_rows(blocks: DataFrame, ranges: int) -> DataFrame:
    """Each block's distinct hashes in order and their weights, by range."""
    kinds = {"block": pa.binary(), "part": pa.int32(), "hashes": pa.binary(), "weights": pa.binary()}
    width = (1 << 64) // ranges + 1
    limits = np.array([i * width for i in range(1, ranges)], _U)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lang, block, chunks, counts = (batch.column(c)[i].as_py() for c in range(4))
                hashes, _, _, owner, _ = grams(_unpack(chunks), _seed(lang))
                hashes, weights = _weighted(hashes, unsqueeze(counts, np.int64)[owner])
                cuts = np.searchsorted(hashes, limits)
                rows = [(block, part, squeeze(np.diff(h, prepend=_U(0))), squeeze(w))
                        for part, (h, w) in enumerate(zip(np.split(hashes, cuts), np.split(weights, cuts))) if len(h)]
                yield _record(rows, kinds)

    return (blocks.select("lang", "block", "chunks", "counts")
            .mapInArrow(run, "block binary, part int, hashes binary, weights binary"))


def frequent_bits(hashed: DataFrame, least: int) -> DataFrame:
    """One row of bits per row of hashes: whether all blocks together hold the hash ``least`` times."""
    kinds = {"block": pa.binary(), "part": pa.int32(), "n": pa.int32(), "bits": pa.binary()}

    def closed(held: list[tuple[bytes, int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, sums = _weighted(np.concatenate([h for _, _, h, _ in held]), np.concatenate([w for *_, w in held]))
        often = hashes[sums >= least]
        return _record([(block, part, len(h), np.packbits(np.isin(h, often, assume_unique=True)).tobytes())
                        for block, part, h, _ in held], kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, int, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for block, part, hashes, weights in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if held and held[0][1] != part:
                    yield closed(held)
                    held = []
                held.append((block, part, np.cumsum(unsqueeze(hashes, _U), dtype=_U), unsqueeze(weights, np.int64)))
        if held:
            yield closed(held)

    parts = int(hashed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (hashed.repartition(parts, "part").sortWithinPartitions("part")
            .mapInArrow(run, "block binary, part int, n int, bits binary"))


def _alike(text: bytes, starts: np.ndarray, ends: np.ndarray, some: np.ndarray, others: np.ndarray) -> bool:
    """Whether the pieces ``some`` of a text equal the pieces ``others``, eight bytes at a time."""
    a, b, left = starts[some], starts[others], (ends - starts)[some]
    if (left != (ends - starts)[others]).any():
        return False
    padded = np.frombuffer(text + b"\0" * 8, np.uint8)
    eights = np.lib.stride_tricks.as_strided(padded[:8].view(_U), (len(text) + 1,), (1,))
    while len(left):
        spare = (np.maximum(8 - left, 0) * 8).astype(_U)
        if (((eights[a] ^ eights[b]) << spare) != 0).any():
            return False
        more = left > 8
        a, b, left = a[more] + 8, b[more] + 8, left[more] - 8
    return True


def _strings(text: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Pieces of a text as an array of strings."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    places = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)),
                                       pa.py_buffer(np.frombuffer(text, np.uint8)[places]))


def counted(blocks: DataFrame, bits: DataFrame) -> DataFrame:
    """lang, words, phrase, n: exact sums per block of the n-grams whose hash passed.

    Occurrences with one hash are compared byte by byte; a block in which they differ is counted by a table of texts.
    """
    kinds = {"lang": pa.string(), "words": pa.int32(), "phrase": pa.string(), "n": pa.int64()}

    def closed(lang: str, chunks: bytes, counts: bytes, answers: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        own = _unpack(chunks)
        joined, weights = b"".join(own), unsqueeze(counts, np.int64)
        hashes, starts, ends, owner, words = grams(own, _seed(lang))
        order = np.argsort(hashes)
        first = np.flatnonzero(np.concatenate(([True], np.diff(hashes[order]) != 0)))
        passed = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for n, b in answers]).astype(bool)
        if len(passed) != len(first):
            raise RuntimeError("a block's answers are not complete")
        sizes = np.diff(first, append=len(order))
        order, sizes = order[np.repeat(passed, sizes)], sizes[passed]
        if not len(order):
            return
        first = np.cumsum(sizes) - sizes
        chosen = order[first]
        if _alike(joined, starts, ends, order, np.repeat(chosen, sizes)):
            sums = np.add.reduceat(weights[owner[order]], first)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang), len(chosen)), pa.array(words[chosen].astype(np.int32)),
                 _strings(joined, starts[chosen], ends[chosen]), pa.array(sums)], list(kinds))
            return
        table: dict[bytes, int] = defaultdict(int)
        for a, b, w in zip(starts[order].tolist(), ends[order].tolist(), weights[owner[order]].tolist()):
            table[joined[a:b]] += w
        yield _record([(lang, p.count(b" ") + 1, p.decode(), n) for p, n in table.items()], kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, answers = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                block, part, lang, chunks, counts, n, bits = (batch.column(c)[i].as_py() for c in range(7))
                if part < 0:
                    if now:
                        yield from closed(*now[1:], answers)
                    now, answers = (block, lang, chunks, counts), []
                elif now is None or block != now[0]:
                    raise RuntimeError("answers without a block")
                else:
                    answers.append((n, bits))
        if now:
            yield from closed(*now[1:], answers)

    def none(kind: str):
        return F.lit(None).cast(kind)

    own = blocks.where("n_hashes > 0").select(
        "block", F.lit(-1).alias("part"), "lang", "chunks", "counts", none("int").alias("n"), none("binary").alias("bits"))
    answers = bits.select("block", "part", none("string").alias("lang"), none("binary").alias("chunks"),
                          none("binary").alias("counts"), "n", "bits")
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (own.unionByName(answers).repartition(parts, "block").sortWithinPartitions("block", "part")
            .mapInArrow(run, "lang string, words int, phrase string, n bigint"))


def frequent(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, f) of all n-grams with at least ``least`` occurrences, and (lang, n): all words."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = materialize(dictionary(chunk_rows(rows, max(1, size // BUCKET_BYTES, partitions))), "chunks")
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    hashes = blocks.agg(F.coalesce(F.sum("n_hashes"), F.lit(0)).alias("n")).first()["n"]
    bits = frequent_bits(hash_rows(blocks, max(1, hashes // RANGE_HASHES)), least)
    found = (counted(blocks, bits).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
             .where(F.col("f") >= least))
    return materialize(found, "ngrams"), totals


def phrases(docs: DataFrame, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score of every phrase of two or more words that no longer one replaces.

    Per language (null: ``und``): a, l and r count the phrase, the first part and the rest of its lowest-scoring
    cut (ties: the shortest first part), n all words; score is floor(1000000 * a * a / (l * r)), computed in
    38-digit decimals. A phrase is left out if a longer candidate that holds its words has ``share`` percent of
    its occurrences. Null and empty texts have no words, repeated rows count each, and columns besides ``lang``
    and ``text`` are not read. A table without words gives no rows.
    """
    return rated(*frequent(docs, least), share)


def rated(found: DataFrame, totals: DataFrame, share: int = SHARE) -> DataFrame:
    """The phrases of ``found`` (lang, words, phrase, f), rated as in ``phrases``; ``totals`` has lang and n."""
    words = F.split("phrase", " ")

    def part(first, length):
        return F.array_join(F.slice(words, first, length), " ")

    longer = found.where(f"words = {LONGEST}").select(
        "lang", F.col("f").alias("above"), F.explode(F.array(
            *[part(i, n) for n in range(2, LONGEST) for i in range(1, LONGEST - n + 2)])).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("above").alias("above"))
    cuts = found.where("words > 1").select(
        "lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("words")).alias("rest"))
    single = found.select("lang", "phrase", "f")
    scored = (cuts.join(single.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
              .join(single.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]))
    scored = scored.select("lang", "phrase", "words", "a", "l", "r", "k", F.expr(
        "CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0))) "
        "div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))").alias("score"))
    best = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(
        F.col("above").isNull() | (100 * F.col("above") < share * F.col("a")))
    return kept.join(small_side(totals), "lang").select(
        "lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score")


def ranked(found: DataFrame, first: int) -> DataFrame:
    """The first rows of each language by score, occurrences and the phrase's bytes, numbered from 1."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
            .withColumn("rank", F.col("rank").cast("bigint")))
