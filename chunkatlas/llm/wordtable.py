"""A distinct-word table and back: what holds for a word is computed once per word, not per occurrence.

Documents are read in blocks of bounded size. A block sends each of its distinct words once, packed by
hash bucket; a bucket's task sees every distinct word of the corpus that hashes there, computes a value
for each, and answers every block in the order of its words. The block's documents, as positions in its
word list, meet the answers again. So a word moves once per block however often it occurs, a word that is
in every text is no hot key, and neither texts nor single occurrences are exchanged.

A block is named by a digest of its content, so a task that runs again after a loss makes the same names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text after which a block is closed, and positions after which a row of it is.
BLOCK_BYTES = 12 << 20
ROW_WORDS = 1 << 18

WORDS = "block binary, bucket int, n int, words binary, counts binary"
ANSWERS = "block binary, bucket int, answer binary"
_PLACES = "block binary, bucket int, answer binary, keys array<bigint>, sizes array<int>"


def squeeze(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, byte planes apart."""
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(-1, raw.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unsqueeze(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


class _Block:
    """Documents as lists of positions in their list of distinct words, the most frequent first."""

    def __init__(self) -> None:
        self.keys: list[int | None] = []
        self.sizes: list[int] = []
        self.marks: list[bool] = []
        self.bytes, self.parts = 0, []
        self.words: dict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.digest = hashlib.blake2b(digest_size=16)

    def add(self, key: int | None, text: bytes, mark: bool) -> None:
        found = text.split()
        self.parts.append(np.fromiter(map(self.words.__getitem__, found), np.int32, len(found)))
        self.keys.append(key)
        self.sizes.append(len(found))
        self.marks.append(mark)
        self.bytes += len(text) + 8
        self.digest.update(b"%d %d;" % (-1 if key is None else key, len(text)))
        self.digest.update(text)

    def close(self, buckets: int) -> tuple[bytes, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Name, words by rank, bucket by rank, ranks of all occurrences, and marked count by rank."""
        flat = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        order = np.argsort(-np.bincount(flat, minlength=len(self.words)), kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        names = list(self.words)
        words = [names[i] for i in order.tolist()]
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int32, len(words))
        ranks = rank[flat]
        counted = np.bincount(ranks[np.repeat(self.marks, self.sizes).astype(bool)], minlength=len(words))
        return self.digest.digest(), words, bucket, ranks, counted


def _blocks(batches: Iterator[pa.RecordBatch], lower: bool) -> Iterator[_Block]:
    block = _Block()
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            for key, text, mark in zip(*(part.column(i).to_pylist() for i in range(3))):
                data = (text or "").encode()
                block.add(key, data.lower() if lower else data, mark)
                if block.bytes >= BLOCK_BYTES:
                    yield block
                    block = _Block()
    if block.keys:
        yield block


def _source(docs: DataFrame, key: str, text: str, mark) -> DataFrame:
    return docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"),
                       F.coalesce(mark, F.lit(False)).alias("mark"))


def word_rows(docs: DataFrame, key: str, text: str, buckets: int, lower: bool = False, mark=None) -> DataFrame:
    """Each block's distinct words by bucket, newline-joined and compressed, with their counts in marked documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, lower):
            name, words, bucket, _, counted = block.close(buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            rows = []
            for part in np.split(order, cuts) if len(order) else []:
                joined = b"\n".join([words[i] for i in part.tolist()])
                rows.append((name, int(bucket[part[0]]), len(part), zstandard.ZstdCompressor(level=3).compress(joined),
                             squeeze(counted[part].astype(np.uint32))))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                    ["block", "bucket", "n", "words", "counts"])

    return _source(docs, key, text, F.lit(True) if mark is None else mark).mapInArrow(run, WORDS)


def unpack(words: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(words).split(b"\n")


def answered(rows: DataFrame, answer: Callable[[list[bytes]], object], pack: Callable[[object, list[int]], bytes]) -> DataFrame:
    """One answer per row of words. ``answer`` is called once per distinct word of a bucket, for many words at a time.

    It returns a sequence of values; ``pack`` turns all values so far and a row's places in them into bytes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, values = None, {}, []
        for batch in batches:
            out = []
            for block, bucket, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if bucket != now:
                    now, known, values = bucket, {}, []
                own = unpack(words)
                new = [w for w in own if w not in known]
                if new:
                    known.update(zip(new, range(len(values), len(values) + len(new))))
                    values.extend(answer(new))
                out.append((block, bucket, pack(values, [known[w] for w in own])))
            yield _answers(out)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.select("block", "bucket", "words").repartition(parts, "bucket")
            .sortWithinPartitions("bucket").mapInArrow(run, ANSWERS))


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int32(), pa.binary()))],
                                      ["block", "bucket", "answer"])


def rejoin(docs: DataFrame, key: str, text: str, buckets: int, answers: DataFrame,
           read: Callable[[list[bytes]], object], write: Callable[[object, list, np.ndarray, np.ndarray], pa.RecordBatch],
           schema: str, lower: bool = False) -> DataFrame:
    """Rows that ``write`` makes of documents and the answers for their words, joined back by position.

    ``read`` turns a block's answers, bucket by bucket, into values in that order, kept per block.
    ``write`` gets these, keys, word numbers per document and each occurrence's place in the values.
    """
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, lower):
            name, _, bucket, ranks, _ = block.close(buckets)
            rows = [(name, buckets, squeeze(bucket), None, None)]
            ends = np.cumsum(block.sizes)
            lo = 0
            while lo < len(ends):
                start = int(ends[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, start + ROW_WORDS, "right")))
                rows.append((name, buckets + 1, squeeze(ranks[start:int(ends[hi - 1])].astype(np.uint32)),
                             block.keys[lo:hi], block.sizes[lo:hi]))
                lo = hi
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int32(), pa.binary(),
                                                             pa.list_(pa.int64()), pa.list_(pa.int32())))],
                ["block", "bucket", "answer", "keys", "sizes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, got, values, place = None, {}, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                block, bucket, answer, keys, sizes = (batch.column(c)[i].as_py() for c in range(5))
                if block != now:
                    now, got, values = block, {}, None
                if bucket < buckets:
                    got[bucket] = answer
                elif bucket == buckets:
                    of_rank = unsqueeze(answer, np.int32)
                    needed = np.unique(of_rank).tolist()
                    if missing := [b for b in needed if b not in got]:
                        raise RuntimeError(f"no answer for {len(missing)} buckets of a block")
                    values = read([got[b] for b in needed])
                    place = np.empty(len(of_rank), np.int64)
                    place[np.argsort(of_rank, kind="stable")] = np.arange(len(of_rank))
                else:
                    yield write(values, keys, np.array(sizes, np.int64), place[unsqueeze(answer, np.uint32)])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none = answers.withColumns({"keys": F.lit(None).cast("array<bigint>"), "sizes": F.lit(None).cast("array<int>")})
    return (_source(docs, key, text, F.lit(True)).mapInArrow(places, _PLACES).unionByName(none)
            .repartition(parts, "block").sortWithinPartitions("block", "bucket").mapInArrow(run, schema))


def buckets_for(docs: DataFrame) -> int:
    """Buckets grow with the shuffle partitions, as the words of a bucket are what a task holds."""
    return 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
