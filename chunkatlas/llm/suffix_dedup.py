"""Exact removal of repeated byte strings of a given length, by names, suffix arrays and adjacent prefixes.

A document is cut into runs of neighbouring windows (strings of ``length`` bytes) that share their least
K-byte substring, the run's anchor. Equal windows have the same anchor, so only runs of one anchor can hold
equal windows. A run gets a name, the hash of its bytes; of runs with equal names all but the first are
repeats. Only where one anchor has several names are bytes compared: the first run of each name goes, with
its anchor's others, into a suffix array made by the difference-cover algorithm (sort sampled triples,
recurse on their names, merge the remaining suffixes), where equal windows have adjacent prefixes.

Names and anchors are 64-bit hashes; equality within a suffix array is by bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import with_ordinal_sorted
from ..session import materialize, small_side
from .text import mix, slices, stream

LENGTH = 100
K = 32
#: Bytes of runs after which a suffix array is closed, at the end of an anchor's runs.
CHUNK = 1 << 20
_BYTES = stream(6, 256)
_U = np.uint64
_NULL = -(1 << 63)
_RUNS = "anchor bigint, name bigint, doc bigint, lo int, hi int"


def _substring_hashes(buf: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each place on, combined from powers of two."""
    have, size, out, done = _BYTES[buf], 1, None, 0
    while True:
        if length & size:
            n = len(buf) - done - size + 1
            out = have[:n] if out is None else mix(out[:n] * _U(0xD6E8FEB86659FD93) + have[done:done + n])
            done += size
        if done == length:
            return out
        have = mix(have[:-size] * _U(0xC2B2AE3D27D4EB4F) + have[size:])
        size *= 2


def runs(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text number, first window, last window, anchor, name) of all runs of neighbouring texts."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    if not len(buf) or sizes.max() < length:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    value = _substring_hashes(buf, K)
    # Place of the least substring in each window, the first of equal ones, by doubling.
    reach, least, have = length - K + 1, np.arange(len(value)), 1

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(value[b] < value[a], b, a)

    while have * 2 <= reach:
        least = better(least[:-have], least[have:])
        have *= 2
    if have < reach:
        least = better(least[:len(least) - (reach - have)], least[reach - have:])
    text = np.repeat(np.arange(len(texts)), sizes)[:len(least)]
    window = np.flatnonzero(np.arange(len(least)) + length <= starts[text + 1])
    anchor = least[window]
    new = np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(text[window]) != 0)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(window)])) - 1
    lo, hi = window[first], window[last]
    # A run's name: its first and last window cover it, and each window's hash covers the window.
    whole = _substring_hashes(buf, length)
    inner = lo + (hi - lo) // 2
    name = mix(mix(whole[lo] * _U(3) + whole[inner]) * _U(5) + whole[hi] + (hi - lo).astype(_U))
    own = text[lo]
    return own, lo - starts[own], hi - starts[own], value[anchor[first]].view(np.int64), name.view(np.int64)


def _pair_names(padded: np.ndarray) -> np.ndarray:
    """An order-preserving number below 2**32 for each symbol and the next."""
    if int(padded.max()) < 1 << 16:
        return (padded[:-1] << _U(16)) | padded[1:]
    return np.unique((padded[:-1] << _U(32)) | padded[1:], return_inverse=True)[1].astype(_U)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by the difference cover of residues 1 and 2 modulo 3. Symbols are at least 1."""
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    padded = np.concatenate((symbols.astype(_U), np.zeros(3, _U)))
    # A further sampled place keeps the two residues' names apart if n is 1 modulo 3.
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sampled = np.concatenate((one, two))
    pairs = _pair_names(padded)
    triples = (pairs[sampled] << _U(32)) | padded[sampled + 2]
    kinds, names = np.unique(triples, return_inverse=True)
    order = np.argsort(names, kind="stable") if len(kinds) == len(sampled) else suffix_array(names + 1)
    rank = np.zeros(n + 3, np.int64)
    rank[sampled[order]] = np.arange(1, len(order) + 1)
    order = sampled[order]
    order = order[order < n]
    rest = np.arange(0, n, 3)

    def before(at: np.ndarray) -> np.ndarray:
        return (padded[at] << _U(32)) | rank[at + 1].astype(_U)

    def before_two(at: np.ndarray) -> np.ndarray:
        return (pairs[at] << _U(32)) | rank[at + 2].astype(_U)

    rest = rest[np.argsort(before(rest), kind="stable")]
    ones, twos = order[order % 3 == 1], order[order % 3 == 2]
    place = (np.arange(len(rest)) + np.searchsorted(before(ones), before(rest))
             + np.searchsorted(before_two(twos), before_two(rest)))
    out = np.empty(n, np.int64)
    free = np.ones(n, bool)
    free[place] = False
    out[place] = rest
    out[free] = order
    return out


def repeated_windows(segments: list[bytes], docs: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether each window of the segments, in their order, equals one that starts earlier by (doc, start)."""
    buf = np.frombuffer(b"".join(segments), np.uint8)
    sizes = np.array([len(s) for s in segments])
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    windows = sizes - length + 1
    of = np.repeat(np.arange(len(segments)), windows)
    into = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    number = np.full(len(buf), -1, np.int64)
    number[begin[of] + into] = np.arange(len(of))
    order = suffix_array(buf.astype(np.int64) + 1)
    order = order[number[order] >= 0]
    same = np.zeros(len(order), bool)
    views = np.lib.stride_tricks.sliding_window_view(buf, length)
    for lo in range(1, len(order), 1 << 14):
        hi = min(len(order), lo + (1 << 14))
        same[lo:hi] = (views[order[lo:hi]] == views[order[lo - 1:hi - 1]]).all(axis=1)
    group = np.cumsum(~same)
    place = number[order]
    ranked = np.lexsort((starts[of[place]] + into[place], docs[of[place]], group))
    later = np.concatenate(([False], np.diff(group[ranked]) == 0)) if len(ranked) else np.zeros(0, bool)
    out = np.zeros(len(of), bool)
    out[place[ranked]] = later
    return out


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) per row: the UTF-8 bytes without all repeated strings.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a
    smaller key, or further to the front of the same one. ``key`` is an integer column; null comes
    first. Rows that share key and text are one document, and all get its result; texts that share a
    key are ordered as texts. Null text is empty. Texts shorter than ``length`` keep everything.

    Whole copies of an earlier text are settled by a digest. Then runs are exchanged, not windows, and
    as numbers, without their bytes. Runs of one anchor are one sorted stream, of which a task holds
    one run. Bytes are fetched for the first run of each name where an anchor has several; those of one
    anchor meet in one task, at about 1.7 * length bytes each.
    """
    rows = _unique_rows(docs, key, text)
    digests = rows.select("doc", F.md5(F.encode("content", "UTF-8")).alias("digest"),
                          F.octet_length("content").alias("n"))
    first = digests.groupBy("digest").agg(F.min("doc").alias("first"))
    # Only texts with several documents are looked up again.
    several = digests.groupBy("digest").agg(F.count_distinct("doc").alias("docs")).where("docs > 1").select("digest")
    copies = materialize(digests.join(small_side(several), "digest").join(first, "digest").where("doc != first")
                         .select("doc", "n").distinct(), "copies")
    own = rows.select("doc", "content").join(small_side(copies.select("doc")), "doc", "left_anti")
    settled = materialize(_settled(_run_rows(own, length)), "runs")
    repeated = settled.where("repeated").select("doc", "lo", "hi")
    apart = materialize(_apart(own, settled.where("not repeated"), length), "windows")
    whole = copies.where(F.col("n") >= length).select(
        "doc", F.lit(0).alias("lo"), (F.col("n") - length).cast("int").alias("hi"))
    spans = materialize(_merged(repeated.unionByName(apart).unionByName(whole), length), "spans")
    joined = rows.join(small_side(spans), "doc", "left")
    return joined.select("own", F.encode("content", "UTF-8").alias("content"), "starts", "ends").mapInArrow(
        _cut, "own bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary").withColumnRenamed("own", key)


def _unique_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, own, content): own is the key, doc a number that orders texts and is theirs alone."""
    rows = docs.select(F.col(key).cast("bigint").alias("own"), F.coalesce(F.col(text), F.lit("")).alias("content"))
    shared = rows.groupBy("own").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    clash = rows.join(small_side(shared.select(F.col("own").alias("twice"))), F.col("own").eqNullSafe(F.col("twice")), "left_semi")
    if clash.groupBy("own").agg(F.count_distinct(F.md5("content")).alias("n")).where("n > 1").isEmpty():
        return rows.withColumn("doc", F.coalesce("own", F.lit(_NULL)))
    return with_ordinal_sorted(rows, ["own", "content"], out="doc")


def _run_rows(rows: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                docs = part.column(0).to_numpy()
                texts = part.column(1).to_pylist()
                for lo, hi in slices(texts):
                    own, first, last, anchor, name = runs(texts[lo:hi], length)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(anchor), pa.array(name), pa.array(docs[lo:hi][own] if len(own) else own),
                        pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                        ["anchor", "name", "doc", "lo", "hi"])

    return rows.select("doc", F.encode("content", "UTF-8")).mapInArrow(run, _RUNS)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted runs, those whose name came before (repeated), and the first of each name if its anchor has several.

    Of an anchor whose rows go on in the next batch, at most one run is held.
    """
    last_anchor = last_name = held = None
    several = False
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(5)]
        anchor, name = columns[:2]
        new_anchor = np.concatenate(([anchor[0] != last_anchor], np.diff(anchor) != 0))
        new_name = new_anchor | np.concatenate(([name[0] != last_name], np.diff(name) != 0))
        group = np.cumsum(new_anchor)
        kinds = np.bincount(group[new_name], minlength=group[-1] + 1)
        if held is not None and kinds[0]:
            # The anchor before goes on with another name.
            yield _run_batch([np.array([v]) for v in held], False)
            held, several = None, True
        if several or kinds[0]:
            kinds[0] = 2
        if len(kinds) > 1:
            held, several = None, kinds[-1] > 1
            if not several:
                held = [c[np.flatnonzero(new_anchor)[-1]] for c in columns]
        firsts = new_name & (kinds[group] > 1)
        yield _run_batch([c[~new_name] for c in columns], True)
        yield _run_batch([c[firsts] for c in columns], False)
        last_anchor, last_name = anchor[-1], name[-1]


def _run_batch(columns: list[np.ndarray], repeated: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(np.full(len(columns[0]), repeated))],
                                      ["anchor", "name", "doc", "lo", "hi", "repeated"])


def _settled(found: DataFrame) -> DataFrame:
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (found.repartition(parts, "anchor").sortWithinPartitions("anchor", "name", "doc", "lo")
            .mapInArrow(_stream, f"{_RUNS}, repeated boolean"))


def _apart(rows: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """(doc, lo, hi): repeated windows among the first runs of anchors with several names."""
    wanted = firsts.groupBy("doc").agg(F.collect_list(F.struct("anchor", "lo", "hi")).alias("wanted"))
    pieces = rows.join(small_side(wanted), "doc").select(
        "doc", F.encode("content", "UTF-8").alias("bytes"), F.explode("wanted").alias("w")).select(
        "w.anchor", "doc", "w.lo", F.expr(f"substring(bytes, w.lo + 1, w.hi - w.lo + {length})").alias("piece"))

    def flush(group: list[tuple]) -> pa.RecordBatch:
        docs, starts = (np.array([g[i] for g in group], np.int64) for i in (1, 2))
        pieces_ = [g[3] for g in group]
        gone = repeated_windows(pieces_, docs, starts, length)
        windows = np.array([len(p) - length + 1 for p in pieces_])
        of = np.repeat(np.arange(len(group)), windows)
        at = starts[of] + np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        of, at = of[gone], at[gone]
        new = np.concatenate(([True], (np.diff(of) != 0) | (np.diff(at) != 1)))[:len(of)]
        lo = np.flatnonzero(new)
        hi = np.concatenate((lo[1:], [len(of)]))[:len(lo)] - 1
        return pa.RecordBatch.from_arrays([pa.array(docs[of[lo]]), pa.array(at[lo].astype(np.int32)),
                                           pa.array(at[hi].astype(np.int32))], ["doc", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if size >= CHUNK and row[0] != group[-1][0]:
                    yield flush(group)
                    group, size = [], 0
                group.append(row)
                size += len(row[3])
        if group:
            yield flush(group)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (pieces.repartition(parts, "anchor").sortWithinPartitions("anchor")
            .mapInArrow(run, "doc bigint, lo int, hi int"))


def _merged(windows: DataFrame, length: int) -> DataFrame:
    """(doc, starts, ends): the maximal byte spans that the windows of each document cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, starts, ends = None, [], []
        for batch in batches:
            out = []
            for doc, lo, hi in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if doc != now:
                    if now is not None:
                        out.append((now, starts, ends))
                    now, starts, ends = doc, [], []
                if ends and lo <= ends[-1]:
                    ends[-1] = max(ends[-1], hi + length)
                else:
                    starts.append(lo)
                    ends.append(hi + length)
            yield _span_batch(out)
        yield _span_batch([(now, starts, ends)] if now is not None else [])

    parts = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (windows.repartition(parts, "doc").sortWithinPartitions("doc", "lo")
            .mapInArrow(run, "doc bigint, starts array<int>, ends array<int>"))


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        columns, (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))], ["doc", "starts", "ends"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            rows = []
            for own, data, starts, ends in zip(*(part.column(i).to_pylist() for i in range(4))):
                starts, ends = starts or [], ends or []
                kept = b"".join(data[a:b] for a, b in zip([0, *ends], [*starts, len(data)]))
                rows.append((own, len(data), len(data) - len(kept), len(starts), kept))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                ["own", "n_bytes", "n_removed", "n_spans", "kept"])
