"""Read JSON files of any size and layout in byte ranges.

Whether a byte of a JSON file stands inside a string depends on all quotes before it, and how deep it is nested
on all braces outside strings. So each range is read twice. First it is scanned for both cases, beginning inside or
outside a string: its quotes and how much deeper it ends in each case. A running sum over these rows, one per
range, gives every range the state it begins with. With it, the ranges cut the file into the members of its
top-level object, and one of these members, an object, into its entries. An entry belongs to the range in which
it begins; its task reads on to its end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from json.decoder import scanstring

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import local_frame, materialize, small_side
from .storage import locate, read_range

SPLIT_BYTES = 32 << 20
_LOOK_BACK = 1 << 12
_QUOTE, _ESCAPE = 34, 92
_OPEN, _CLOSE = (123, 91), (125, 93)
_STRUCTURE = np.zeros(256, bool)
_STRUCTURE[list(b'{}[],:')] = True
_STEP = np.zeros(256, np.int64)
_STEP[list(_OPEN)], _STEP[list(_CLOSE)] = 1, -1


@dataclass
class State:
    """What is known before a byte: the backslashes right before it, and whether it is in a string, and how deep."""

    escapes: int = 0
    inside: int = 0
    depth: int = 0


def quotes(data: np.ndarray, escapes: int) -> np.ndarray:
    """Places of the quotes that begin or end a string."""
    at = np.flatnonzero(data == _QUOTE)
    if not len(at):
        return at
    plain = np.maximum.accumulate(np.where(data != _ESCAPE, np.arange(len(data)), -1))
    before = np.where(at > 0, plain[at - 1], -1)
    run = at - 1 - before + np.where(before < 0, escapes, 0)
    return at[run % 2 == 0]


def trailing_escapes(data: bytes, escapes: int) -> int:
    """Backslashes at the end, with those before if there is nothing else."""
    run = len(data) - len(data.rstrip(b"\\"))
    return run + escapes if run == len(data) else run


def structure(data: bytes, state: State) -> tuple[np.ndarray, np.ndarray, np.ndarray, State]:
    """Places, characters and depths behind them of all braces, commas and colons outside strings; the state after."""
    buf = np.frombuffer(data, np.uint8)
    found = quotes(buf, state.escapes)
    at = np.flatnonzero(_STRUCTURE[buf])
    at = at[(np.searchsorted(found, at) + state.inside) % 2 == 0]
    kinds = buf[at]
    depth = state.depth + np.cumsum(_STEP[kinds])
    after = State(trailing_escapes(data, state.escapes), (state.inside + len(found)) % 2,
                  int(depth[-1]) if len(at) else state.depth)
    return at, kinds, depth, after


def _escapes_before(url: str, start: int) -> int:
    run, lo = 0, start
    while lo > 0:
        size = min(_LOOK_BACK, lo)
        data = read_range(url, lo - size, size)
        own = size - len(data.rstrip(b"\\"))
        run, lo = run + own, lo - size
        if own < size:
            break
    return run


def ranges(spark: SparkSession, paths: Sequence[str], split: int = SPLIT_BYTES) -> DataFrame:
    """path, no, start, length of byte ranges that cover the files."""
    sizes = []
    for path in paths:
        store, at = locate(path)
        info = store.get_file_info(at)
        if not info.is_file:
            raise FileNotFoundError(path)
        sizes.append((path, info.size))
    files = local_frame(spark, sizes, "path STRING, size BIGINT").where("size > 0")
    cut = files.select("path", "size", F.explode(F.expr(f"sequence(0L, (size - 1) div {split})")).alias("no"))
    return cut.select("path", "no", F.expr(f"no * {split}").alias("start"),
                      F.expr(f"least({split}, size - no * {split})").alias("length"))


def _tasks(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def states(spark: SparkSession, paths: Sequence[str], split: int = SPLIT_BYTES) -> DataFrame:
    """The ranges with the state that each begins with. A file whose strings or braces do not end is an error."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, no, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                data, before = read_range(path, start, length), _escapes_before(path, start)
                out = structure(data, State(before, 0))[3]
                within = structure(data, State(before, 1))[3]
                yield pa.RecordBatch.from_pylist([{
                    "path": path, "no": no, "start": start, "length": length, "escapes": before,
                    "odd": out.inside, "out_step": out.depth, "in_step": within.depth}], schema=kinds)

    kinds = pa.schema([("path", pa.string()), *((n, pa.int64()) for n in (
        "no", "start", "length", "escapes", "odd", "out_step", "in_step"))])
    scanned = materialize(ranges(spark, paths, split).repartition(_tasks(spark)).mapInArrow(
        scan, "path STRING, no BIGINT, start BIGINT, length BIGINT, escapes BIGINT, odd BIGINT, out_step BIGINT, in_step BIGINT"),
        "ranges")
    # One row per range.
    before = Window.partitionBy("path").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    known = scanned.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    known = known.withColumn("step", F.when(F.col("inside") == 1, F.col("in_step")).otherwise(F.col("out_step")))
    known = known.withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
    bad = known.groupBy("path").agg((F.sum("odd") % 2).alias("odd"), F.sum("step").alias("depth")).where(
        "odd != 0 OR depth != 0").select("path").first()
    if bad:
        raise ValueError(f"{bad['path']}: a string or an object does not end")
    return known.select("path", "no", "start", "length", "escapes", "inside", "depth")


def members(known: DataFrame) -> DataFrame:
    """path, key, value_start, value_end of the members of each file's top-level object."""
    def events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, _, start, length, escapes, inside, depth in zip(*(c.to_pylist() for c in batch.columns)):
                at, kinds, after, _ = structure(read_range(path, start, length), State(escapes, inside, depth))
                between = ((kinds == 44) | (kinds == 58)) & (after == 1)
                outer = ((kinds == _OPEN[0]) & (after == 1)) | ((kinds == _CLOSE[0]) & (after == 0))
                own = between | outer
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(path), int(own.sum())), pa.array(at[own] + start),
                     pa.array(kinds[own].astype(np.int32))], ["path", "pos", "kind"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            keys = [json.loads(read_range(p, lo, hi - lo)) for p, lo, hi in zip(*columns[:3])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.string()), batch.column(3), batch.column(4)],
                ["path", "key", "value_start", "value_end"])

    order = Window.partitionBy("path").orderBy("pos")
    found = known.mapInArrow(events, "path STRING, pos BIGINT, kind INT")
    spans = found.select("path", "kind", (F.lag("pos").over(order) + 1).alias("lo"), F.col("pos").alias("hi"),
                         (F.col("pos") + 1).alias("value_start"), F.lead("pos").over(order).alias("value_end"))
    return spans.where("kind = 58").select("path", "lo", "hi", "value_start", "value_end").mapInArrow(
        named, "path STRING, key STRING, value_start BIGINT, value_end BIGINT")


def entries(known: DataFrame, spans: DataFrame) -> DataFrame:
    """path, pos, key, value of the entries of the objects at ``spans`` (path, value_start, value_end); value is JSON text."""
    def end_of(path: str, pos: int, state: State, stop: int) -> int:
        """Where an entry ends that goes on at ``pos``."""
        while pos < stop:
            size = min(stop - pos, _LOOK_BACK << 4)
            at, kinds, depth, state = structure(read_range(path, pos, size), state)
            ends = np.flatnonzero(((kinds == 44) & (depth == 2)) | (depth == 1))
            if len(ends):
                return pos + int(at[ends[0]])
            pos += size
        return stop

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, length, escapes, inside, depth, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
                data = read_range(path, start, length)
                at, kinds, after, state = structure(data, State(escapes, inside, depth))
                own = (at + start >= lo) & (at + start < hi)
                begins = own & (((kinds == _OPEN[0]) | (kinds == 44)) & (after == 2))
                ends = own & (((kinds == 44) & (after == 2)) | (after == 1))
                # An array at this depth has commas too, but no entries.
                first, stops = at[begins], at[ends]
                places = np.searchsorted(stops, first, "right")
                rows = []
                for begin, place in zip(first.tolist(), places.tolist()):
                    if place < len(stops):
                        text = data[begin + 1:int(stops[place])]
                    else:
                        end = end_of(path, start + length, state, hi)
                        text = data[begin + 1:] + (read_range(path, start + length, end - start - length)
                                                   if end > start + length else b"")
                    text = text.decode().strip(" \t\r\n")
                    if text:
                        key, after_key = scanstring(text, 1)
                        rows.append((path, start + begin, key, text[after_key:].lstrip(" \t\r\n")[1:]))
                    if len(rows) >= 10_000:
                        yield _entries(rows)
                        rows = []
                yield _entries(rows)

    rows = known.join(small_side(spans), "path").where("start < value_end AND start + length > value_start")
    return rows.select("path", "start", "length", "escapes", "inside", "depth", "value_start", "value_end").repartition(
        _tasks(known.sparkSession)).mapInArrow(cut, "path STRING, pos BIGINT, key STRING, value STRING")


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"path": pa.string(), "pos": pa.int64(), "key": pa.string(), "value": pa.string()}
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))


def read_member(spark: SparkSession, paths: Sequence[str], name: str, split: int = SPLIT_BYTES) -> DataFrame:
    """path, key, value of the entries of each file's top-level member ``name``, an object.

    Of a member or key that a file repeats the last one counts. Files without the member, or with a member
    that is no object, give no rows. One entry has to fit in a task's memory, and in a variant's 128 MiB to be parsed.
    """
    known = states(spark, paths, split)
    spans = members(known).where(F.col("key") == name).groupBy("path").agg(
        F.max(F.struct("value_start", "value_end")).alias("at")).select("path", "at.*")
    objects = materialize(spans, "member").mapInArrow(
        _only_objects, "path STRING, value_start BIGINT, value_end BIGINT")
    found = entries(known, objects).groupBy("path", "key").agg(F.max(F.struct("pos", "value")).alias("last"))
    return found.select("path", "key", F.col("last.value").alias("value"))


def _only_objects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans whose first character besides white space is an opening brace."""
    for batch in batches:
        kept = []
        for path, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
            while lo < hi and not (text := read_range(path, lo, min(_LOOK_BACK, hi - lo)).lstrip(b" \t\r\n")):
                lo += _LOOK_BACK
            kept.append(lo < hi and text.startswith(b"{"))
        yield batch.filter(pa.array(kept, pa.bool_()))


def other_members(spark: SparkSession, path: str, name: str, split: int = SPLIT_BYTES) -> dict | None:
    """The top-level object without the member ``name``; None if it has no such member."""
    rows = members(states(spark, [path], split)).orderBy("value_start").collect()
    if all(r["key"] != name for r in rows):
        return None
    return {r["key"]: json.loads(read_range(path, r["value_start"], r["value_end"] - r["value_start"]))
            for r in rows if r["key"] != name}
