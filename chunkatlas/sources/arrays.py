"""Read the cells of a variable through its chunk references."""

from __future__ import annotations

import base64
import gzip
import json
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import COORD_VALUES, Dataset, Manifest
from .storage import read_range

_CELLS = 65_536


@dataclass(frozen=True)
class ArrayInfo:
    """What is needed to decode the chunks of one variable."""

    shape: tuple[int, ...]
    chunk_shape: tuple[int, ...]
    dtype: str
    compressor: dict | None
    filters: tuple[dict, ...]
    order: str
    fill: object

    @classmethod
    def of(cls, ds: Dataset, var: str) -> ArrayInfo:
        row = ds.variables.where(F.col("var") == var).select(
            "shape", "chunk_shape", "dtype", "codec_json", "fill_json").first()
        if row is None:
            raise KeyError(var)
        return cls.parse(var, *row)

    @classmethod
    def parse(cls, var: str, shape, chunk_shape, dtype: str, codec_json: str | None,
              fill_json: str | None) -> ArrayInfo:
        codec = json.loads(codec_json or "{}")
        info = cls(tuple(shape), tuple(chunk_shape), dtype,
                   codec.get("compressor"), tuple(codec.get("filters") or ()),
                   codec.get("order") or "C", json.loads(fill_json or "null"))
        known = {"zlib", "gzip", "shuffle"}
        used = {c["id"] for c in (info.compressor, *info.filters) if c}
        if used - known:
            raise ValueError(f"{var}: unsupported codec {sorted(used - known)}")
        if info.order != "C" or np.dtype(info.dtype).kind not in "iufb":
            raise ValueError(f"{var}: unsupported order or type {info.order} {info.dtype}")
        return info

    @property
    def value_type(self) -> str:
        kind = np.dtype(self.dtype)
        if kind.kind == "f":
            return "DOUBLE"
        return "DECIMAL(20,0)" if kind == np.dtype("u8") else "BIGINT"

    @property
    def grid(self) -> tuple[int, ...]:
        return tuple(-(-n // c) for n, c in zip(self.shape, self.chunk_shape))


def unshuffle(data: bytes, size: int) -> bytes:
    """Undo the byte shuffle of elements of ``size`` bytes; trailing bytes are not shuffled."""
    whole = len(data) // size * size
    planes = np.frombuffer(data[:whole], "u1").reshape(size, -1)
    return planes.T.tobytes() + data[whole:]


def decode(data: bytes, info: ArrayInfo) -> np.ndarray:
    for codec in (info.compressor, *reversed(info.filters)):
        if codec is None:
            continue
        if codec["id"] == "shuffle":
            data = unshuffle(data, int(codec.get("elementsize", 4)))
        else:
            data = gzip.decompress(data) if codec["id"] == "gzip" else zlib.decompress(data)
    return np.frombuffer(data, np.dtype(info.dtype)).reshape(info.chunk_shape)


def inline_bytes(text: str) -> bytes:
    return base64.b64decode(text[7:]) if text.startswith("base64:") else text.encode("utf-8")


def _cells(chunk: np.ndarray, chunk_idx: Sequence[int], info: ArrayInfo, lo: Sequence[int] = (),
           hi: Sequence[int] = ()) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in the whole array and values of a chunk's cells inside it, in pieces of bounded size.

    ``lo`` and ``hi`` narrow the places along each dimension, the latter excluded.
    """
    start_of = np.asarray(chunk_idx, "int64") * np.asarray(info.chunk_shape, "int64")
    base = np.maximum(start_of, np.asarray(lo, "int64")) if len(lo) else start_of
    inside = tuple(slice(int(b - s), int(max(b, min(s + c, n)) - s))
                   for s, b, c, n in zip(start_of, base, info.chunk_shape, hi if len(hi) else info.shape))
    part = chunk[inside]
    flat = part.reshape(-1)
    for start in range(0, flat.size, _CELLS):
        at = np.arange(start, min(start + _CELLS, flat.size))
        index = (np.stack(np.unravel_index(at, part.shape), axis=1) + base if part.ndim
                 else np.zeros((1, 0), "int64"))
        yield index.astype("int64"), flat[at]


def _values(flat: np.ndarray, info: ArrayInfo) -> pa.Array:
    """The values as Arrow has them: a NaN is a value, not a NULL."""
    if info.value_type == "DOUBLE":
        return pa.array(flat.astype("f8"))
    if info.value_type == "BIGINT":
        return pa.array(flat.astype("i8"))
    return pa.array([Decimal(int(v)) for v in flat], pa.decimal128(20, 0))


def _as_double(var: str, flat: np.ndarray) -> pa.Array:
    """Values of a coordinate; an integer that a double cannot hold ends the job."""
    values = flat.astype("f8")
    if flat.dtype.kind in "iu" and any(int(v) != int(f) for v, f in zip(flat, values)):
        raise ValueError(f"{var}: a value is not exact as a double; do not load this coordinate")
    return pa.array(values)


def read_array(ds: Dataset, var: str, where: Column | None = None, fill: bool = False,
               partitions: int | None = None) -> DataFrame:
    """Cells ``(idx, value)`` of a variable.

    ``where`` is a condition on the chunk table, such as ``chunk_idx[0] = 3``; it is applied before
    any byte is read. Cells of absent chunks are left out, or carry the fill value with ``fill``.
    """
    info = ArrayInfo.of(ds, var)
    spark = ds.chunk_refs.sparkSession
    inline = (F.col("inline_text") if "inline_text" in ds.chunk_refs.columns
              else F.lit(None).cast("string"))
    chunks = ds.chunk_refs.where(F.col("var") == var)
    if where is not None:
        chunks = chunks.where(where)
    chunks = chunks.select("chunk_idx", "url", "offset", "length", inline.alias("inline_text"))
    if fill:
        every = _grid(spark, info)
        if where is not None:
            every = every.where(where)
        chunks = every.join(chunks, "chunk_idx", "left")
    # Reading is slow per row, so rows are spread evenly instead of as the table is split.
    chunks = chunks.repartition(partitions or spark.sparkContext.defaultParallelism)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for idx, url, offset, length, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text is not None:
                    chunk = decode(inline_bytes(text), info)
                elif url is not None:
                    chunk = decode(read_range(url, offset, length), info)
                else:
                    value = 0 if info.fill is None else info.fill
                    chunk = np.full(info.chunk_shape, value, np.dtype(info.dtype))
                for places, flat in _cells(chunk, idx, info):
                    ends = np.arange(len(flat) + 1) * places.shape[1]
                    yield pa.RecordBatch.from_arrays([
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places.ravel())),
                        _values(flat, info)], ["idx", "value"])

    return chunks.mapInArrow(read, f"idx ARRAY<BIGINT>, value {info.value_type}")


def _grid(spark, info: ArrayInfo) -> DataFrame:
    """Every chunk index of the array, made in parallel from a range."""
    total = int(np.prod(info.grid, dtype="int64"))
    parts, step = [], total
    for n in info.grid:
        step //= max(n, 1)
        parts.append(F.expr(f"(id div {max(step, 1)}) % {max(n, 1)}"))
    index = F.array(*parts) if parts else F.array().cast("array<bigint>")
    return spark.range(total).select(index.alias("chunk_idx"))


def load_coords(manifest: Manifest, names: Sequence[str]) -> Manifest:
    """Hold the values of the named coordinates in the manifest instead of references to them."""
    chosen = F.col("var").isin(list(names))
    spark = manifest.chunk_refs.sparkSession
    info = manifest.variables.where(chosen).select(
        "granule_id", "var", "shape", "chunk_shape", "dtype", "codec_json", "fill_json")
    chunks = (manifest.chunk_refs.where(chosen)
              .select("granule_id", "var", "chunk_idx", "url", "offset", "length", "inline_text")
              .join(info, ["granule_id", "var"])
              .repartition(spark.sparkContext.defaultParallelism))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for granule, var, idx, url, offset, length, text, *meta in zip(
                    *(c.to_pylist() for c in batch.columns)):
                array = ArrayInfo.parse(var, *meta)
                data = inline_bytes(text) if text is not None else read_range(url, offset, length)
                for places, flat in _cells(decode(data, array), idx, array):
                    pos = (np.ravel_multi_index(places.T, array.shape) if array.shape
                           else np.zeros(len(flat), "int64"))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([granule] * len(flat), pa.string()),
                        pa.array([var] * len(flat), pa.string()), pa.array(pos, pa.int64()),
                        _as_double(var, flat)], ["granule_id", "var", "pos", "value"])

    return manifest.with_(
        variables=manifest.variables.withColumn(
            "loadable", F.coalesce("loadable", F.lit(False)) | chosen),
        chunk_refs=manifest.chunk_refs.where(~chosen),
        coord_values=manifest.coord_values.unionByName(chunks.mapInArrow(read, COORD_VALUES)))
