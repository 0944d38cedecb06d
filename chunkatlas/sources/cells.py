"""Cells of a stored array as a Spark data source: ``spark.read.format("array_cells")``.

The references are positional records (``write_records``), so the chunks that hold a range of indices are
known by number. Conditions on the index columns become a box of indices before any task is planned; tasks
get a range of the box's chunks, look their records up by position and read only these chunks' bytes.
Nothing is listed but the files of one folder, and the driver holds bounds, never chunks.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual,
                                    In, InputPartition, IsNotNull, LessThan, LessThanOrEqual)

from ..sinks.records import ABSENT, INLINE, RECORD
from .arrays import ArrayInfo, _cells, _values, decode, inline_bytes
from .storage import locate, read_range

#: Chunks of one task, unless that makes more than TASKS tasks.
TASK_CHUNKS, TASKS = 64, 20_000
#: Chunks whose records are looked up at a time.
_LOOKUP = 1024


class RangedTable:
    """Rows of a folder of Parquet files whose files and row groups follow an integer column."""

    def __init__(self, folder: str, column: str):
        self.store, path = locate(folder)
        found = self.store.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        self.files = sorted(f.path for f in found if f.path.endswith(".parquet"))
        self.column, self._spans = column, {}

    def _spans_of(self, i: int) -> list[tuple[int, int]]:
        """Least and greatest value of each row group of a file."""
        if i not in self._spans:
            with self.store.open_input_file(self.files[i]) as source:
                meta = pq.ParquetFile(source).metadata
                at = meta.schema.names.index(self.column)
                stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            self._spans[i] = [(s.min, s.max) for s in stats]
        return self._spans[i]

    def _last(self, i: int) -> float:
        spans = self._spans_of(i)
        return spans[-1][1] if spans else -math.inf

    def pick(self, wanted: np.ndarray) -> Iterator[pa.Table]:
        """Rows whose value is one of the wanted ones, which are sorted; the file is found by bisection."""
        done = 0
        while done < len(wanted):
            i = bisect.bisect_left(range(len(self.files)), int(wanted[done]), key=self._last)
            if i == len(self.files):
                return
            groups = []
            for group, (lo, hi) in enumerate(self._spans_of(i)):
                at = int(np.searchsorted(wanted, lo))
                if at < len(wanted) and wanted[at] <= hi:
                    groups.append(group)
            if groups:
                with self.store.open_input_file(self.files[i]) as source:
                    file = pq.ParquetFile(source)
                    for group in groups:
                        table = file.read_row_group(group)
                        yield table.filter(pc.is_in(table[self.column], pa.array(wanted)))
            done = int(np.searchsorted(wanted, self._last(i), "right"))


def _of_var(root: str, var: str) -> str | None:
    """The folder of a variable's rows, whose name Spark has escaped."""
    store, path = locate(root)
    for found in store.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
        if unquote(found.base_name) == f"var={var}":
            return f"{root}/{found.base_name}"
    return None


@dataclass
class ChunkRange(InputPartition):
    """Places of the box's chunks, in row-major order."""

    first: int
    end: int


class CellReader(DataSourceReader):
    def __init__(self, root: str, var: str, fill: bool, per_task: int | None, names: list[str],
                 info: ArrayInfo, size: int):
        self.root, self.var, self.fill, self.per_task = root, var, fill, per_task
        self.names, self.info, self.size = names, info, size
        self.lo, self.hi = [0] * len(info.shape), list(info.shape)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Conditions that bound an index are applied here; all others stay with Spark."""
        for one in filters:
            if not self._bound(one):
                yield one

    def _bound(self, one: Filter) -> bool:
        attribute = getattr(one, "attribute", ())
        if len(attribute) != 1 or attribute[0] not in self.names:
            return False
        d = self.names.index(attribute[0])
        if isinstance(one, IsNotNull):
            return True
        if isinstance(one, In):
            values = [v for v in one.value if v is not None]
            self._narrow(d, min(values, default=0), max(values, default=-1) + 1)
            return False  # only the bounds are used
        value = getattr(one, "value", None)
        if value is None:
            return False
        if isinstance(one, EqualTo):
            self._narrow(d, value, value + 1)
        elif isinstance(one, (GreaterThan, GreaterThanOrEqual)):
            self._narrow(d, value + isinstance(one, GreaterThan), self.hi[d])
        elif isinstance(one, (LessThan, LessThanOrEqual)):
            self._narrow(d, self.lo[d], value + isinstance(one, LessThanOrEqual))
        else:
            return False
        return True

    def _narrow(self, d: int, lo: int, hi: int) -> None:
        self.lo[d], self.hi[d] = max(self.lo[d], lo), min(self.hi[d], hi)

    def _box(self) -> tuple[list[int], list[int]]:
        """First chunk and number of chunks along each dimension."""
        first = [a // c for a, c in zip(self.lo, self.info.chunk_shape)]
        ends = [-(-b // c) for b, c in zip(self.hi, self.info.chunk_shape)]
        return first, [max(0, e - f) if a < b else 0 for f, e, a, b in zip(first, ends, self.lo, self.hi)]

    def partitions(self) -> list[ChunkRange]:
        total = math.prod(self._box()[1])
        step = self.per_task or max(TASK_CHUNKS, -(-total // TASKS))
        return [ChunkRange(at, min(at + step, total)) for at in range(0, total, step)] or [ChunkRange(0, 0)]

    def read(self, partition: ChunkRange) -> Iterator[pa.RecordBatch]:
        tables = {name: RangedTable(folder, column) if folder else None for name, folder, column in (
            ("records", _of_var(f"{self.root}/records", self.var), "row"),
            ("inline", _of_var(f"{self.root}/inline", self.var), "n"),
            ("urls", f"{self.root}/urls", "url_id"), ("folders", f"{self.root}/folders", "folder_id"))}
        for at in range(partition.first, partition.end, _LOOKUP):
            yield from self._read(np.arange(at, min(at + _LOOKUP, partition.end)), tables)

    def _read(self, places: np.ndarray, tables: dict) -> Iterator[pa.RecordBatch]:
        first, counts = self._box()
        if counts:
            idx = np.stack(np.unravel_index(places, counts), axis=1) + np.array(first, "int64")
            numbers = np.ravel_multi_index(tuple(idx.T), self.info.grid)
        else:
            idx, numbers = np.zeros((len(places), 0), "int64"), places
        records = self._records(numbers, tables["records"])
        urls = self._urls(np.unique(records["url"][records["url"] >= 0]), tables)
        texts = self._column(tables["inline"], numbers[records["url"] == INLINE], "n", "inline_text")
        for chunk_idx, number, record in zip(idx, numbers.tolist(), records):
            url = int(record["url"])
            if url == ABSENT:
                if not self.fill:
                    continue
                value = 0 if self.info.fill is None else self.info.fill
                chunk = np.full(self.info.chunk_shape, value, np.dtype(self.info.dtype))
            elif url == INLINE:
                chunk = decode(inline_bytes(texts[number]), self.info)
            else:
                offset, length = int(record["offset"]), int(record["length"])
                chunk = decode(read_range(urls[url], *((offset, length) if offset >= 0 else ())), self.info)
            for index, flat in _cells(chunk, chunk_idx, self.info, self.lo, self.hi):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.ascontiguousarray(index[:, d])) for d in range(index.shape[1])),
                     _values(flat, self.info)], [*self.names, "value"])

    def _records(self, numbers: np.ndarray, table: RangedTable | None) -> np.ndarray:
        """The record of each number; one in a row that is not stored is absent."""
        out = np.full(len(numbers), np.array((ABSENT, -1, -1), RECORD))
        rows = numbers // self.size
        for found in table.pick(np.unique(rows)) if table else ():
            for row, data in zip(found["row"].to_pylist(), found["records"]):
                here = rows == row
                out[here] = np.frombuffer(data.as_buffer(), RECORD)[numbers[here] - row * self.size]
        return out

    @staticmethod
    def _column(table: RangedTable | None, wanted: np.ndarray, key: str, value: str) -> dict:
        found = {}
        for part in table.pick(wanted) if table and len(wanted) else ():
            found.update(zip(part[key].to_pylist(), part[value].to_pylist()))
        return found

    def _urls(self, wanted: np.ndarray, tables: dict) -> dict[int, str]:
        rows = [r for part in tables["urls"].pick(wanted) for r in part.to_pylist()]
        ids = np.unique(np.array([r["folder_id"] for r in rows], "int64"))
        folders = self._column(tables["folders"], ids, "folder_id", "folder")
        return {r["url_id"]: folders[r["folder_id"]] + r["name"] for r in rows}


class ArrayCells(DataSource):
    """Options: ``path`` (a folder of ``write_records``), ``var``, ``fill`` (``true``: absent chunks as cells of
    the fill value), ``chunks`` (of one task). Columns: one index per dimension, by its name, and ``value``."""

    @classmethod
    def name(cls) -> str:
        return "array_cells"

    def _described(self) -> tuple[list[str], ArrayInfo, int]:
        store, path = locate(f"{self.options['path'].rstrip('/')}/variables")
        files = [f.path for f in store.get_file_info(pafs.FileSelector(path)) if f.path.endswith(".parquet")]
        for file in files:
            with store.open_input_file(file) as source:
                table = pq.ParquetFile(source).read()
            for row in table.filter(pc.equal(table["var"], self.options["var"])).to_pylist():
                info = ArrayInfo.parse(*(row[c] for c in (
                    "var", "shape", "chunk_shape", "dtype", "codec_json", "fill_json")))
                names = list(row["dims"])
                if len({n.lower() for n in [*names, "value"]}) <= len(names):
                    names = [f"i{d}" for d in range(len(names))]
                return names, info, row["row_records"]
        raise KeyError(self.options["var"])

    def schema(self) -> str:
        names, info, _ = self._described()
        quoted = ["`" + n.replace("`", "``") + "` BIGINT" for n in names]
        return ", ".join([*quoted, f"value {info.value_type}"])

    def reader(self, schema) -> CellReader:
        chunks = self.options.get("chunks")
        return CellReader(self.options["path"].rstrip("/"), self.options["var"],
                          self.options.get("fill", "false").lower() == "true", int(chunks) if chunks else None,
                          *self._described())


def cells(spark: SparkSession, path: str, var: str, fill: bool = False, chunks: int | None = None) -> DataFrame:
    """Cells of a variable of stored records, to be narrowed by ``where`` on its dimensions.

    A dimension's name that repeats, or is ``value``, gives columns ``i0``, ``i1`` and so on.
    """
    spark.dataSource.register(ArrayCells)
    found = spark.read.format("array_cells").option("path", path).option("var", var).option("fill", str(fill).lower())
    return (found.option("chunks", str(chunks)) if chunks else found).load()
