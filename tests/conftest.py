from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql.types import ArrayType, StructType

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from chunkatlas import schemas as S  # noqa: E402
from chunkatlas.schemas import Manifest  # noqa: E402
from chunkatlas.session import build_session, local_frame  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "2", "spark.sql.leafNodeDefaultParallelism": "2",
        "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def granule(gid, rank, begin, end=None, cycle=1, passes=(2,), collection="C", links=None, name=None):
    if links is None:
        links = [("direct", f"s3://b-one/{gid}.nc"), ("https", f"https://h/d/{gid}.nc")]
    return (gid, collection, name or f"{gid}.nc", rank,
            (((begin, end),), (((cycle, [(p,) for p in passes]),),)), links)


def named(value, kind):
    """A nested tuple as the dicts that Arrow expects for structs."""
    if isinstance(kind, StructType) and value is not None:
        return {f.name: named(v, f.dataType) for f, v in zip(kind.fields, value)}
    if isinstance(kind, ArrayType) and value is not None:
        return [named(v, kind.elementType) for v in value]
    return value


def granules(spark, rows):
    kinds = [f.dataType for f in StructType.fromDDL(S.GRANULES)]
    return local_frame(spark, [tuple(named(v, k) for v, k in zip(row, kinds)) for row in rows],
                       S.GRANULES)


def manifest(spark, dims=(), variables=(), attrs=(), chunks=(), values=()):
    def make(rows, schema):
        return local_frame(spark, list(rows), schema)
    return Manifest(make(dims, S.DIMS), make(variables, S.VARIABLES), make(attrs, S.ATTRS),
                    make(chunks, S.CHUNK_REFS), make(values, S.COORD_VALUES))


def variable(gid, var, dims, shape, chunk=None, dtype="<f4", codec="{}", coord=False,
             loadable=False):
    return (gid, var, list(dims), list(shape), list(chunk or shape), dtype, codec, "null", coord,
            loadable)


def rows(df, *columns):
    """Rows as a sorted list of tuples, arrays as tuples."""
    picked = df.select(*columns) if columns else df
    plain = [tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in picked.collect()]
    return sorted(plain, key=repr)
