import gzip
import itertools
import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import granule, granules, rows
from pyspark.sql import functions as F

from chunkatlas.operators.combine import combine
from chunkatlas.schemas import Dataset
from chunkatlas.sinks.refs import write_refs_json
from chunkatlas.sources.arrays import load_coords, read_array
from chunkatlas.sources.refs import open_refs
from chunkatlas.sources.virtualize import backoff, virtualize

ZLIB, GZIP = {"id": "zlib", "level": 1}, {"id": "gzip", "level": 1}


def write_array(root, name, data, chunks, compressor=None, shuffle=False, fill=0, dims=None,
                skip=()):
    folder = f"{root}/{name}"
    os.makedirs(folder)
    filters = [{"id": "shuffle", "elementsize": data.dtype.itemsize}] if shuffle else None
    with open(f"{folder}/.zarray", "w") as out:
        json.dump({"shape": data.shape, "chunks": chunks, "dtype": data.dtype.str,
                   "compressor": compressor, "filters": filters, "fill_value": fill, "order": "C",
                   "zarr_format": 2}, out)
    if dims is not None:
        with open(f"{folder}/.zattrs", "w") as out:
            json.dump({"_ARRAY_DIMENSIONS": dims, "units": "K"}, out)
    for idx in np.ndindex(*[-(-n // c) for n, c in zip(data.shape, chunks)]):
        if idx in skip:
            continue
        part = data[tuple(slice(i * c, (i + 1) * c) for i, c in zip(idx, chunks))]
        full = np.full(chunks, fill, data.dtype)
        full[tuple(slice(0, n) for n in part.shape)] = part
        raw = full.tobytes()
        if shuffle:
            raw = np.frombuffer(raw, "u1").reshape(-1, data.dtype.itemsize).T.tobytes()
        if compressor:
            raw = (zlib if compressor["id"] == "zlib" else gzip).compress(raw)
        with open(f"{folder}/{'.'.join(map(str, idx)) or '0'}", "wb") as out:
            out.write(raw)


def new_store(folder, name):
    root = f"{folder}/{name}"
    os.makedirs(root)
    with open(f"{root}/.zgroup", "w") as out:
        out.write('{"zarr_format":2}')
    with open(f"{root}/.zattrs", "w") as out:
        json.dump({"title": "A"}, out)
    return root


def cells(df, shape):
    out = np.full(shape, np.nan)
    for row in df.collect():
        out[tuple(row["idx"])] = row["value"]
    return out


def as_dataset(m):
    return Dataset(m.dims, m.variables.drop("granule_id"), m.attrs, m.chunk_refs, m.coord_values)


@pytest.mark.parametrize("dtype,compressor,shuffle", [
    ("<f4", None, False), ("<f8", ZLIB, True), (">i2", GZIP, True), ("<i8", ZLIB, False),
    ("|u1", None, True), ("<u8", GZIP, False), ("|b1", None, False)])
def test_codecs_and_types(spark, folder, dtype, compressor, shuffle):
    root = new_store(folder, "a.zarr")
    data = (np.random.default_rng(3).random((5, 7)) * 100).astype(dtype)
    write_array(root, "v", data, (2, 3), compressor, shuffle)
    m = virtualize(spark, [root], "zarr2")
    got = read_array(as_dataset(m), "v")
    assert np.array_equal(cells(got, data.shape), data.astype("f8"))
    assert got.count() == data.size


def test_integers_stay_exact(spark, folder):
    root = new_store(folder, "a.zarr")
    write_array(root, "i", np.array([2 ** 62 + 1], "<i8"), (1,))
    write_array(root, "u", np.array([2 ** 64 - 1], "<u8"), (1,))
    ds = as_dataset(virtualize(spark, [root], "zarr2"))
    assert read_array(ds, "i").first()["value"] == 2 ** 62 + 1
    assert int(read_array(ds, "u").first()["value"]) == 2 ** 64 - 1


def test_absent_chunks(spark, folder):
    root = new_store(folder, "a.zarr")
    data = np.arange(12, dtype="<f4").reshape(4, 3)
    write_array(root, "v", data, (2, 3), fill=-1, skip=[(1, 0)])
    ds = as_dataset(virtualize(spark, [root], "zarr2"))
    assert read_array(ds, "v").count() == 6
    filled = cells(read_array(ds, "v", fill=True), (4, 3))
    assert np.array_equal(filled[:2], data[:2]) and (filled[2:] == -1).all()
    only = read_array(ds, "v", F.expr("chunk_idx[0] = 1"), fill=True)
    assert only.count() == 6 and only.where("value <> -1").isEmpty()


def test_condition_is_applied_before_reading(spark, folder):
    root = new_store(folder, "a.zarr")
    write_array(root, "v", np.arange(6, dtype="<f4"), (2,))
    ds = as_dataset(virtualize(spark, [root], "zarr2"))
    os.remove(f"{root}/v/2")
    assert rows(read_array(ds, "v", F.expr("chunk_idx[0] = 1"))) == [((2,), 2.0), ((3,), 3.0)]


def test_unknown_codec(spark, folder):
    root = new_store(folder, "a.zarr")
    write_array(root, "v", np.zeros(1, "<f4"), (1,), {"id": "zlib"})
    with open(f"{root}/v/.zarray") as f:
        text = f.read().replace("zlib", "blosc")
    with open(f"{root}/v/.zarray", "w") as out:
        out.write(text)
    with pytest.raises(ValueError, match="blosc"):
        read_array(as_dataset(virtualize(spark, [root], "zarr2")), "v")


def test_stores_to_combined_cells(spark, folder):
    """Write stores, extract, combine, write references, open them, read all cells back."""
    rng, parts, stores = np.random.default_rng(4), [], []
    for i, n in enumerate((4, 2, 3)):
        root = new_store(folder, f"g{i}.zarr")
        data = rng.random((n, 5)).astype("<f4")
        write_array(root, "sst", data, (2, 3), ZLIB, True, dims=["time", "x"])
        write_array(root, "time", np.arange(n, dtype="<i8") + 10 * i, (n,), ZLIB if i else None,
                    dims=["time"])
        write_array(root, "x", np.arange(5, dtype="<i4"), (5,),
                    dims=["x"])
        parts.append(data)
        stores.append(root)
    found = granules(spark, [granule(s, i, f"2022-01-0{i + 1}T00:00:00Z")
                             for i, s in enumerate(stores)])
    m = load_coords(virtualize(spark, stores, "zarr2"), ["time"])
    assert rows(m.variables.where("loadable"), "var") == [("time",)] * 3
    ds = combine(m, found)
    write_refs_json(ds, f"{folder}/all.json")
    back = open_refs(spark, f"{folder}/all.json", "lines")
    assert np.array_equal(cells(read_array(back, "sst"), (9, 5)),
                          np.concatenate(parts).astype("f8"))
    assert [v for _, v in rows(read_array(back, "time"))] == [0, 1, 2, 3, 10, 11, 20, 21, 22]
    assert read_array(back, "x").count() == 5


def test_nested_groups(spark, folder):
    root = new_store(folder, "a.zarr")
    os.makedirs(f"{root}/sub")
    with open(f"{root}/sub/.zgroup", "w") as out:
        out.write('{"zarr_format":2}')
    write_array(root, "sub/v", np.arange(3, dtype="<i4"), (3,), dims=["t"])
    m = virtualize(spark, [root], "zarr2")
    assert rows(m.variables, "var", "dims") == [("sub/v", ("t",))]
    assert rows(m.attrs, "scope", "key") == [("", "title"), ("sub/v", "units")]
    assert rows(read_array(as_dataset(m), "sub/v"), "value") == [(0,), (1,), (2,)]


def test_columnar_footer(spark, folder):
    path = f"{folder}/t.parquet"
    pq.write_table(pa.table({"a": list(range(10)), "b": ["x"] * 10}), path, row_group_size=4)
    m = virtualize(spark, [path], "parquet")
    assert rows(m.dims, "dim", "size") == [("row", 10)]
    assert rows(m.variables, "var", "shape", "chunk_shape") == [
        ("a", (10,), (4,)), ("b", (10,), (4,))]
    got = {(r["var"], r["chunk_idx"][0]): (r["offset"], r["length"])
           for r in m.chunk_refs.collect()}
    meta = pq.ParquetFile(path).metadata
    for (c, name), g in itertools.product(enumerate("ab"), range(3)):
        column = meta.row_group(g).column(c)
        assert got[name, g] == (column.dictionary_page_offset or column.data_page_offset,
                                column.total_compressed_size)


def test_retry(spark, folder):
    assert [backoff(n) for n in (1, 2, 3, 4)] == [1, 4, 9, 16]

    def flaky(path):
        """Fails until the third try, after having given a row."""
        counter = f"{folder}/{path}.tries"
        tries = len(open(counter).read()) if os.path.exists(counter) else 0
        with open(counter, "a") as out:
            out.write("x")
        yield "dims", {"dim": "t", "size": tries}
        if path == "bad" or tries < 2:
            raise ValueError("not yet")

    no_wait = lambda n: 0.0
    m = virtualize(spark, ["a", "b"], flaky, wait=no_wait)
    assert rows(m.dims) == [("a", "t", 2), ("b", "t", 2)] and m.errors.isEmpty()
    with pytest.raises(Exception, match="could not process file bad"):
        virtualize(spark, ["bad"], flaky, wait=no_wait)
    m = virtualize(spark, ["c", "bad"], flaky, wait=no_wait, on_error="quarantine")
    assert rows(m.dims) == [("c", "t", 2)]
    assert rows(m.errors, "granule_id") == [("bad",)]
    with pytest.raises(ValueError):
        virtualize(spark, ["a"], flaky, on_error="ignore")


def test_quarantined_store(spark, folder):
    root = new_store(folder, "a.zarr")
    write_array(root, "v", np.arange(3, dtype="<i4"), (3,))
    m = virtualize(spark, [root, f"{folder}/absent.zarr"], "zarr2", attempts=1,
                   wait=lambda n: 0.0, on_error="quarantine")
    assert rows(m.variables, "var") == [("v",)]
    assert rows(m.errors, "granule_id") == [(f"{folder}/absent.zarr",)]
