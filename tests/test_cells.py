import os
import re
import tempfile

import numpy as np
import pytest
from conftest import granule, granules, rows
from test_arrays import ZLIB, as_dataset, new_store, write_array

from chunkatlas.operators.combine import combine
from chunkatlas.schemas import Dataset
from chunkatlas.sinks.records import write_records
from chunkatlas.sources.arrays import load_coords
from chunkatlas.sources.cells import CellReader, ChunkRange, RangedTable, cells
from chunkatlas.sources.virtualize import virtualize

DATA = np.random.default_rng(5).random((11, 7)).astype("<f4")


@pytest.fixture(scope="module")
def stored(spark):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    root = new_store(folder, "a.zarr")
    write_array(root, "v", DATA, (2, 3), ZLIB, fill=-1, dims=["t", "x"], skip=[(1, 0)])
    write_array(root, "s", np.array(4, "<i8"), (), dims=[])
    write_array(root, "g/w", np.arange(5, dtype="<i4"), (2,), dims=["value"])
    write_records(as_dataset(virtualize(spark, [root], "zarr2")), f"{folder}/r", 4)
    return root, f"{folder}/r"


def expected(keep):
    return sorted(((t, x, float(DATA[t, x])) for t in range(11) for x in range(7)
                   if keep(t, x) and (t // 2, x // 3) != (1, 0)), key=repr)


@pytest.mark.parametrize("where,keep", [
    ("true", lambda t, x: True),
    ("t >= 3 AND t < 8 AND x = 4", lambda t, x: 3 <= t < 8 and x == 4),
    ("t IN (0, 9) AND x <= 2", lambda t, x: t in (0, 9) and x <= 2),
    ("t > 9 OR x = 0", lambda t, x: t > 9 or x == 0),
    ("t > 100", lambda t, x: False), ("t < -1", lambda t, x: False),
    ("t BETWEEN -5 AND 1 AND value > 0.5", lambda t, x: t <= 1 and DATA[t, x] > 0.5)])
@pytest.mark.parametrize("chunks", [None, 2])
def test_conditions(spark, stored, where, keep, chunks):
    assert rows(cells(spark, stored[1], "v", chunks=chunks).where(where)) == expected(keep)


def test_only_chunks_of_the_box_are_opened(spark, stored):
    root, path = stored
    found = cells(spark, path, "v").where("t >= 4 AND t <= 7 AND x > 2 AND x < 6")
    away = [n for n in os.listdir(f"{root}/v") if n[0] != "." and n not in ("2.1", "3.1")]
    for name in away:
        os.rename(f"{root}/v/{name}", f"{root}/v/_{name}")
    try:
        assert rows(found) == expected(lambda t, x: 4 <= t <= 7 and 3 <= x < 6)
    finally:
        for name in away:
            os.rename(f"{root}/v/_{name}", f"{root}/v/{name}")
    # All conditions are the reader's: none is left to a filter of Spark's.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(^|[-\s])Filter ", plan) and "BatchScan array_cells" in plan


def test_absent_chunks_scalars_and_names(spark, stored):
    filled = cells(spark, stored[1], "v", fill=True).where("t IN (2, 3) AND x < 3")
    assert filled.count() == 6 and filled.where("value <> -1").isEmpty()
    assert rows(cells(spark, stored[1], "s")) == [(4,)]
    other = cells(spark, stored[1], "g/w").where("i0 >= 3")
    assert other.columns == ["i0", "value"] and rows(other) == [(3, 3), (4, 4)]
    with pytest.raises(Exception, match="absent"):
        cells(spark, stored[1], "absent")


def test_inline_chunks(spark, folder):
    stores = []
    for i in range(2):
        stores.append(new_store(folder, f"g{i}.zarr"))
        write_array(stores[-1], "time", np.arange(3, dtype="<i8") + 10 * i, (3,), dims=["time"])
    found = granules(spark, [granule(s, i, f"2022-01-0{i + 1}T00:00:00Z") for i, s in enumerate(stores)])
    ds = combine(load_coords(virtualize(spark, stores, "zarr2"), ["time"]), found)
    assert isinstance(ds, Dataset)
    from chunkatlas.sinks.refs import write_refs_json
    from chunkatlas.sources.refs import open_refs
    write_refs_json(ds, f"{folder}/all.json")
    write_records(open_refs(spark, f"{folder}/all.json", "lines"), f"{folder}/r", 4)
    assert rows(cells(spark, f"{folder}/r", "time").where("time > 2")) == [(3, 10), (4, 11), (5, 12)]


def test_ranged_rows(spark, folder):
    table = spark.range(0, 1000, 2).selectExpr("id AS k", "id * 3 AS v")
    table.repartitionByRange(7, "k").sortWithinPartitions("k").write.parquet(f"{folder}/t")
    ranged = RangedTable(f"{folder}/t", "k")
    wanted = np.array([-4, 0, 3, 500, 502, 998, 2000])
    assert [r["v"] for part in ranged.pick(wanted) for r in part.to_pylist()] == [0, 1500, 1506, 2994]
    fresh = RangedTable(f"{folder}/t", "k")
    assert [r["k"] for part in fresh.pick(np.array([4])) for r in part.to_pylist()] == [4]
    assert len(fresh._spans) < len(fresh.files) == 7
    assert list(RangedTable(f"{folder}/none", "k").pick(wanted)) == []


def test_many_chunks_make_bounded_tasks():
    from chunkatlas.sources.arrays import ArrayInfo
    info = ArrayInfo((10 ** 12, 10), (10, 10), "<f4", None, (), "C", None)
    reader = CellReader("r", "v", False, None, ["t", "x"], info, 16)
    parts = reader.partitions()
    assert len(parts) <= 20_000 and parts[-1].end == 10 ** 11 and parts[0] == ChunkRange(0, parts[0].end)
