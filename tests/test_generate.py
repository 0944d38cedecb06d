"""The whole run on stores written here."""

import json
import os

import numpy as np
import pytest
from conftest import granule, granules, rows
from test_arrays import ZLIB, cells, new_store, write_array

from chunkatlas.plans.generate import RunConfig, run
from chunkatlas.sources.arrays import read_array
from chunkatlas.sources.refs import open_refs, open_refs_parquet


@pytest.fixture
def world(spark, folder):
    rng, entries, parts = np.random.default_rng(5), [], []
    for i in range(3):
        root = new_store(folder, f"g{i}.zarr")
        data = rng.random((2, 3)).astype("<f4")
        write_array(root, "sst", data, (1, 3), ZLIB, dims=["time", "x"])
        write_array(root, "time", np.arange(2, dtype="<i8") + 2 * i, (2,), dims=["time"])
        entries.append(granule(f"g{i}", i, f"2022-01-0{i + 1}T00:00:00Z", collection="SEA_L4",
                               links=[("direct", root), ("https", f"https://h/g{i}.zarr")]))
        parts.append(data)
    os.makedirs(f"{folder}/dest")
    return granules(spark, entries), parts


def config(folder, **more):
    return RunConfig(**{"collection": "SEA_L4", "out_dir": f"{folder}/out", "loadable": "time",
                        "default_host": "D", "dests": [f"{folder}/dest", f"{folder}/none"], **more})


def test_run(spark, folder, world):
    found, parts = world
    seen = {}
    row = run(spark, found, config(folder, start="1-1-2022", end="1-2-2022"),
              lambda name, table: seen.update({name: table.count()})).first()
    assert (row["status"], row["granules"], row["links"]) == ("ok", 2, 2)
    assert seen == {"dim_conflicts": 0, "var_mismatches": 0}
    assert row["s3_file"].endswith("/SEA_L4_1-1-2022_to_1-2-2022_virtual_s3.json")
    ds = open_refs(spark, row["s3_file"], "lines")
    assert np.array_equal(cells(read_array(ds, "sst"), (4, 3)),
                          np.concatenate(parts[:2]).astype("f8"))
    assert rows(read_array(ds, "time"), "value") == [(0,), (1,), (2,), (3,)]
    with open(row["https_file"]) as f:
        assert set(json.load(f)["refs"]) >= {"sst/3.0", "time/0", ".zgroup"}
    assert sorted(n for n in os.listdir(f"{folder}/dest/SEA_L4") if not n.startswith(".")) == [
        "SEA_L4_1-1-2022_to_1-2-2022_virtual_https.json",
        "SEA_L4_1-1-2022_to_1-2-2022_virtual_s3.json"]
    table = open_refs_parquet(spark, row["s3_file"].replace(".json", ".parquet"))
    assert table.chunk_refs.count() == 4


def test_nothing_found(spark, folder, world):
    row = run(spark, world[0], config(folder, start="1-1-2030")).first()
    assert (row["status"], row["reason"], row["s3_file"]) == ("empty", "no granules found", None)


def test_specs_replace_the_dates(spark, folder, world):
    specs = {"SEA_L4": [{"short_name": "SEA_L4", "granule_name": "g2*",
                         "temporal": ("2022-01-01", "2022-12-31")},
                        {"short_name": "SEA_L4", "granule_name": "g0*",
                         "temporal": ("2022-01-01", "2022-12-31")}]}
    found, parts = world
    row = run(spark, found, config(folder, start="1-1-2030", specs=specs, level2=True,
                                   modes={"SEA_L4": "granule"}, dests=())).first()
    assert row["spec_override"] and row["granules"] == 2
    assert "1-1-2030_to_present" in row["s3_file"]
    ds = open_refs(spark, row["s3_file"], "lines")
    assert np.array_equal(cells(read_array(ds, "sst"), (2, 2, 3)),
                          np.stack([parts[2], parts[0]]).astype("f8"))
    assert rows(read_array(ds, "cycle"), "value") == [(1,), (1,)]
