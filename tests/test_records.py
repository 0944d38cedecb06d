import pytest
from conftest import rows, variable

from chunkatlas import schemas as S
from chunkatlas.schemas import Dataset
from chunkatlas.session import local_frame
from chunkatlas.sinks import records
from chunkatlas.sinks.records import open_records, read_records, write_records


def dataset(spark, chunks):
    def make(found, schema):
        return local_frame(spark, found, schema)
    names = [variable("g", "v", ["t", "y"], [10, 5], [2, 2]), variable("g", "w/x", ["t"], [7], [1]), variable("g", "s", [], [])]
    drop = S.CHUNK_REFS.replace("granule_id STRING, ", "")
    return Dataset(make([], "dim STRING, size BIGINT"), make(names, S.VARIABLES).drop("granule_id"),
                   make([], "scope STRING, key STRING, value_json STRING"), make(chunks, drop),
                   make([], "var STRING, pos BIGINT, value DOUBLE"))


CHUNKS = [("v", [i, j], f"s3://b/{i % 2}/{i}.nc", 10 * i + j, 7, None) for i in range(5) for j in range(3) if (i + j) % 4] + [
    ("w/x", [6], "plain", None, None, None), ("w/x", [0], None, None, None, "inline é"), ("s", [], "https://h/s", 0, 1, None)]


@pytest.mark.parametrize("size", [1, 4])
def test_records_round_trip(spark, folder, size):
    ds = dataset(spark, CHUNKS)
    write_records(ds, f"{folder}/r", size)
    back = open_records(spark, f"{folder}/r")
    assert rows(back.chunk_refs) == rows(ds.chunk_refs) and rows(back.variables) == rows(ds.variables)
    stored = spark.read.parquet(f"{folder}/r/records")
    assert {r["n"] for r in stored.selectExpr("length(records) AS n").collect()} == {24 * size}


def test_one_chunk_is_read_alone(spark, folder):
    write_records(dataset(spark, CHUNKS), f"{folder}/r", 4)
    # Chunk (2, 1) of a grid of 5 by 3 is number 7, and (0, 0) is absent.
    one = read_records(spark, f"{folder}/r", "v", [7, 0])
    assert rows(one, "chunk_idx", "url", "offset") == [((2, 1), "s3://b/0/2.nc", 21)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(var" in plan and "In(row, [0,1])" in plan
    assert rows(read_records(spark, f"{folder}/r", "none")) == []


def test_chunks_outside_the_grid(spark, folder):
    with pytest.raises(Exception, match="outside its grid"):
        write_records(dataset(spark, [("v", [5, 0], "u", 0, 1, None)]), f"{folder}/r")
    write_records(dataset(spark, []), f"{folder}/empty")
    assert open_records(spark, f"{folder}/empty").chunk_refs.count() == 0


def test_grids_of_any_rank(spark, folder):
    """One and two dimensions take another path than more of them; a name may hold a line break."""
    def make(found, schema):
        return local_frame(spark, found, schema)
    names = [variable("g", f"v{k}", list("abc"[:k]), [5] * k, [2] * k) for k in range(4)]
    chunks = [(f"v{k}", [(i + d) % 3 for d in range(k)], f"s3://b/x\ny/{i}.nc" if k else "u", i, 1, None)
              for k in range(4) for i in range(3 if k else 1)]
    ds = dataset(spark, [])
    ds = Dataset(ds.dims, make(names, S.VARIABLES).drop("granule_id"), ds.attrs,
                 make(chunks, S.CHUNK_REFS.replace("granule_id STRING, ", "")), ds.coord_values)
    write_records(ds, f"{folder}/r", 2)
    assert rows(open_records(spark, f"{folder}/r").chunk_refs) == rows(ds.chunk_refs)
    for bad in ([3, 0], [0, -1], [0], [0, None]):
        with pytest.raises(Exception, match="outside its grid"):
            write_records(Dataset(ds.dims, ds.variables, ds.attrs, make(
                [("v2", bad, "u", 0, 1, None)], S.CHUNK_REFS.replace("granule_id STRING, ", "")), ds.coord_values),
                f"{folder}/bad")


def test_records_are_sorted_by_one_number(spark, folder, monkeypatch):
    """Variable and row are told apart though they share a hash."""
    monkeypatch.setattr(records.F, "xxhash64", lambda *c: records.F.lit(7).cast("bigint"))
    ds = dataset(spark, CHUNKS)
    write_records(ds, f"{folder}/r", 4)
    assert rows(open_records(spark, f"{folder}/r").chunk_refs) == rows(ds.chunk_refs)
