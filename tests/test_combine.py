import datetime as dt

import pytest
from conftest import granule, granules, manifest, rows, variable
from pyspark.sql import functions as F

from chunkatlas import session
from chunkatlas.functions import epoch_seconds
from chunkatlas.operators import combine as module
from chunkatlas.operators.combine import choose_mode, combine, subset_by_start
from chunkatlas.operators.coords import with_auxiliary
from chunkatlas.operators.quality import IncompatibleGranules

STARTS = {"g0": "2022-01-03T00:00:00Z", "g1": "2022-01-01T00:00:00Z", "g2": "2022-01-02T00:00:00"}
STEPS = {"g0": 2, "g1": 1, "g2": 3}


@pytest.fixture
def found(spark):
    return granules(spark, [granule(g, 10 * i, begin, cycle=i, passes=(i + 5,))
                            for i, (g, begin) in enumerate(STARTS.items())])


def chunk(g, var, *idx):
    return (g, var, list(idx), f"s3://b/{g}.nc", sum(idx), 8, None)


@pytest.fixture
def existing(spark):
    """``sst(time, x)``, ``mask(x)`` without the axis, coordinates ``time(time)`` and ``lat(x)``."""
    variables, chunks, values, dims = [], [], [], []
    for g, n in STEPS.items():
        variables += [variable(g, "sst", ["time", "x"], (n, 4), (1, 2)),
                      variable(g, "mask", ["x"], (4,), (4,)),
                      variable(g, "lat", ["x"], (4,), (4,), coord=True),
                      variable(g, "time", ["time"], (n,), (8,), coord=True,
                               loadable=True)]
        chunks += [chunk(g, "sst", i, j) for i in range(n) for j in range(2)]
        chunks += [chunk(g, "mask", 0), chunk(g, "lat", 0)]
        values += [(g, "time", i, float(100 * n + i)) for i in range(n)]
        dims += [(g, "time", n), (g, "x", 4)]
    attrs = [(g, "", "title", '"A"') for g in STEPS] + [(g, "", "v", f"{i}")
                                                        for i, g in enumerate(STEPS)]
    return manifest(spark, dims, variables, attrs, chunks, values)


@pytest.fixture
def equal(spark):
    """Granules of equal shape, for a new axis."""
    variables, chunks, dims = [], [], []
    for g in STARTS:
        variables += [variable(g, "sst", ["y"], (2,), (1,)),
                      variable(g, "latitude", ["y"], (2,), (2,), coord=True),
                      variable(g, "lat", ["y"], (2,), (2,), coord=True),
                      variable(g, "crs", [], (), (), coord=True)]
        chunks += [chunk(g, "sst", 0), chunk(g, "sst", 1), chunk(g, "latitude", 0),
                   chunk(g, "lat", 0), chunk(g, "crs")]
        dims.append((g, "y", 2))
    return manifest(spark, dims, variables, [(g, "", "title", '"A"') for g in STARTS], chunks)


def keys(ds, var):
    return rows(ds.chunk_refs.where(F.col("var") == var), "chunk_idx", "granule_id")


def test_existing_axis(found, existing):
    ds = combine(existing, found)
    assert keys(ds, "sst") == [((i, j), g) for i, g in enumerate(
        ["g0", "g0", "g1", "g2", "g2", "g2"]) for j in range(2)]
    assert keys(ds, "lat") == [((0,), "g0")]
    assert keys(ds, "mask") == [((i, 0), g) for i, g in enumerate(
        ["g0", "g0", "g1", "g2", "g2", "g2"])]
    assert rows(ds.coord_values, "pos", "value") == [
        (0, 200.0), (1, 201.0), (2, 100.0), (3, 300.0), (4, 301.0), (5, 302.0)]
    assert rows(ds.dims) == [("time", 6), ("x", 4)]
    assert rows(ds.variables, "var", "dims", "shape", "chunk_shape") == [
        ("lat", ("x",), (4,), (4,)), ("mask", ("time", "x"), (6, 4), (1, 4)),
        ("sst", ("time", "x"), (6, 4), (1, 2)), ("time", ("time",), (6,), (8,))]
    assert rows(ds.attrs) == [("", "title", '"A"')]
    assert rows(ds.axis, "granule_id", "ordinal", "axis_offset", "axis_size") == [
        ("g0", 0, 0, 2), ("g1", 1, 2, 1), ("g2", 2, 3, 3)]


def test_chunks_longer_than_one_step(spark, found):
    sizes = {"g0": 4, "g1": 2, "g2": 3}
    m = manifest(spark, [(g, "time", n) for g, n in sizes.items()],
                 [variable(g, "v", ["time"], (n,), (2,)) for g, n in sizes.items()], (),
                 [chunk(g, "v", i) for g, n in sizes.items() for i in range(-(-n // 2))])
    assert keys(combine(m, found), "v") == [((0,), "g0"), ((1,), "g0"), ((2,), "g1"),
                                            ((3,), "g2"), ((4,), "g2")]


def test_axis_that_is_not_the_first_dimension(spark, found):
    m = manifest(spark, [(g, "time", n) for g, n in STEPS.items()],
                 [variable(g, "v", ["x", "time"], (2, n), (2, 1)) for g, n in STEPS.items()], (),
                 [chunk(g, "v", 0, i) for g, n in STEPS.items() for i in range(n)])
    assert [idx for idx, _ in keys(combine(m, found), "v")] == [(0, i) for i in range(6)]


def test_new_axis_in_search_order(found, equal):
    ds = combine(equal, found, "seconds")
    assert keys(ds, "sst") == [((i, j), f"g{i}") for i in range(3) for j in range(2)]
    assert keys(ds, "lat") == [((i, 0), f"g{i}") for i in range(3)]
    assert keys(ds, "latitude") == [((0,), "g0")]
    assert keys(ds, "crs") == [((), "g0")]
    day = 1640995200
    assert rows(ds.axis, "ordinal", "start") == [
        (0, day + 2 * 86400), (1, day), (2, day + 86400)]
    assert ("orbit_segment_start_time", 3) in rows(ds.dims)
    assert rows(ds.attrs.where("scope <> ''")) == [
        ("orbit_segment_start_time", "calendar", '"gregorian"'),
        ("orbit_segment_start_time", "units", '"seconds since 1970-01-01T00:00:00"')]


def test_new_axis_by_start(found, equal):
    ds = combine(equal, found, "sorted")
    assert rows(ds.axis, "ordinal", "granule_id") == [(0, "g1"), (1, "g2"), (2, "g0")]
    assert keys(ds, "latitude") == [((0, 0), "g1"), ((1, 0), "g2"), ((2, 0), "g0")]
    assert keys(ds, "lat") == [((0,), "g1")]


def test_equal_starts_keep_search_order(spark, equal):
    tied = granules(spark, [granule(g, i, "2022-01-01T00:00:00Z") for i, g in
                            enumerate(["g2", "g0", "g1"])])
    assert rows(combine(equal, tied, "sorted").axis, "ordinal", "granule_id") == [
        (0, "g2"), (1, "g0"), (2, "g1")]


def test_digits_below_a_microsecond_count(spark, equal):
    close = granules(spark, [granule("g0", 0, "2022-01-01T00:00:00.000000002Z"),
                             granule("g1", 1, "2022-01-01T00:00:00.000000001Z")])
    assert rows(combine(equal, close, "sorted").axis, "ordinal", "granule_id") == [
        (0, "g1"), (1, "g0")]


def test_granule_axis(found, equal):
    ds = combine(equal, found, "granule")
    assert rows(ds.axis, "ordinal", "orbit", "cycle", "ppass", "filename") == [
        (0, dt.datetime(2022, 1, 3), 0, 5, "g0.nc"), (1, dt.datetime(2022, 1, 1), 1, 6, "g1.nc"),
        (2, dt.datetime(2022, 1, 2), 2, 7, "g2.nc")]


def test_coordinate_list_and_axis_name(found, equal):
    ds = combine(equal, found, "granule", coords=[], axis="swath")
    assert keys(ds, "latitude") == [((0,), "g0")]
    assert ds.axis_name == "swath" and ("swath", 3) in rows(ds.dims)


def test_only_searched_granules_are_combined(found, equal):
    ds = combine(equal, found.where("granule_id <> 'g0'"), "seconds")
    assert keys(ds, "sst") == [((0, 0), "g1"), ((0, 1), "g1"), ((1, 0), "g2"), ((1, 1), "g2")]
    assert keys(ds, "latitude") == [((0,), "g1")]


def test_granule_found_twice_is_placed_twice(found, equal):
    twice = found.withColumn("spec_no", F.lit(0)).unionByName(
        found.where("granule_id = 'g1'").withColumn("spec_no", F.lit(1)))
    ds = combine(equal, twice, "seconds", prefix=["spec_no"])
    assert [idx for idx, g in keys(ds, "sst") if g == "g1"] == [(1, 0), (1, 1), (3, 0), (3, 1)]


def test_gate_runs_in_every_mode(spark, found, existing):
    for mode in ("seconds", "sorted", "granule"):
        with pytest.raises(IncompatibleGranules):
            combine(existing, found, mode)
    assert combine(existing, found, "seconds", gate=False).axis.count() == 3


def test_without_broadcasts_the_result_is_the_same(found, existing, monkeypatch):
    expected = rows(combine(existing, found).chunk_refs)
    for name in ("small_side",):
        monkeypatch.setattr(module, name, lambda df: df)
    spark = existing.chunk_refs.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ds = combine(existing, found)
        assert rows(ds.chunk_refs) == expected
        assert "SortMergeJoin" in ds.chunk_refs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_broadcast_is_checked(spark):
    table = spark.range(10)
    assert session.fits(table, max_rows=10)
    assert not session.fits(table, max_rows=9)
    assert not session.fits(table, max_bytes=20)


def test_mode_choice():
    assert choose_mode("C", level2=False).name == "existing"
    assert choose_mode("C", level2=True).name == "seconds"
    assert choose_mode("C", level2=True, special={"C": "granule"}).name == "granule"
    assert choose_mode("C", level2=False, special={"C": "granule"}).name == "existing"


def test_subset(spark, found, equal):
    ds = combine(equal, found, "seconds")
    hits = spark.createDataFrame([("2022-01-01T00:00:00Z",)], "t STRING").select(
        epoch_seconds(F.col("t")).alias("start"))
    part = subset_by_start(ds, hits)
    assert rows(part.axis, "granule_id", "ordinal") == [("g1", 1)]
    assert keys(part, "sst") == [((1, 0), "g1"), ((1, 1), "g1")]
    assert keys(part, "crs") == [((), "g0")]


def test_attributes_name_auxiliary_coordinates(spark):
    variables = [variable("a", v, ["y", "x"], (2, 2)) for v in ("t", "lat2", "aux", "glob", "other")]
    variables += [variable("b", v, ["y", "x"], (2, 2)) for v in ("t", "other")]
    attrs = [("a", "t", "coordinates", '" lat2\\n gone "'), ("a", "lat2", "coordinates", '"aux lat2"'),
             ("a", "", "coordinates", '"glob"'), ("a", "t", "units", '"other"'), ("a", "glob", "coordinates", "3"),
             ("a", "aux", "coordinates", None), ("a", "other", "coordinates", '""'), ("b", "t", "coordinates", '"other"')]
    m = manifest(spark, variables=variables, attrs=attrs)
    assert rows(with_auxiliary(m.variables, m.attrs).where("is_coord"), "granule_id", "var") == [
        ("a", "aux"), ("a", "glob"), ("a", "lat2"), ("b", "other")]
    first = m.variables.where("granule_id = 'a'")
    assert with_auxiliary(first, m.attrs).columns == first.columns
    assert rows(with_auxiliary(first, m.attrs.limit(0)), "var", "is_coord") == [
        (v, False) for v in ("aux", "glob", "lat2", "other", "t")]
