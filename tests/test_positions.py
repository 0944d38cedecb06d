"""Inputs that have no right position, and ties."""

import numpy as np
import pytest
from conftest import granule, granules, manifest, rows, variable

from chunkatlas.operators.combine import combine
from chunkatlas.operators.ordering import order_by_start, with_ordinal, with_ordinal_sorted
from chunkatlas.session import local_frame
from chunkatlas.sources.arrays import load_coords, read_array
from chunkatlas.sources.storage import locate


def test_a_null_rank_is_refused(spark):
    ranks = local_frame(spark, [(0,), (None,), (2,)], "search_rank BIGINT")
    with pytest.raises(Exception, match="a row without a position"):
        with_ordinal(ranks).collect()


def test_equal_instants_keep_search_order(spark):
    found = local_frame(spark, [
        ("2022-01-01T00:00:00Z", 0), ("2022-01-01T00:00:00.000Z", 1),
        ("2022-01-01T00:00:00.00000015Z", 2), ("2022-01-01T00:00:00.0000001Z", 3)],
        "begin_raw STRING, search_rank BIGINT").selectExpr(
            "begin_raw", "search_rank", "timestamp'2022-01-01 00:00:00' AS begin")
    got = with_ordinal_sorted(found, order_by_start()).orderBy("ordinal")
    assert [r["search_rank"] for r in got.collect()] == [0, 1, 3, 2]


def test_nothing_goes_behind_a_partial_chunk(spark):
    found = granules(spark, [granule(g, i, f"2022-01-0{i + 1}T00:00:00Z") for i, g in enumerate("ab")])
    made = manifest(
        spark, dims=[("a", "time", 3), ("b", "time", 2)],
        variables=[variable("a", "v", ["time"], [3], [2]), variable("b", "v", ["time"], [2], [2])],
        chunks=[("a", "v", [0], "u", 0, 8, None), ("a", "v", [1], "u", 8, 8, None),
                ("b", "v", [0], "u", 0, 8, None)])
    with pytest.raises(Exception, match="partial chunk of v lies before granule b"):
        combine(made, found, "existing", gate=False).chunk_refs.collect()


def test_nan_is_a_value_and_large_integers_are_not_rounded(spark, folder):
    np.array([1.5, np.nan], "<f4").tofile(f"{folder}/f")
    np.array([1690329600123456789], "<i8").tofile(f"{folder}/i")
    found = granules(spark, [granule("a", 0, "2022-01-01T00:00:00Z")])
    made = manifest(
        spark, dims=[("a", "time", 2), ("a", "k", 1)],
        variables=[variable("a", "v", ["time"], [2]), variable("a", "t", ["k"], [1], dtype="<i8")],
        chunks=[("a", "v", [0], f"{folder}/f", 0, 8, None), ("a", "t", [0], f"{folder}/i", 0, 8, None)])
    values = dict(rows(read_array(combine(made, found), "v")))
    assert values[(0,)] == 1.5 and np.isnan(values[(1,)])
    loaded = load_coords(made, ["v"]).coord_values.where("isnan(value)")
    assert rows(loaded, "pos") == [(1,)]
    with pytest.raises(Exception, match="not exact as a double"):
        load_coords(made, ["t"]).coord_values.collect()


def test_scheme_names_of_one_store(monkeypatch):
    seen = []
    monkeypatch.setattr("chunkatlas.sources.storage.pafs.FileSystem", type(
        "Store", (), {"from_uri": staticmethod(seen.append)}))
    for name in ("s3", "s3a", "s3n"):
        locate(f"{name}://b/k")
    assert seen == ["s3://b/k"] * 3
