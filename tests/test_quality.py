import pytest
from conftest import manifest, rows, variable

from chunkatlas.operators.attrs import merge_attrs, require_attrs
from chunkatlas.operators.classes import KINDS, schema_classes, schema_mismatches
from chunkatlas.operators.quality import (IncompatibleGranules, compat_gate, compat_report,
                                          dim_conflicts, var_mismatches)


@pytest.fixture
def checked(spark):
    line = ["line", "pixel"]
    variables = [variable("g0", "sst", line, (10, 4)), variable("g1", "sst", line, (10, 4)),
                 variable("g1", "flag", line, (10, 4)),
                 variable("g2", "sst", line, (9, 4), dtype="<f8"),
                 variable("g3", "sst", line[::-1], (4, 10))]
    dims = [(g, d, n) for g, n in (("g0", 10), ("g1", 10), ("g2", 9), ("g3", 10))
            for d, n in (("line", n), ("pixel", 4))]
    found = spark.createDataFrame([(f"g{i}", i, f"s3://b/{i}") for i in range(5)],
                                  "granule_id STRING, search_rank BIGINT, url STRING")
    return manifest(spark, dims, variables), found


def test_dim_conflicts(checked):
    m, found = checked
    assert rows(dim_conflicts(m.dims, found)) == [
        ("line", 10, 3, ("s3://b/0", "s3://b/1", "s3://b/3"), False),
        ("line", 9, 1, ("s3://b/2",), False)]
    assert rows(dim_conflicts(m.dims, found, k=2))[0] == (
        "line", 10, 3, ("s3://b/0", "s3://b/1"), True)


def test_mismatches(checked):
    m, found = checked
    basic = [("g2", "sst", "dtype"), ("g2", "sst", "shape"), ("g4", "sst", "missing")]
    assert rows(var_mismatches(m.variables, found)) == basic
    assert rows(var_mismatches(m.variables, found, extra=True)) == [
        ("g1", "flag", "extra"), *basic]


def test_mismatch_values_and_places(spark, checked):
    m, _ = checked
    # g0 is found second by its rank but first by its spec; g2 is found twice.
    found = spark.createDataFrame(
        [("g0", 0, 7, "u0"), ("g2", 0, 8, "u2"), ("g1", 1, 1, "u1"), ("g2", 1, 2, "u2"), ("g3", 1, 3, "u3"),
         ("g4", 1, 4, "u4")], "granule_id STRING, spec_no INT, search_rank BIGINT, url STRING")
    got = schema_mismatches(m.variables, found, ["spec_no", "search_rank"], KINDS)
    assert rows(got, "spec_no", "search_rank", "var", "kind", "expected", "found", "url", "first_url") == sorted([
        *[(s, r, "sst", kind, a, b, "u2", "u0") for s, r in ((0, 8), (1, 2))
          for kind, a, b in (("dtype", '"<f4"', '"<f8"'), ("shape", "[10,4]", "[9,4]"),
                             ("chunks", "[10,4]", "[9,4]"))],
        (1, 1, "flag", "extra", None, '"<f4" [10,4]', "u1", "u0"),
        (1, 3, "sst", "dims", '["line","pixel"]', '["pixel","line"]', "u3", "u0"),
        (1, 4, "sst", "missing", '"<f4" [10,4]', None, "u4", "u0")], key=repr)
    with pytest.raises(ValueError, match="no such kinds"):
        schema_mismatches(m.variables, found, kinds=["size"])


def test_schema_classes_ignore_the_order_of_rows(spark):
    variables = [variable("a", "v", ["x"], (1,)), variable("a", "w", ["x"], (2,)),
                 variable("b", "w", ["x"], (2,)), variable("b", "v", ["x"], (1,)),
                 variable("c", "v", ["x"], (2,)), variable("c", "w", ["x"], (1,))]
    members, classes = schema_classes(manifest(spark, variables=variables).variables)
    of = dict(rows(members, "granule_id", "class_id"))
    assert of["a"] == of["b"] != of["c"]
    assert rows(classes, "class_id", "n_granules", "var", "shape") == sorted([
        (of["a"], 2, "v", (1,)), (of["a"], 2, "w", (2,)), (of["c"], 1, "v", (2,)), (of["c"], 1, "w", (1,))],
        key=repr)


def test_nothing_to_compare(spark):
    m = manifest(spark)
    found = spark.createDataFrame([("g0", 0), ("g1", 1)], "granule_id STRING, search_rank BIGINT")
    assert rows(schema_mismatches(m.variables, found, kinds=KINDS)) == []
    assert rows(schema_mismatches(m.variables, found.limit(0), kinds=KINDS)) == []


def test_a_granule_found_twice_counts_once(spark):
    dims = [("a", "x", 1), ("b", "x", 2), ("c", "x", 2)]
    found = spark.createDataFrame([("c", 0, 9, "uc"), ("a", 1, 0, "ua"), ("b", 1, 1, "ub"), ("c", 1, 2, "uc")],
                                  "granule_id STRING, spec_no INT, search_rank BIGINT, url STRING")
    assert rows(dim_conflicts(manifest(spark, dims).dims, found, order=["spec_no", "search_rank"])) == [
        ("x", 1, 1, ("ua",), False), ("x", 2, 2, ("uc", "ub"), False)]


def test_the_last_place_is_exempt_not_its_granule(spark):
    variables = [variable(f"g{i}", "v", ["time"], (n,), (2,)) for i, n in enumerate([4, 3])]
    found = spark.createDataFrame([("g1", 0, 1), ("g0", 1, 0), ("g1", 1, 1)],
                                  "granule_id STRING, spec_no INT, search_rank BIGINT")
    report = compat_report(manifest(spark, variables=variables), found, "time", ["spec_no", "search_rank"])
    assert rows(report, "granule_id", "spec_no", "n_ragged") == [("g1", 0, 1)]


def test_gate(checked):
    m, found = checked
    assert rows(compat_gate(m, found, strict=False), "granule_id", "n_missing", "n_extra",
                "n_different") == [("g1", 0, 1, 0), ("g2", 0, 0, 1), ("g3", 0, 0, 1),
                                   ("g4", 1, 0, 0)]
    with pytest.raises(IncompatibleGranules, match="4 incompatible"):
        compat_gate(m, found)


def test_partial_chunks_only_at_the_end(spark):
    def report(sizes, axis="time", **kinds):
        variables = [variable(f"g{i}", "v", ["time", "x"], (n, 4), (2, 4), **kinds)
                     for i, n in enumerate(sizes)]
        found = spark.createDataFrame([(f"g{i}", i) for i in range(len(sizes))],
                                      "granule_id STRING, search_rank BIGINT")
        return rows(compat_report(manifest(spark, variables=variables), found, axis), "granule_id")
    assert report([4, 2, 3]) == []
    assert report([4, 3, 2]) == [("g1",)]
    assert report([3, 2]) == [("g0",)]
    assert report([3, 2], loadable=True) == []
    assert report([4, 2], axis=None) == [("g1",)]


def test_other_sizes_and_codecs_must_agree(spark):
    variables = [variable("g0", "v", ["time", "x"], (2, 4), (1, 4)),
                 variable("g1", "v", ["time", "x"], (5, 4), (1, 4)),
                 variable("g2", "v", ["time", "x"], (2, 8), (1, 4)),
                 variable("g3", "v", ["time", "x"], (2, 4), (1, 4), codec='{"compressor":1}'),
                 variable("g4", "v", ["time", "x"], (2, 4), (2, 4))]
    found = spark.createDataFrame([(f"g{i}", i) for i in range(5)],
                                  "granule_id STRING, search_rank BIGINT")
    assert rows(compat_report(manifest(spark, variables=variables), found, "time"),
                "granule_id") == [("g2",), ("g3",), ("g4",)]


def test_attrs(spark):
    table = spark.createDataFrame(
        [("a", "", "title", '"A"'), ("b", "", "title", '"A"'), ("c", "", "title", '"A"'),
         ("a", "", "v", "1"), ("b", "", "v", "2"), ("c", "", "only", '"x"'),
         ("a", "v", "scale", "1"), ("b", "v", "scale", "1.0"), ("c", "v", "scale", "1e0"),
         ("a", "v", "big", "9007199254740993"), ("b", "v", "big", "9007199254740992"),
         ("a", "v", "none", "null"), ("b", "v", "none", '""'), ("a", "v", "frac", "0.50"),
         ("b", "v", "frac", "0.5")],
        "granule_id STRING, scope STRING, key STRING, value_json STRING")
    assert rows(merge_attrs(table)) == [("", "only", '"x"'), ("", "title", '"A"'),
                                        ("v", "frac", "0.5"), ("v", "scale", "1")]
    dropped = merge_attrs(table, with_dropped=True).where("dropped")
    assert rows(dropped, "scope", "key") == [("", "v"), ("v", "big"), ("v", "none")]
    assert require_attrs(merge_attrs(table)) is not None
    with pytest.raises(ValueError, match="no global attributes"):
        require_attrs(merge_attrs(table.where("key = 'v'")))
