import json
import os

import pytest
from conftest import granule, granules, manifest, rows, variable
from pyspark.sql import functions as F

from chunkatlas.operators.combine import combine
from chunkatlas.operators.rewrite import urls_to_https
from chunkatlas.plans.generate import translate
from chunkatlas.sinks.refs import convert_refs, write_refs_json, write_refs_parquet
from chunkatlas.sinks.reports import publish
from chunkatlas.sources.arrays import read_array
from chunkatlas.sources.refs import (open_refs, open_refs_parquet, read_head_json, read_refs_json)

SAMPLE = {"version": 1, "templates": {"u": "s3://b-one/"}, "refs": {
    ".zgroup": '{"zarr_format":2}',
    "sst/.zarray": '{"shape":[2,4],"chunks":[1,4],"dtype":"<f4","compressor":null,"filters":null,'
                   '"fill_value":null,"order":"C","zarr_format":2}',
    "sst/0.0": ["s3://b-one/g0.nc", 100, 16], "sst/1.0": ["s3://b-two/g1.nc", 100, 16],
    "time/0": "base64:AAAAAAAAAAA=", "whole": ["s3://b-one/whole.bin"], "empty": [],
    "gen": {"k": 1}, "null": None, "numbers": [1, 2], "away": ["https://x/y", 1, 2],
    "odd \"key\"": "tab\t line\n quote\" s3://b-one/ü ],\"", "entry": '\n    "x": 1,'}}
RULES = {"buckets": ["b-one"], "hosts": {"b-one": "H"}, "default_host": "D"}


@pytest.fixture
def sample(folder):
    path = f"{folder}/a_virtual_s3.json"
    with open(path, "w", encoding="utf-8") as out:
        json.dump(SAMPLE, out)
    return path


def load(path):
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def expected():
    refs = dict(SAMPLE["refs"])
    refs["sst/0.0"] = ["https://H/b-one/g0.nc", 100, 16]
    refs["sst/1.0"] = ["https://D/b-two/g1.nc", 100, 16]
    refs["whole"] = ["https://H/b-one/whole.bin"]
    refs["odd \"key\""] = "tab\t line\n quote\" https://H/b-one/ü ],\""
    return {**SAMPLE, "refs": refs}


def test_kinds(spark, sample):
    got = {r["key"]: r["kind"] for r in read_refs_json(spark, sample).collect()}
    assert got == {k: "ref" if k in ("sst/0.0", "sst/1.0", "whole", "away") else
                   "inline" if isinstance(v, str) else "other"
                   for k, v in SAMPLE["refs"].items()}
    head = read_head_json(spark, sample)
    assert json.loads(head) == {k: v for k, v in SAMPLE.items() if k != "refs"}


def test_last_of_repeated_keys_counts(spark, folder):
    path = f"{folder}/twice.json"
    with open(path, "w") as out:
        out.write('{"refs": {"a": "first", "a": "last"}}')
    assert rows(read_refs_json(spark, path), "key", "inline_text") == [("a", "last")]


def test_convert(spark, sample, folder):
    target = f"{folder}/a_virtual_https.json"
    convert_refs(spark, sample, target, **RULES)
    assert load(target) == expected()
    with open(target) as f:
        lines = f.read().split("\n")
    assert lines[0] == "{" and lines[-1] == "}"
    assert '    "sst/0.0": [' in lines and '      "https://H/b-one/g0.nc",' in lines
    with pytest.raises(FileExistsError):
        convert_refs(spark, target, target, **RULES)
    with pytest.raises(FileExistsError):
        convert_refs(spark, sample, **RULES)
    convert_refs(spark, sample, overwrite=True, **RULES)
    assert load(sample) == expected()
    # Lists are not changed by a second run.
    convert_refs(spark, sample, overwrite=True, **RULES)
    assert load(sample)["refs"]["sst/0.0"] == expected()["refs"]["sst/0.0"]


def test_file_without_refs_stays(spark, folder):
    path = f"{folder}/plain.json"
    with open(path, "w") as out:
        json.dump({"a": [1, {"b": "s3://b-one/"}]}, out)
    convert_refs(spark, path, f"{folder}/out.json", **RULES)
    assert load(f"{folder}/out.json") == load(path)


def test_url_or_file(spark, sample, folder):
    assert translate(spark, "s3://b-one/x", **RULES) == "https://H/b-one/x"
    out = translate(spark, sample, f"{folder}/out.json", **RULES)
    assert load(out) == expected()


def test_hosts_in_a_table(spark):
    urls = spark.createDataFrame([("s3://b-one/x",), ("s3://z/x",), ("ftp://z",)], "url STRING")
    hosts = spark.createDataFrame([("b-one", "H")], "bucket STRING, host STRING")
    assert rows(urls_to_https(urls, hosts, "D"), "https_url") == [
        ("ftp://z",), ("https://D/z/x",), ("https://H/b-one/x",)]


@pytest.mark.parametrize("indent,layout", [(False, "lines"), (True, "indented")])
@pytest.mark.parametrize("kind", ["file", "parts"])
def test_layouts_that_split(spark, sample, folder, indent, layout, kind):
    refs = read_refs_json(spark, sample)
    path = f"{folder}/{layout}-{kind}.json"
    write_refs_json(refs, path, '{"version":1,"templates":{"u":"{{"}}', indent, kind)
    assert os.path.isdir(path) == (kind == "parts")
    assert json.loads(read_head_json(spark, path, layout)) == {"version": 1, "templates": {"u": "{{"}}
    text = "".join(open(f"{path}/{part}", encoding="utf-8").read() for part in sorted(
        part for part in os.listdir(path) if part[0] not in "._")) if kind == "parts" else open(
        path, encoding="utf-8").read()
    assert json.loads(text) == {"version": 1, "templates": {"u": "{{"}, "refs": SAMPLE["refs"]}
    assert rows(read_refs_json(spark, path, layout)) == rows(refs)


def test_last_of_repeated_keys(spark, folder):
    """A repeated key, be it the last in order, leaves a valid file with its last entry."""
    line = '"{}":["s3://b/{}",0,1]'.format
    with open(f"{folder}/in", "w", encoding="utf-8") as out:
        out.write(",\n".join([line("a", 1), line("z", 1), line("a", 2), line("z", 2)]) + "\n")
    write_refs_json(read_refs_json(spark, f"{folder}/in", "lines"), f"{folder}/out.json")
    assert load(f"{folder}/out.json")["refs"] == {"a": ["s3://b/2", 0, 1], "z": ["s3://b/2", 0, 1]}


def test_axis_value_that_is_missing(spark, folder):
    """A granule without a cycle keeps its spot; the fill value stands there."""
    found = granules(spark, [granule("a", 0, "2022-01-01T00:00:00Z", cycle=None),
                             granule("b", 1, "2022-01-02T00:00:00Z", cycle=7)])
    made = manifest(spark, dims=[(g, "y", 4) for g in "ab"],
                    variables=[variable(g, "ssh", ["y"], [4]) for g in "ab"],
                    chunks=[(g, "ssh", [0], f"s3://b/{g}", 0, 16, None) for g in "ab"])
    write_refs_json(combine(made, found, "granule"), f"{folder}/g.json")
    cells = rows(read_array(open_refs(spark, f"{folder}/g.json"), "cycle"))
    assert cells == [((0,), -(1 << 63)), ((1,), 7)]
    fill = json.loads(load(f"{folder}/g.json")["refs"]["cycle/.zarray"])["fill_value"]
    assert fill == -(1 << 63)


def test_parts_are_published(spark, folder):
    os.makedirs(f"{folder}/out")
    os.makedirs(f"{folder}/dest")
    refs = read_refs_json(spark, _written(folder))
    write_refs_json(refs, f"{folder}/out/x_virtual_s3.json", layout="parts")
    done = publish(spark, f"{folder}/out", [f"{folder}/dest", f"{folder}/none"], "C/").collect()
    assert {r["dest"] for r in done if not r["ok"]} == {f"{folder}/none"}
    copied = f"{folder}/dest/C/x_virtual_s3.json"
    assert load_parts(copied) == load_parts(f"{folder}/out/x_virtual_s3.json")


def _written(folder):
    with open(f"{folder}/s.json", "w", encoding="utf-8") as out:
        json.dump(SAMPLE, out)
    return f"{folder}/s.json"


def load_parts(path):
    names = sorted(n for n in os.listdir(path) if n[0] not in "._")
    return json.loads("".join(open(f"{path}/{n}", encoding="utf-8").read() for n in names))


def test_split_reading_of_one_file(spark, folder):
    """Several tasks read one file, and no entry is lost or read twice at their borders."""
    refs = spark.range(20_000).select(
        F.format_string("v/%05d", "id").alias("key"), F.lit("ref").alias("kind"),
        F.concat(F.lit("s3://b/"), "id").alias("url"), F.lit("[1,2]").alias("tail_json"),
        F.lit(None).cast("string").alias("inline_text"),
        F.lit(None).cast("string").alias("other_json"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        for indent, layout in ((False, "lines"), (True, "indented")):
            write_refs_json(refs, f"{folder}/{layout}.json", indent=indent)
            back = read_refs_json(spark, f"{folder}/{layout}.json", layout)
            assert back.rdd.getNumPartitions() > 8
            assert rows(back) == rows(refs)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.fixture
def dataset(spark):
    ids = ["g0", "g1", "g2"]
    found = granules(spark, [granule(g, i, f"2022-01-0{i + 1}T00:00:00Z", cycle=i)
                             for i, g in enumerate(ids)])
    m = manifest(
        spark, [(g, "y", 2) for g in ids],
        [variable(g, "sst", ["y"], (2,), (1,)) for g in ids]
        + [variable(g, "y", ["y"], (2,), (2,), "<f8", coord=True, loadable=True) for g in ids],
        [(g, "", "title", '"A \\"x\\""') for g in ids] + [(g, "sst", "units", '"K"') for g in ids],
        [(g, "sst", [i], f"s3://b/{g}", i, 4, None) for g in ids for i in range(2)],
        [(g, "y", i, i + 0.5) for g in ids for i in range(2)])
    return combine(m, found, "granule")


def test_json_round_trip(spark, dataset, folder):
    path = f"{folder}/d.json"
    write_refs_json(dataset, path)
    doc = load(path)
    assert doc["version"] == 1 and doc["refs"]["sst/2.1"] == ["s3://b/g2", 1, 4]
    assert json.loads(doc["refs"][".zattrs"])["title"] == 'A "x"'
    for layout in ("lines", "document"):
        back = open_refs(spark, path, layout)
        assert rows(back.chunk_refs.where("var = 'sst'"), "chunk_idx", "url", "offset") == rows(
            dataset.chunk_refs, "chunk_idx", "url", "offset")
        assert rows(back.dims) == [("granule", 3), ("y", 2)]
        assert ("sst", "units", '"K"') in rows(back.attrs)
        got = {r["var"]: r["is_coord"] for r in back.variables.collect()}
        assert got == {"sst": False, "y": True, "granule": True, "orbit": True, "cycle": True,
                       "ppass": True, "filename": True}
        assert rows(read_array(back, "y")) == [((0,), 0.5), ((1,), 1.5)]
        assert rows(read_array(back, "cycle")) == [((0,), 0), ((1,), 1), ((2,), 2)]
        assert rows(read_array(back, "orbit"))[1] == ((1,), 1641081600000000)


def test_parquet_round_trip(spark, dataset, folder):
    write_refs_parquet(dataset, f"{folder}/d.parquet")
    back = open_refs_parquet(spark, f"{folder}/d.parquet")
    assert back.axis_name == "granule"
    for name, table in dataset.tables().items():
        assert rows(getattr(back, name), *table.columns) == rows(table)
    one = back.chunk_refs.where("var = 'sst'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(var" in one


def test_many_values_are_cut_into_chunks(spark, dataset, folder, monkeypatch):
    from chunkatlas.sinks import refs as module
    monkeypatch.setattr(module, "COORD_CHUNK", 2)
    write_refs_json(dataset, f"{folder}/d.json")
    back = open_refs(spark, f"{folder}/d.json", "lines")
    assert rows(back.chunk_refs.where("var = 'cycle'"), "chunk_idx") == [((0,),), ((1,),)]
    assert rows(read_array(back, "cycle")) == [((0,), 0), ((1,), 1), ((2,), 2)]
