import json
import random

import numpy as np
import pytest
from conftest import rows

from chunkatlas.sources import jsonscan
from chunkatlas.sources.refs import read_head_json, read_refs_json


def write(path, text):
    with open(path, "w") as out:
        out.write(text)
    return path


AWKWARD = {"version": 1, "before": {"refs": {"no": ["}", "\\\"{"]}}, "refs": {
    "a": "plain", "b\\": "{\"x\": [1, 2}", 'c"}': ["s3://b/x", 0, 5], "d": {"e": {"f": [[], {}]}}, "é \U0001f600": "\\\\\\",
    "": "", "g": None, "h": ["only"], "i": "a,b:c" * 9}, "after": ["refs", {"refs": 1}], "tail": "\\"}


@pytest.mark.parametrize("indent,split", [(None, 1), (2, 7), (None, 1 << 20)])
def test_ranges_of_any_size(spark, folder, indent, split):
    path = write(f"{folder}/x.json", json.dumps(AWKWARD, indent=indent, ensure_ascii=split == 7))
    got = {r["key"]: json.loads(r["value"]) for r in jsonscan.read_member(spark, [path], "refs", split).collect()}
    assert got == AWKWARD["refs"]
    assert jsonscan.other_members(spark, path, "refs", split) == {k: v for k, v in AWKWARD.items() if k != "refs"}


def test_escapes_across_ranges():
    generator = random.Random(2)
    for _ in range(200):
        text = json.dumps(["".join(generator.choice('\\\\"{a') for _ in range(generator.randrange(12))) for _ in range(4)]).encode()
        at, kinds, depth, after = jsonscan.structure(text, jsonscan.State())
        assert (after.inside, after.depth) == (0, 0) and depth[0] == 1
        for cut in range(1, len(text)):
            first = jsonscan.structure(text[:cut], jsonscan.State())
            rest = jsonscan.structure(text[cut:], first[3])
            assert np.concatenate([first[0], rest[0] + cut]).tolist() == at.tolist() and rest[3] == after


def test_repeated_and_missing_members(spark, folder):
    twice = write(f"{folder}/a.json", '{"refs":{"a":"1"},"refs":{"b":"2","b":"3"}}')
    none = write(f"{folder}/b.json", '{"version":1}')
    odd = write(f"{folder}/c.json", ' {"refs" : [1,2,{"a":3}] } ')
    empty = write(f"{folder}/d.json", '{"refs":{ }}')
    void = write(f"{folder}/e.json", "")
    listed = write(f"{folder}/f.json", '[{"refs":{"a":"1"}}]')
    got = read_refs_json(spark, [twice, none, odd, empty, void, listed], split=4)
    assert rows(got, "key", "inline_text") == [("b", "3")]
    assert read_head_json(spark, none) is None and read_head_json(spark, empty) == "{}"
    for text in ('{"refs":{"a":"b}}', '{"refs":{"a":1}'):
        with pytest.raises(ValueError, match="does not end"):
            read_refs_json(spark, write(f"{folder}/bad.json", text), split=3).collect()
    with pytest.raises(FileNotFoundError):
        read_refs_json(spark, f"{folder}/absent.json")


def test_an_entry_longer_than_many_ranges(spark, folder):
    path = write(f"{folder}/x.json", json.dumps({"refs": {"a": "x" * 300_000, "b": "y"}}))
    got = read_refs_json(spark, path, split=10_000)
    assert [(r["key"], len(r["inline_text"])) for r in got.orderBy("key").collect()] == [("a", 300_000), ("b", 1)]
