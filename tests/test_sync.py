import datetime as dt
import os

import pytest
from conftest import rows

from chunkatlas import schemas as S
from chunkatlas.operators.inventory import (collect_folders, folders_by_bucket, inventory,
                                            top_folders)
from chunkatlas.operators.sync import (SyncRequest, apply_plan, stamped_objects, sync_plan,
                                       sync_status)
from chunkatlas.sinks.reports import publish, write_inventory
from chunkatlas.sources.listing import list_objects


def objects(spark, *entries):
    return spark.createDataFrame([("b", key, size, etag, stamp, None)
                                  for key, size, etag, stamp in entries], S.OBJECTS)


def put(root, **files):
    for name, text in files.items():
        path = f"{root}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as out:
            out.write(text)


def tree(root):
    return {os.path.relpath(os.path.join(base, name), root): open(os.path.join(base, name)).read()
            for base, _, names in os.walk(root) for name in names if not name.endswith(".crc")}


def test_sameness(spark):
    cases = [((5, "e1"), None, False), ((5, "e1"), (6, "e1", None), False),
             ((5, "e1"), (5, "e1", None), True), ((5, "e1"), (5, "e2", None), False),
             ((5, "e1"), (5, "e9", "e1"), True), ((5, "e1"), (5, "e1", "e2"), False),
             ((5, "e1"), (5, "e1", ""), True), ((5, None), (5, None, None), True),
             ((5, None), (5, "e1", None), False)]
    src = objects(spark, *[(f"s/{i}", *one, None) for i, (one, _, _) in enumerate(cases)])
    dst = objects(spark, *[(f"d/{i}", *two) for i, (_, two, _) in enumerate(cases) if two])
    plan = sync_plan(src, dst, SyncRequest("b", "b", "s/", "d/"))
    assert rows(plan, "key", "action") == [
        (f"d/{i}", "skip" if same else "copy") for i, (_, _, same) in enumerate(cases)]
    forced = sync_plan(src, dst, SyncRequest("b", "b", "s/", "d/", ignore_is_same=True))
    assert {r["action"] for r in forced.collect()} == {"copy"}


@pytest.fixture
def listings(spark):
    src = objects(spark, ("s/A/1", 1, "x", None), ("s/A/", 0, "x", None), ("s/B/2", 1, "y", None),
                  ("other/A/9", 1, "z", None))
    dst = objects(spark, ("d/A/1", 1, "x", None), ("d/A/old", 1, "q", None),
                  ("d/C/old", 1, "q", None), ("d/C/", 0, "q", None), ("e/keep", 1, "q", None))
    return src, dst


def request(mode, folder=None, **more):
    return SyncRequest("b", "b", "s/", "d/", mode, folder, **more)


def test_modes(listings):
    plan = lambda *a: rows(sync_plan(*listings, request(*a)), "key", "action")
    copies = [("d/A/1", "skip"), ("d/B/2", "copy")]
    assert plan("copy") == copies
    assert plan("sync") == sorted([*copies, ("d/A/old", "delete"), ("d/C/old", "delete")], key=repr)
    assert plan("upload_folder", "A") == [("d/A/1", "skip")]
    assert plan("delete_folder", "C") == [("d/C/old", "delete")]
    # Sync always compares.
    assert rows(sync_plan(*listings, request("sync", ignore_is_same=True)), "key", "action") == plan(
        "sync")


def test_status(spark, listings):
    ok = sync_status(spark, *listings, request("sync")).first()
    assert (ok["status"], ok["copied"], ok["skipped"], ok["deleted"]) == (200, 1, 1, 2)
    up = sync_status(spark, *listings, request("upload_folder", "A")).first()
    assert (up["source_prefix"], up["dest_prefix"], up["folder"]) == ("s/A/", "d/A/", "A")
    for bad, text in ((request("move"), "Unknown mode: move"),
                      (request("upload_folder"), "Missing 'folder' for upload_folder mode"),
                      (request("delete_folder", ""), "Missing 'folder' for delete_folder mode")):
        row = sync_status(spark, *listings, bad).first()
        assert (row["status"], row["message"], row["copied"]) == (400, text, 0)
        with pytest.raises(ValueError):
            sync_plan(*listings, bad)


def test_stamps(listings):
    plan = sync_plan(*listings, request("copy"))
    assert rows(stamped_objects(plan, "b"), "key", "size", "etag", "source_etag") == [
        ("d/B/2", 1, "y", "y")]


def test_apply_then_apply_again(spark, folder):
    src, dst = f"{folder}/src", f"{folder}/dst"
    put(src, **{"p/A/1": "one", "p/B/2": "two", "p/B/deep/3": "three"})
    put(dst, **{"p/A/1": "one", "p/B/2": "TWO", "p/old/4": "four", "q/keep": "kept"})
    ask = SyncRequest(src, dst, "p/", "p/", "sync")
    plan = lambda: sync_plan(list_objects(spark, src, "p/", etag="md5"),
                             list_objects(spark, dst, "p/", etag="md5"), ask)
    done = apply_plan(plan(), ask)
    assert rows(done, "key", "action", "ok") == [
        ("p/B/2", "copy", True), ("p/B/deep/3", "copy", True), ("p/old/4", "delete", True)]
    assert tree(dst) == {"p/A/1": "one", "p/B/2": "two", "p/B/deep/3": "three", "q/keep": "kept"}
    assert {r["action"] for r in plan().collect()} == {"skip"}


def test_failures_are_rows(spark, folder):
    src, dst = f"{folder}/src", f"{folder}/dst"
    put(src, a="one")
    put(dst, b="x")
    plan = spark.createDataFrame(
        [("a", "a", "copy"), ("c", "gone", "copy"), ("b", None, "delete"), ("z", None, "delete")],
        "key STRING, source_key STRING, action STRING")
    done = apply_plan(plan, SyncRequest(src, dst))
    assert rows(done, "key", "ok") == [("a", True), ("b", True), ("c", False), ("z", True)]
    assert tree(dst) == {"a": "one"}


def test_stamp_beside_a_local_store(spark, folder):
    put(folder, a="one")
    stamps = spark.createDataFrame([("a", "e1")], "key STRING, source_etag STRING")
    row = list_objects(spark, folder, stamps=stamps).first()
    assert (row["key"], row["size"], row["source_etag"], row["etag"]) == ("a", 3, "e1", None)


def test_listing_reads_no_content(spark, folder):
    put(folder, **{"p/a.json": "one", "p/b.txt": "two", "pa/c.json": "three"})
    assert rows(list_objects(spark, folder, "p"), "key") == [
        ("p/a.json",), ("p/b.txt",), ("pa/c.json",)]
    assert rows(list_objects(spark, folder, "p/", glob="*.json"), "key") == [("p/a.json",)]
    plan = list_objects(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_publish(spark, folder):
    src, one, two = (f"{folder}/{n}" for n in ("src", "one", "two"))
    put(src, **{"C_virtual_s3.json": "{}", "C_virtual_https.json": "[]", "note.txt": "x"})
    os.makedirs(two)
    done = publish(spark, src, [one, two], "C/")
    assert rows(done.where("dest like '%/one'"), "key", "ok") == [(None, False)]
    assert tree(two) == {"C/C_virtual_s3.json": "{}", "C/C_virtual_https.json": "[]"}
    assert publish(spark, src, [two], "C/").isEmpty()


def test_inventory(spark, folder):
    table = spark.createDataFrame(
        [("b-two", "p/B/q"), ("b-one", "p/A/x"), ("b-one", "p/A/y"), ("b-one", "p/B/z"),
         ("b-two", "p/top.json")], "bucket STRING, key STRING")
    folders = folders_by_bucket(table, "p/")
    matrix = inventory(folders)
    assert matrix.columns == ["collection", "b-one", "b-two"]
    assert rows(matrix) == [("A", "Yes", "No"), ("B", "Yes", "Yes")]
    full = inventory(folders, ["b-two", "b-three", "b-one"], keep_empty=True)
    assert full.columns == ["collection", "b-one", "b-three", "b-two"]
    assert rows(full)[0] == ("A", "Yes", "No", "No")
    assert [r[0] for r in top_folders(table, "p/").collect()] == ["A", "B"]
    key = write_inventory(matrix, folder, now=dt.datetime(2024, 5, 6, 7, 8, 9, tzinfo=dt.timezone.utc))
    assert key == "reports/virtual_collections_20240506T070809Z.csv"
    assert rows(spark.read.option("header", True).csv(f"{folder}/{key}")) == rows(matrix)
    assert write_inventory(matrix, folder, key="own.csv") == "own.csv"


def test_a_failing_bucket_does_not_stop_the_others(spark, folder):
    put(folder, **{"one/p/A/x": "1"})
    found, errors = collect_folders(spark, ["one", "absent"], "p/",
                                    lambda b: list_objects(spark, f"{folder}/{b}"))
    assert rows(found) == [("one", "A")]
    assert rows(errors, "bucket") == [("absent",)]
