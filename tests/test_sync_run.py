import os
import tracemalloc
from pathlib import Path

import pyarrow as pa
import pytest
from conftest import rows

from chunkatlas.operators.sync import SyncRequest, run_sync
from chunkatlas.plans.queries import _object_writer
from chunkatlas.sources.storage import copy_object, delete_objects


def put(root, **files):
    for name, text in files.items():
        path = f"{root}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as out:
            out.write(text)


def tree(root):
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            with open(f"{folder}/{name}") as f:
                found[os.path.relpath(f"{folder}/{name}", root)] = f.read()
    return found


def test_a_stopped_run_goes_on(spark, folder):
    src, dst, state = (f"{folder}/{n}" for n in ("src", "dst", "state"))
    put(src, **{f"in/{i // 4}/{i}": f"text {i}" for i in range(12)})
    os.makedirs(f"{src}/in/marker")
    put(dst, **{"out/0/1": "text 1", "out/gone": "x", "keep": "y"})
    ask = SyncRequest(src, dst, "in/", "out/", "sync")

    def stopping(source, target):
        if target.endswith("/7"):
            raise SystemExit("Stop")
        copy_object(source, target)

    with pytest.raises(Exception, match="Stop"):
        run_sync(spark, ask, state, slices=3, copy=stopping)
    with pytest.raises(ValueError, match="asked"):
        run_sync(spark, SyncRequest(src, dst, "in/", "out/", "copy"), state)

    calls = f"{folder}/calls"
    os.makedirs(calls)

    def counted(source, target):
        open(f"{calls}/{os.path.basename(target)}", "x").close()
        copy_object(source, target)

    first = run_sync(spark, ask, state, copy=counted)
    assert first.number == 1 and rows(first.summary, "status", "copied", "skipped", "deleted", "failed") == [(200, 11, 1, 1, 0)]
    # Slices that were done before the stop are not copied again.
    assert "7" in os.listdir(calls) and len(os.listdir(calls)) < 11
    assert tree(dst) == {"keep": "y", **{f"out/{i // 4}/{i}": f"text {i}" for i in range(12)}}
    second = run_sync(spark, ask, state)
    assert rows(second.summary, "copied", "skipped", "deleted") == [(0, 12, 0)]
    put(src, **{"in/0/2": "changed"})
    os.remove(f"{src}/in/0/3")
    third = run_sync(spark, ask, state)
    assert third.number == 3 and rows(third.outcomes, "key", "action", "ok") == [("out/0/2", "copy", True), ("out/0/3", "delete", True)]


def test_stamps_and_failures(spark, folder):
    src, dst, state = (f"{folder}/{n}" for n in ("src", "dst", "state"))
    put(src, a="one", b="two")

    def failing(source, target):
        if source.endswith("/b"):
            raise OSError("no")
        copy_object(source, target)

    ask = SyncRequest(src, dst)
    first = run_sync(spark, ask, state, dest_etag=None, copy=failing)
    assert rows(first.summary, "status", "copied", "failed") == [(500, 1, 1)]
    assert rows(first.outcomes.where("NOT ok"), "key", "error") == [("b", "no")]
    # The destination shows no etags: what was stamped is skipped, what failed is tried again.
    second = run_sync(spark, ask, state, dest_etag=None)
    assert rows(second.plan, "key", "action") == [("a", "skip"), ("b", "copy")] and tree(dst) == {"a": "one", "b": "two"}
    assert rows(run_sync(spark, ask, state, dest_etag=None).plan, "action") == [("skip",), ("skip",)]
    with pytest.raises(ValueError, match="mode"):
        run_sync(spark, SyncRequest(src, dst, mode="x"), state)


def test_bulk_deletes(folder):
    put(folder, a="1", b="2")
    os.makedirs(f"{folder}/d")
    failed = delete_objects([f"{folder}/{n}" for n in ("a", "b", "absent", "d")])
    assert list(failed) == [f"{folder}/d"] and tree(folder) == {}


def test_objects_are_written_without_python_texts(folder):
    """A batch of large contents takes no Python memory in proportion."""
    contents = [c * (4 << 20) for c in "abcd"] + ["é\U0001f600", ""]
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 3, 105, 7, 8]), pa.array(contents)], ["k", "content"])
    tracemalloc.start()
    done = list(_object_writer(folder)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 << 20
    assert [d.column(0).to_pylist() for d in done] == [[0, 1, 3, 105, 7, 8]]
    for k, content in zip([0, 1, 3, 105, 7, 8], contents):
        assert Path(f"{folder}/src/in/{k // 100}/{k}.txt").read_text("utf-8") == content
    assert sorted(p.name for p in Path(f"{folder}/dst/out").rglob("*.txt")) == [
        "0.txt", "105.txt", "3.txt", "gone-0.txt", "gone-105.txt"]
