import os
from hashlib import md5

import pytest
from conftest import rows

from chunkatlas.sources import walk as w
from chunkatlas.sources.listing import list_objects
from chunkatlas.sources.walk import cut_rest, list_page, walk


def put(root, *names):
    for name in names:
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as out:
            out.write(name)


def test_pages_are_ranges_of_names(folder):
    put(folder, *[f"{i}.{j}" for i in range(9) for j in range(9)], "deep/x", "é", "~")
    everything = [e[0] for e in list_page(folder, "", None, 1000)]
    assert everything == sorted(os.listdir(folder)) and len(everything) == 84
    assert [e[0] for e in list_page(folder, "3.4", "4", 3)] == ["3.4", "3.5", "3.6"]
    assert ("deep", True, None, None) in list_page(folder, "d", "f", 9)


@pytest.mark.parametrize("page", [1, 2, 7, 40])
def test_rest_of_a_full_folder_is_cut_without_gaps(folder, page):
    put(folder, *[f"{i}.{j}" for i in range(12) for j in range(12)], "a", "B", "é", "\U0001f600")
    seen, todo = [], [("", None)]
    while todo:
        start, stop = todo.pop()
        found = [e[0] for e in list_page(folder, start, stop, page)]
        seen += found
        if len(found) >= page:
            rest = cut_rest(found, stop)
            assert rest[0][0] == found[-1] + "\0" and rest[-1][1] == stop
            assert all(a[1] == b[0] for a, b in zip(rest, rest[1:])) and len(rest) <= w.CUTS
            todo += rest
    assert sorted(seen) == sorted(os.listdir(folder))


def test_walk(spark, folder):
    put(f"{folder}/one", "a/b/c/1", "a/b/2", "a/3", "4", ".x/5", "a/_y")
    put(f"{folder}/two", *[f"t/{i}" for i in range(50)])
    os.makedirs(f"{folder}/two/empty")
    os.symlink(f"{folder}/two", f"{folder}/two/loop")
    roots = [f"{folder}/one", f"{folder}/two"]
    got = walk(spark, roots, page=7)
    one = [(k, len(k)) for k in ("a/b/c/1", "a/b/2", "a/3", "4", ".x/5", "a/_y")]
    assert rows(got.where(f"root = '{roots[0]}'"), "key", "size") == sorted(one, key=repr)
    assert rows(got.where(f"root = '{roots[1]}'"), "key") == sorted([(f"t/{i}",) for i in range(50)], key=repr)
    seen = walk(spark, roots[:1], hidden=False, glob="[0-9]", markers=True)
    assert rows(seen, "key") == [("4",), ("a/",), ("a/3",), ("a/b/",), ("a/b/2",), ("a/b/c/",), ("a/b/c/1",)]
    with pytest.raises(Exception, match="absent"):
        walk(spark, [f"{folder}/absent"]).count()


def test_walk_goes_on_where_it_was(spark, folder):
    put(f"{folder}/one", "a/b/1", "a/2", "3")
    state = f"{folder}/state"
    assert walk(spark, [f"{folder}/one"], state).count() == 3
    # Listed levels stay as they are; a level that was not finished is listed anew.
    put(f"{folder}/one", "a/b/4", "a/5")
    os.remove(f"{state}/level=000002/_SUCCESS")
    assert rows(walk(spark, [f"{folder}/one"], state), "key") == [("3",), ("a/2",), ("a/b/1",), ("a/b/4",)]


def test_listing_of_a_prefix(spark, folder):
    put(folder, "p/a", "p/b/c", "pq/d", "q/e")
    assert rows(list_objects(spark, folder, "p"), "key") == [("p/a",), ("p/b/c",), ("pq/d",)]
    found = list_objects(spark, folder, "p/", etag="md5", markers=True)
    assert rows(found, "key", "size", "etag") == [
        ("p/a", 3, md5(b"p/a").hexdigest()), ("p/b/", 0, None), ("p/b/c", 5, md5(b"p/b/c").hexdigest())]
