"""List object trees in tasks: a breadth-first walk whose frontier is a table.

A row of the frontier is a range of names of one folder. A task lists a bounded page of it and gives back the
objects, the folders to list next, and, where the page was full, the rest of the range cut into several. Each
level is written before the next one starts, so a walk with a ``state`` folder goes on after a stop where it
was, and the driver holds neither objects nor folders.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os
import string
from collections.abc import Callable, Iterator, Sequence
from fnmatch import fnmatchcase
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import local_frame, scratch_path
from ..sinks.files import exists
from .storage import locate

#: Entries of one page, and ranges that the rest of a full folder is cut into.
PAGE = 100_000
CUTS = 8
_DIGITS = string.digits + string.ascii_uppercase + "_" + string.ascii_lowercase

#: (name, is a folder, size, seconds since 1970) of one entry.
Entry = tuple[str, bool, int | None, float | None]
#: Gives the first entries, in the order of names, of a folder's names from one on and before another.
Lister = Callable[[str, str, str | None, int], Sequence[Entry]]

_LEVEL = ("root STRING, folder STRING, start STRING, stop STRING, key STRING, size BIGINT, etag STRING, "
          "modified TIMESTAMP, kind STRING")
_FIELDS = {"root": pa.string(), "folder": pa.string(), "start": pa.string(), "stop": pa.string(), "key": pa.string(),
           "size": pa.int64(), "etag": pa.string(), "modified": pa.timestamp("us", "UTC"), "kind": pa.string()}


def list_page(folder: str, start: str, stop: str | None, most: int) -> Sequence[Entry]:
    """At most ``most`` entries of a folder. Of a local folder only these are held.

    Other stores are asked for the whole folder, as the file system interface has no pages; give ``walk`` a
    lister of its own for stores that list from a key on.
    """
    store, path = locate(folder)
    inside = lambda name: name >= start and (stop is None or name < stop)
    if store.type_name == "local":
        with os.scandir(path) as found:
            names = heapq.nsmallest(most, (e.name for e in found if inside(e.name)))
        out: list[Entry] = []
        for name in names:
            at = os.path.join(path, name)
            # A link to a folder could lead back up.
            if os.path.isdir(at):
                out += [] if os.path.islink(at) else [(name, True, None, None)]
            else:
                status = os.stat(at)
                out.append((name, False, status.st_size, status.st_mtime))
        return out
    from pyarrow import fs as pafs

    infos = store.get_file_info(pafs.FileSelector(path))
    return heapq.nsmallest(most, (
        (i.base_name, i.type == pafs.FileType.Directory, i.size, i.mtime_ns and i.mtime_ns / 1e9)
        for i in infos if inside(i.base_name)))


def cut_rest(names: Sequence[str], stop: str | None, parts: int = CUTS) -> list[tuple[str, str | None]]:
    """Ranges that cover all names after the last one and before ``stop``, cut where the page's names vary."""
    last = names[-1]
    shared = commonprefix([names[0], last])
    cuts = sorted({last[:n] + c for n in range(len(shared) + 1) for c in _DIGITS})
    cuts = [c for c in cuts if last < c and (stop is None or c < stop)]
    step = max(1, -(-len(cuts) // (parts - 1)))
    edges = [last + "\0", *cuts[step - 1::step], stop]
    return list(zip(edges[:-1], edges[1:]))


def md5_of(url: str, buffer: int = 8 << 20) -> str:
    """Checksum of an object, read as a stream."""
    store, path = locate(url)
    digest = hashlib.md5(usedforsecurity=False)
    with store.open_input_stream(path) as source:
        while block := source.read(buffer):
            digest.update(block)
    return digest.hexdigest()


def _join(*parts: str) -> str:
    return "/".join(p for p in parts if p)


def walk(spark: SparkSession, roots: DataFrame | Sequence[str], state: str | None = None, glob: str | None = None,
         hidden: bool = True, markers: bool = False, etag: Callable[[str], str] | None = None,
         lister: Lister = list_page, page: int = PAGE) -> DataFrame:
    """All objects below the ``root`` URLs: root, key, size, etag, modified. Keys are relative to their root.

    ``glob`` is a pattern of object names; without ``hidden``, names that begin with ``.`` or ``_`` are left out,
    folders included. ``markers`` lists each folder too, as a key that ends in ``/``. ``etag`` is computed in the
    tasks from an object's URL. A root that is not there ends the walk; a link to a folder is not followed.
    ``state`` names a folder of this walk alone: finished levels in it are not listed again.
    """
    if not isinstance(roots, DataFrame):
        roots = local_frame(spark, [(r,) for r in roots], "root STRING")
    state = state or scratch_path(spark, "walk")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def entries(root: str, folder: str, start: str, stop: str | None) -> Iterator[tuple]:
        found = lister(_join(root.rstrip("/"), folder), start, stop, page)
        for name, is_folder, size, seconds in found:
            key = _join(folder, name)
            if not hidden and name[0] in "._":
                continue
            if is_folder:
                yield root, key, "", None, None, None, None, None, "next"
                if markers:
                    yield root, None, None, None, f"{key}/", 0, None, None, "object"
            elif glob is None or fnmatchcase(name, glob):
                own = etag(_join(root.rstrip("/"), key)) if etag else None
                when = None if seconds is None else int(seconds * 1_000_000)
                yield root, None, None, None, key, size, own, when, "object"
        if len(found) >= page:
            for lo, hi in cut_rest([e[0] for e in found], stop):
                yield root, folder, lo, hi, None, None, None, None, "next"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for root, folder, start, stop in zip(*(batch.column(c).to_pylist() for c in range(4))):
                found = entries(root, folder, start, stop)
                while rows := list(itertools.islice(found, 10_000)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), _FIELDS.values())], list(_FIELDS))

    frontier = roots.select("root", F.lit("").alias("folder"), F.lit("").alias("start"),
                            F.lit(None).cast("string").alias("stop")).distinct()
    level = 0
    while True:
        path = f"{state}/level={level:06d}"
        if not exists(spark, f"{path}/_SUCCESS"):
            (frontier.repartition(tasks).mapInArrow(run, _LEVEL)
             .write.mode("overwrite").partitionBy("kind").parquet(path))
        frontier = (spark.read.schema(_LEVEL).parquet(path).where("kind = 'next'")
                    .select("root", "folder", "start", "stop"))
        if frontier.isEmpty():
            break
        level += 1
    return (spark.read.schema(f"{_LEVEL}, level STRING").parquet(state).where("kind = 'object'")
            .select("root", "key", "size", "etag", "modified"))

