"""Byte access from tasks: ranges, whole objects, copy and delete."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyarrow import fs as pafs

#: Names that Hadoop has for the same object store.
_SCHEMES = re.compile("^s3[an]://")


def locate(url: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URL; a plain path is local."""
    if url.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + url[len("file:"):].lstrip("/")
    if "://" not in url:
        return pafs.LocalFileSystem(), url
    return pafs.FileSystem.from_uri(_SCHEMES.sub("s3://", url))


def read_range(url: str, offset: int | None = None, length: int | None = None) -> bytes:
    """Bytes of a range, or of the whole object without an offset."""
    store, path = locate(url)
    with store.open_input_file(path) as f:
        if offset is None:
            return f.read()
        found = f.read_at(length, offset)
    if len(found) != length:
        raise OSError(f"{url}: {len(found)} of {length} bytes at {offset}")
    return found


def copy_object(source: str, target: str, buffer: int = 8 << 20) -> None:
    """Copy one object as a stream."""
    from_store, from_path = locate(source)
    to_store, to_path = locate(target)
    if isinstance(to_store, pafs.LocalFileSystem):
        to_store.create_dir(to_path.rsplit("/", 1)[0], recursive=True)
    with from_store.open_input_stream(from_path) as src, to_store.open_output_stream(to_path) as dst:
        while block := src.read(buffer):
            dst.write(block)


def delete_object(url: str) -> None:
    store, path = locate(url)
    store.delete_file(path)


def delete_objects(urls: Sequence[str]) -> dict[str, str]:
    """Delete many objects; {url: error} of those that are still there. Absent ones count as deleted.

    A store with a request for many keys can take its own function's place.
    """
    failed = {}
    for url in urls:
        try:
            delete_object(url)
        except FileNotFoundError:
            continue
        except OSError as error:
            failed[url] = str(error) or type(error).__name__
    return failed
