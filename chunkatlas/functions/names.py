"""Granule fields, coordinate lists, file names and object keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dates import is_valid_date, utc_timestamp

_RANGE = "umm.TemporalExtent.RangeDateTime"
_TRACK = "umm.SpatialExtent.HorizontalSpatialDomain.Track"


def granule_fields(granules: DataFrame) -> DataFrame:
    """Add begin (text and instant), end, cycle and first pass from the nested record."""
    begin, end = F.col(f"{_RANGE}.BeginningDateTime"), F.col(f"{_RANGE}.EndingDateTime")
    return granules.withColumns({
        "begin_raw": begin,
        "begin": utc_timestamp(begin),
        "end": utc_timestamp(end),
        "cycle": F.col(f"{_TRACK}.Cycle"),
        "ppass": F.get(F.col(f"{_TRACK}.Passes"), F.lit(0))["Pass"],
    })


def coord_vars(csv: Column, level2: Column, collection: Column,
               special: Sequence[str] = (), special_vars: Sequence[str] = ()) -> Column:
    """Names of coordinates whose values are loaded: the list, or none / fixed ones for level 2."""
    none = F.array().cast("array<string>")
    fixed = F.array(*map(F.lit, special_vars)).cast("array<string>")
    listed = F.filter(F.transform(F.split(csv, ","), lambda x: F.regexp_replace(
        x, r"^\s+|\s+$", "")), lambda x: x != "")
    chosen = F.when(collection.isin(*special), fixed).otherwise(none) if special else none
    return F.when(level2, chosen).otherwise(F.coalesce(listed, none))


def is_level2(collection: Column) -> Column:
    return F.contains(collection, F.lit("L2"))


def output_name(collection: Column, start: Column, end: Column, kind: str = "s3") -> Column:
    has_start, has_end = is_valid_date(start), is_valid_date(end)
    dates = F.when(has_start | has_end, F.concat(
        F.when(has_start, start).otherwise("beginning"), F.lit("_to_"),
        F.when(has_end, end).otherwise("present"), F.lit("_"))).otherwise("")
    return F.concat(collection, F.lit("_"), dates, F.lit(f"virtual_{kind}.json"))


def https_name(name: Column) -> Column:
    """Swap the first ``_virtual_s3.json``; other names stay as they are."""
    old, new = "_virtual_s3.json", "_virtual_https.json"
    at = F.instr(name, old)
    return F.when(at > 0, F.concat(
        F.substring(name, F.lit(1), at - 1), F.lit(new),
        F.substr(name, at + len(old)))).otherwise(name)


def not_dir(key: Column) -> Column:
    return ~key.endswith("/")


def folder_prefix(prefix: str, folder: str | None) -> str:
    return prefix if folder is None else f"{prefix.rstrip('/')}/{folder}/"


def reroot(key: Column, src: str, dst: str, folder: str | None = None) -> Column:
    """Replace the source prefix of a key by the destination prefix."""
    src, dst = folder_prefix(src, folder), folder_prefix(dst, folder)
    return F.concat(F.lit(dst), F.substr(key, F.lit(len(src) + 1)))


def top_folder(key: Column, prefix: str) -> Column:
    """First folder below ``prefix``; NULL for other keys and for files directly below it."""
    rest = F.substr(key, F.lit(len(prefix) + 1))
    return F.when(key.startswith(prefix) & F.contains(rest, F.lit("/")),
                  F.nullif(F.split_part(rest, F.lit("/"), F.lit(1)), F.lit("")))


def chunk_key(var: Column, chunk_idx: Column) -> Column:
    """``var/i.j.k``, or ``var/0`` without dimensions."""
    index = F.when(F.size(chunk_idx) == 0, "0").otherwise(
        F.array_join(chunk_idx.cast("array<string>"), "."))
    return F.concat(var, F.lit("/"), index)
