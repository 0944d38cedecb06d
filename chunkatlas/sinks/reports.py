"""Publish the inventory and reference files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import report_key
from ..operators.sync import SyncRequest, apply_plan, sync_plan
from ..session import local_frame, materialize
from ..sources.listing import list_objects
from .files import exists, folders

#: Files that are published.
PUBLISHED = "*virtual*.json"


def write_inventory(table: DataFrame, root: str, prefix: str = "reports", key: str | None = None,
                    now: dt.datetime | None = None, fmt: str = "csv") -> str:
    """Write the matrix below ``root`` under a UTC-stamped name, or under ``key``; return the key."""
    spark = table.sparkSession
    moment = (now or dt.datetime.now(dt.timezone.utc)).timestamp()
    stamp = F.timestamp_seconds(F.lit(int(moment)))
    name = spark.range(1).select(report_key(
        F.lit(prefix), stamp, F.lit(key).cast("string"), ext=fmt)).first()[0]
    out = table.write.mode("overwrite")
    target = f"{root.rstrip('/')}/{name}"
    out.option("header", "true").csv(target) if fmt == "csv" else out.parquet(target)
    return name


def publish(spark: SparkSession, src: str, dests: Sequence[str], prefix: str = "",
            glob: str = PUBLISHED) -> DataFrame:
    """Copy new and changed reference files to each destination.

    A folder directly below ``src`` whose name matches is a file in parts, and all its parts go.
    A destination that does not exist is reported and does not end the run. One row per file, or
    per destination that failed: ``(dest, key, action, ok, error)``.
    """
    columns = "dest STRING, key STRING, action STRING, ok BOOLEAN, error STRING"
    result = local_frame(spark, [], columns)
    files = list_objects(spark, src, glob=glob, etag="md5")
    for folder in folders(spark, src, glob):
        files = files.unionByName(list_objects(spark, src, f"{folder}/", etag="md5"))
    files = materialize(files, "published")
    for dest in dests:
        request = SyncRequest(src, dest, "", prefix)
        try:
            if not exists(spark, dest):
                raise FileNotFoundError(f"destination not found: {dest}")
            there = list_objects(spark, dest, prefix, etag="md5") if exists(
                spark, f"{dest}/{prefix.rpartition('/')[0]}") else files.limit(0)
            plan = sync_plan(files, there, request)
            done = apply_plan(plan, request)
        except Exception as error:  # noqa: BLE001 - reported as a row
            result = result.unionByName(local_frame(
                spark, [(dest, None, "copy", False, str(error))], columns))
            continue
        result = result.unionByName(done.select(F.lit(dest).alias("dest"), "key", "action", "ok",
                                                "error"))
    return result


