"""List objects under a prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .walk import md5_of, walk


def list_objects(spark: SparkSession, root: str, prefix: str = "", glob: str | None = None,
                 etag: str | None = None, stamps: DataFrame | None = None, hidden: bool = False,
                 markers: bool = False, state: str | None = None) -> DataFrame:
    """Objects below ``root/prefix`` as rows of the objects table; ``root`` plays the bucket.

    Tasks list the folders, level by level, when this is called. Contents are not read, unless ``etag="md5"``
    asks for a checksum that the store does not keep. ``stamps`` (key, source_etag) supplies what a local store
    cannot hold beside an object. Only keys below the prefix are listed. ``hidden`` names (``.`` or ``_`` first)
    and folder ``markers`` (keys that end in ``/``) are listed on request; ``state`` is as in ``walk``.
    """
    base = root.rstrip("/")
    # A prefix need not end at a folder, so the folder above it is listed.
    folder = prefix.rpartition("/")[0]
    found = walk(spark, [f"{base}/{folder}" if folder else base], state, glob, hidden, markers,
                 md5_of if etag == "md5" else None)
    key = F.concat(F.lit(f"{folder}/"), "key") if folder else F.col("key")
    rows = found.select(F.lit(base).alias("bucket"), key.alias("key"), "size", "etag", "modified").where(
        F.col("key").startswith(prefix))
    if stamps is None:
        rows = rows.withColumn("source_etag", F.lit(None).cast("string"))
    else:
        rows = rows.join(stamps.select("key", "source_etag"), "key", "left")
    return rows.select("bucket", "key", "size", "etag", "source_etag", "modified")
