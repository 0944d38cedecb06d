"""Which collections are in which bucket."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import top_folder
from ..session import local_frame, materialize

# Marks of the matrix.
YES, NO = "Yes", "No"


def top_folders(objects: DataFrame, prefix: str) -> DataFrame:
    """Distinct folders directly below ``prefix``, sorted."""
    return (objects.select(top_folder(F.col("key"), prefix).alias("collection"))
            .where(F.col("collection").isNotNull()).distinct().orderBy("collection"))


def folders_by_bucket(objects: DataFrame, prefix: str) -> DataFrame:
    """Distinct pairs of bucket and folder."""
    return (objects.select("bucket", top_folder(F.col("key"), prefix).alias("collection"))
            .where(F.col("collection").isNotNull()).distinct())


def inventory(folders: DataFrame, buckets: Sequence[str] | None = None,
              keep_empty: bool = False) -> DataFrame:
    """One row per collection and one column per bucket, both sorted.

    Buckets without folders are left out unless ``keep_empty`` names them through ``buckets``.
    """
    if keep_empty:
        if buckets is None:
            raise ValueError("keep_empty needs the list of buckets")
        columns = sorted(buckets)
    else:
        # One value per bucket that was listed.
        columns = sorted(row["bucket"] for row in folders.select("bucket").distinct().collect())
        if buckets is not None:
            columns = [b for b in columns if b in set(buckets)]
    matrix = folders.groupBy("collection").pivot("bucket", columns).agg(F.first(F.lit(YES)))
    return matrix.na.fill(NO, columns).orderBy("collection")


def collect_folders(spark: SparkSession, buckets: Sequence[str], prefix: str,
                    lister: Callable[[str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Folders of every bucket, and one error row per bucket that could not be listed.

    A failure ends only that bucket's listing.
    """
    found = local_frame(spark, [], "bucket STRING, collection STRING")
    errors = []
    for bucket in buckets:
        try:
            objects = lister(bucket).withColumn("bucket", F.lit(bucket))
            # Written now, since only running the listing shows a failure.
            folders = materialize(folders_by_bucket(objects, prefix), "folders")
        except Exception as error:  # noqa: BLE001 - reported as a row
            errors.append((bucket, str(error)))
            continue
        found = found.unionByName(folders)
    return found, local_frame(spark, errors, "bucket STRING, error STRING")
