"""Rewrite object-store URLs to HTTPS."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bucket_of, https_url, rewrite_text, s3_to_https
from ..session import small_side


def rewrite_refs(refs: DataFrame, buckets: Sequence[str], hosts: Mapping[str, str],
                 default_host: str) -> DataFrame:
    """Rewrite by kind: a list's URL by bucket, a string as text, anything else not at all."""
    return refs.withColumns({
        "url": F.when(F.col("kind") == "ref", s3_to_https(F.col("url"), hosts, default_host)),
        "inline_text": F.when(F.col("kind") == "inline", rewrite_text(
            F.col("inline_text"), buckets, hosts, default_host)),
    })


def urls_to_https(df: DataFrame, hosts: DataFrame, default_host: str, url: str = "url",
                  out: str = "https_url") -> DataFrame:
    """Rewrite a URL column with the hosts kept in a table ``(bucket, host)``."""
    table = small_side(hosts.select(F.col("bucket").alias("_bucket"), F.col("host").alias("_host")))
    found = df.withColumn("_bucket", bucket_of(F.col(url))).join(table, "_bucket", "left")
    return found.withColumn(out, https_url(F.col(url), F.coalesce("_host", F.lit(default_host)))
                            ).drop("_bucket", "_host")
