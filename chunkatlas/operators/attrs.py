"""Merge attributes of many granules (A3, A4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_json(value: Column) -> Column:
    """One notation per number, so that ``1``, ``1.0`` and ``1e0`` are equal; other text as it is."""
    plain = F.regexp_replace(F.regexp_replace(value, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    number = value.try_cast("double")
    whole = F.when(F.abs(number) < F.lit(2.0 ** 53), number.try_cast("bigint"))
    return (F.when(value.isNull(), "null")
            .when(value.rlike(r"^-?\d+$"), value)
            .when(value.rlike(r"^-?\d+\.\d+$"), plain)
            .when(value.rlike(r"^-?\d+(\.\d+)?[eE][+-]?\d+$"),
                  F.when(whole == number, whole.cast("string")).otherwise(number.cast("string")))
            .otherwise(value))


def attr_summary(attrs: DataFrame) -> DataFrame:
    """Lowest and highest value per attribute. Summaries of parts can be summarised again."""
    if "low" not in attrs.columns:
        text = canonical_json(F.col("value_json"))
        attrs = attrs.select("scope", "key", text.alias("low"), text.alias("high"))
    # min and max combine in the tasks, so an attribute that every granule has sends one row each.
    return attrs.groupBy("scope", "key").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def merge_attrs(attrs: DataFrame, with_dropped: bool = False) -> DataFrame:
    """Keep the attributes on whose value all granules that have them agree.

    ``with_dropped`` keeps the others too, flagged, without a value.
    """
    same = F.col("low") == F.col("high")
    merged = attr_summary(attrs).select(
        "scope", "key", F.when(same, F.col("low")).alias("value_json"), (~same).alias("dropped"))
    return merged if with_dropped else merged.where(~F.col("dropped")).drop("dropped")


def require_attrs(attrs: DataFrame) -> DataFrame:
    """The merged attributes, or an error if no global one is left."""
    if attrs.where(F.col("scope") == "").isEmpty():
        raise ValueError("no global attributes in the combined dataset")
    return attrs
