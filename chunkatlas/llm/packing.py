"""A user's rows beside an operator's own columns, so that no two names can clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(docs: DataFrame, text: str, **named: Column) -> DataFrame:
    """``text``, the named columns, and all other columns of ``docs`` in the struct ``_doc``."""
    others = [F.col(_quoted(c)) for c in docs.columns if c != text] or [F.lit(0).alias("none")]
    return docs.select(F.struct(*others).alias("_doc"), F.col(_quoted(text)).alias("text"),
                       *[column.alias(name) for name, column in named.items()])


def unpacked(rows: DataFrame, docs: DataFrame, text: str, **replaced: Column) -> DataFrame:
    """The columns of ``docs`` again, in their order; some may be replaced."""
    def own(name: str) -> Column:
        if name in replaced:
            return replaced[name].cast(docs.schema[name].dataType).alias(name)
        return F.col("text").alias(name) if name == text else F.col(f"_doc.{_quoted(name)}").alias(name)

    return rows.select(*map(own, docs.columns))
