"""Write reference files (K1, K2, K3)."""

from __future__ import annotations

import base64
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import chunk_key
from ..operators.rewrite import rewrite_refs
from ..schemas import Dataset
from ..session import local_frame, materialize, scratch_path, small_side
from ..sources.refs import (ARRAY_META, ATTR_META, COORD_NAMES, DIM_NAMES, GROUP_META,
                            read_head_json, read_refs_json)
from .files import concat_parts, exists, write_text

#: Values of a loaded coordinate that share one inline chunk.
COORD_CHUNK = 65_536
#: How a reference file lies on the file system: as one file, or as a folder of parts.
LAYOUTS = ("file", "parts")
#: What an integer coordinate of a new axis holds where a granule has no value.
NO_INTEGER = -(1 << 63)


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def _object(pairs: Column) -> Column:
    """A JSON object from an array of ``"key":value`` texts."""
    return F.concat(F.lit("{"), F.array_join(F.array_sort(pairs), ","), F.lit("}"))


@F.pandas_udf(StringType())
def _encode(values: pd.Series, spots: pd.Series, size: pd.Series, dtype: pd.Series) -> pd.Series:
    """The values of one chunk as base64 bytes; spots without a value stay zero."""
    out = []
    for vals, at, n, kind in zip(values, spots, size, dtype):
        cells = np.zeros(int(n), dtype=np.dtype(kind))
        cells[np.asarray(at, dtype="int64")] = np.asarray(vals).astype(cells.dtype)
        out.append("base64:" + base64.b64encode(cells.tobytes()).decode("ascii"))
    return pd.Series(out)


def _inline_chunks(cells: DataFrame) -> DataFrame:
    """Inline chunks from cells ``(var, pos, value, shape, dtype)``.

    A cell without a value is left out. Chunks cut only the leading dimension, at a fixed number of values, so a group never holds
    more than one chunk.
    """
    placed = cells.where("value is not null").select("var", "pos", "value", "dtype", _inner(F.col("shape")).alias("inner"),
                          F.size("shape").alias("rank"), F.coalesce(
                              F.get(_value_chunk_shape(F.col("shape")), F.lit(0)),
                              F.lit(1)).alias("_steps")).withColumns({
        "_chunk": F.expr("pos div (inner * _steps)"),
        "_spot": F.expr("pos % (inner * _steps)")})
    rest = F.transform(F.sequence(F.lit(1), F.greatest("rank", F.lit(1))),
                       lambda i: F.when(i == 1, F.col("_chunk")).otherwise(F.lit(0)))
    rows = placed.groupBy("var", "_chunk", "_steps", "inner", "rank", "dtype").agg(
        F.collect_list(F.struct("_spot", "value")).alias("cells"))
    return rows.select(
        chunk_key("var", F.when(F.col("rank") == 0, F.array().cast("array<bigint>"))
                  .otherwise(rest)).alias("key"),
        _encode("cells.value", "cells._spot", F.col("inner") * F.col("_steps"), "dtype")
        .alias("inline_text"))


def _inner(shape: Column) -> Column:
    rest = F.slice(shape, F.lit(2), F.greatest(F.size(shape) - 1, F.lit(0)))
    return F.aggregate(rest, F.lit(1).cast("bigint"), lambda a, n: a * n)


def _value_chunk_shape(shape: Column) -> Column:
    """Chunk shape that ``_inline_chunks`` gives a variable kept as values."""
    steps = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(COORD_CHUNK) / F.greatest(
        _inner(shape), F.lit(1).cast("bigint"))))
    return F.transform(shape, lambda n, i: F.when(
        i == 0, F.greatest(F.least(n, steps), F.lit(1))).otherwise(n).cast("bigint"))


def _axis_variables(ds: Dataset) -> tuple[DataFrame | None, list[DataFrame]]:
    """Variables and inline chunks for the coordinate columns of a new axis."""
    if ds.axis is None:
        return None, []
    spark = ds.axis.sparkSession
    known = {"granule_id", "ordinal", "axis_offset", "axis_size"}
    names = [c for c in ds.axis.columns if c not in known]
    if not names:
        return None, []
    columns = {ds.axis_name if c == "start" else c: F.col(c) for c in names}
    columns.setdefault(ds.axis_name, F.col("axis_offset"))
    types = dict(ds.axis.dtypes)
    texts = [c for c in names if types[c] == "string"]
    widths = ds.axis.agg(*[
        (F.max(F.length(c)) if c in texts else F.count_if(F.col(c).isNull())).alias(c)
        for c in names]).first().asDict()
    total = ds.axis.agg(F.max(F.col("axis_offset") + F.col("axis_size"))).first()[0] or 0
    meta, chunks = [], []
    for name, value in columns.items():
        source = "start" if name == ds.axis_name and "start" in names else name
        kind = types.get(source, "bigint")
        dtype = f"<U{max(widths[source] or 1, 1)}" if kind == "string" else "<i8"
        value = F.unix_micros(value) if kind == "timestamp" else value
        gaps = kind != "string" and bool(widths.get(source))
        value = F.coalesce(value, F.lit("" if kind == "string" else NO_INTEGER))
        chunks.append(_inline_chunks(ds.axis.select(
            F.lit(name).alias("var"), F.col("axis_offset").alias("pos"), value.alias("value"),
            F.array(F.lit(total).cast("bigint")).alias("shape"), F.lit(dtype).alias("dtype"))))
        meta.append((name, [ds.axis_name], [total], [max(min(total, COORD_CHUNK), 1)], dtype,
                     '{"compressor":null,"filters":null,"order":"C"}',
                     str(NO_INTEGER) if gaps else "null", True, True))
    schema = ("var STRING, dims ARRAY<STRING>, shape ARRAY<BIGINT>, chunk_shape ARRAY<BIGINT>, "
              "dtype STRING, codec_json STRING, fill_json STRING, is_coord BOOLEAN, "
              "loadable BOOLEAN")
    return local_frame(spark, meta, schema), chunks


def dataset_to_refs(ds: Dataset) -> DataFrame:
    """All entries of a reference file for a dataset, one row each."""
    spark = ds.variables.sparkSession
    raw = '{"compressor":null,"filters":null,"order":"C"}'
    variables = ds.variables.select(
        "var", "dims", "shape",
        F.when(F.col("loadable"), _value_chunk_shape(F.col("shape")))
        .otherwise(F.col("chunk_shape")).alias("chunk_shape"), "dtype",
        F.when(F.col("loadable"), raw).otherwise(F.coalesce("codec_json", F.lit(raw)))
        .alias("codec_json"), "fill_json", "is_coord", "loadable")
    added, axis_chunks = _axis_variables(ds)
    if added is not None:
        variables = variables.unionByName(added)

    codec = F.parse_json("codec_json")
    part = {name: F.coalesce(F.to_json(F.variant_get(codec, f"$.{name}", "variant")), F.lit(default))
            for name, default in (("compressor", "null"), ("filters", "null"), ("order", '"C"'))}
    zarray = _object(F.array(
        F.concat(F.lit('"shape":'), F.to_json("shape")),
        F.concat(F.lit('"chunks":'), F.to_json("chunk_shape")),
        F.concat(F.lit('"dtype":'), quoted(F.col("dtype"))),
        F.concat(F.lit('"compressor":'), part["compressor"]),
        F.concat(F.lit('"filters":'), part["filters"]),
        F.concat(F.lit('"fill_value":'), F.coalesce("fill_json", F.lit("null"))),
        F.concat(F.lit('"order":'), part["order"]), F.lit('"zarr_format":2')))
    arrays = variables.select(F.concat("var", F.lit("/" + ARRAY_META)).alias("key"),
                              zarray.alias("inline_text"))

    names = variables.where("is_coord").agg(F.array_join(F.array_sort(F.collect_set("var")), " "))
    pairs = (ds.attrs.select("scope", "key", "value_json")
             .unionByName(variables.select(F.col("var").alias("scope"), F.lit(DIM_NAMES).alias("key"),
                                           F.to_json("dims").alias("value_json")))
             .unionByName(names.toDF("n").where("n <> ''").select(
                 F.lit("").alias("scope"), F.lit(COORD_NAMES).alias("key"),
                 quoted(F.col("n")).alias("value_json"))))
    # One group holds the attributes of one variable of one dataset.
    zattrs = pairs.groupBy("scope").agg(F.collect_list(F.concat(
        quoted(F.col("key")), F.lit(":"), "value_json")).alias("pairs")).select(
            F.when(F.col("scope") == "", ATTR_META).otherwise(
                F.concat("scope", F.lit("/" + ATTR_META))).alias("key"),
            _object(F.col("pairs")).alias("inline_text"))
    group = local_frame(spark, [(GROUP_META, '{"zarr_format":2}')],
                                  "key STRING, inline_text STRING")

    shapes = variables.where("loadable").select("var", "dtype", "shape")
    values = _inline_chunks(ds.coord_values.select("var", "pos", "value").join(
        small_side(shapes), "var"))
    inline = group
    for table in (arrays, zattrs, values, *axis_chunks):
        inline = inline.unionByName(table)

    none = F.lit(None).cast("string")
    chunks = ds.chunk_refs
    kind = F.when(F.col("url").isNull() & F.col("inline_text").isNotNull(), "inline"
                  ).otherwise("ref")
    tail = F.when(F.col("offset").isNull(), "[]").otherwise(
        F.concat(F.lit("["), "offset", F.lit(","), "length", F.lit("]")))
    return chunks.select(
        chunk_key(F.col("var"), F.col("chunk_idx")).alias("key"), kind.alias("kind"), "url",
        F.when(kind == "ref", tail).alias("tail_json"),
        F.when(kind == "inline", F.col("inline_text")).alias("inline_text"),
        none.alias("other_json")).unionByName(inline.select(
            "key", F.lit("inline").alias("kind"), none.alias("url"), none.alias("tail_json"),
            "inline_text", none.alias("other_json")))


def _entry(indent: bool) -> Column:
    """One entry of the ``refs`` object as JSON text."""
    tail = F.transform(F.from_json("tail_json", "array<variant>"), lambda v: F.to_json(v))
    items = F.concat(F.array(quoted(F.col("url"))), tail)
    listed = (F.concat(F.lit("[\n      "), F.array_join(items, ",\n      "), F.lit("\n    ]"))
              if indent else F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")))
    value = (F.when(F.col("kind") == "ref", listed)
             .when(F.col("kind") == "inline", quoted(F.col("inline_text")))
             .otherwise(F.col("other_json")))
    lead, colon = ("    ", ": ") if indent else ("", ":")
    return F.concat(F.lit(lead), quoted(F.col("key")), F.lit(colon), value)


def write_refs_json(source: Dataset | DataFrame, path: str, head: str = '{"version":1}',
                    indent: bool = False, layout: str = "file") -> None:
    """Write one reference file, entries sorted by key, over what ``path`` holds.

    The entries are sorted and written as parts by all tasks. ``file`` then joins them on the file
    system, through one process. ``parts`` leaves them in the folder ``path``, with the text before
    and after the entries in files of their own: in order of names the files make up the same text.
    Readers take both. Without ``indent`` each entry is one line (``layout="lines"`` when read).
    Of rows that share a key the last one counts.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout: {layout!r}")
    refs = dataset_to_refs(source) if isinstance(source, Dataset) else source
    spark = refs.sparkSession
    placed = refs.select("key", _entry(indent).alias("text"),
                         F.monotonically_increasing_id().alias("_at"))
    entries = materialize(
        placed.groupBy("key").agg(F.max_by("text", "_at").alias("text")), "entries")
    last = entries.agg(F.max("key")).scalar()
    parts = path if layout == "parts" else scratch_path(spark, "parts")
    (entries.withColumn("_comma", F.when(F.col("key") == last, "").otherwise(","))
     .sort("key").select(F.concat("text", "_comma").alias("value"))
     .write.mode("overwrite").text(parts))
    top, bottom = _frame(spark, head, indent)
    if layout == "file":
        concat_parts(spark, parts, path, top, bottom)
    else:
        write_text(spark, f"{path}/head", top)
        write_text(spark, f"{path}/tail", bottom)


def _frame(spark: SparkSession, head: str, indent: bool) -> tuple[str, str]:
    """Text before and after the entries; ``head`` holds the other top-level keys."""
    pairs = spark.sql("SELECT e.key, to_json(e.value) AS value FROM "
                      "variant_explode(parse_json(:head)) AS e(pos, key, value)",
                      args={"head": head}).select(quoted(F.col("key")).alias("k"), "value").collect()
    gap, colon, line = ("\n  ", ": ", "\n") if indent else ("", ":", "\n")
    before = "".join(f"{gap}{row['k']}{colon}{row['value']}," for row in pairs)
    after = "  }\n}" if indent else "}}\n"
    return "{" + before + f'{gap}"refs"{colon}' + "{" + line, after


def write_refs_parquet(ds: Dataset, path: str, mode: str = "errorifexists") -> None:
    """Write the dataset's tables, chunk rows in one folder per variable and sorted by index.

    Rows are ranged over variable and index, so that a variable with most of the chunks is
    written by many tasks and the others do not leave a file from every task.
    """
    for name, table in ds.tables().items():
        if name == "chunk_refs":
            # Ranges are found by a sample, which would compute the combination once more.
            # The first index decides most comparisons; whole arrays are compared only where it is equal.
            order = ["var", F.get("chunk_idx", F.lit(0)), "chunk_idx"]
            table = materialize(table, "chunks").repartitionByRange(*order).sortWithinPartitions(*order)
            table.write.mode(mode).partitionBy("var").parquet(f"{path}/{name}")
            continue
        if name == "axis":
            table = table.withColumn("axis_name", F.lit(ds.axis_name))
        table.write.mode(mode).parquet(f"{path}/{name}")
    if ds.axis is None:
        local_frame(ds.variables.sparkSession, [], "granule_id STRING, axis_name STRING"
                                                  ).write.mode(mode).parquet(f"{path}/axis")


def convert_refs(spark: SparkSession, src: str, dst: str | None = None, *,
                 buckets: Sequence[str], hosts: Mapping[str, str], default_host: str,
                 overwrite: bool = False, layout: str = "any",
                 out_layout: str = "file") -> str:
    """Rewrite the URLs of a reference file to HTTPS, with two-space indentation.

    Other top-level keys stay, and so does a file without ``refs``. Writing over ``src`` needs
    ``overwrite=True``. ``layout`` is as in ``read_refs_json``; but for ``document`` the file is read in parallel.
    ``out_layout`` is the layout of ``write_refs_json``.
    """
    out = dst or src
    if not overwrite and exists(spark, out):
        raise FileExistsError(f"{out} exists; pass overwrite=True to replace it")
    head = read_head_json(spark, src, layout)
    if head is None:
        whole = spark.read.text(src, wholetext=True)
        parts = scratch_path(spark, "parts")
        whole.write.text(parts)
        concat_parts(spark, parts, out, "", "")
        return out
    refs = rewrite_refs(read_refs_json(spark, src, layout), buckets, hosts, default_host)
    write_refs_json(refs, out, head=head, indent=True, layout=out_layout)
    return out
