"""Read reference files into rows, and open them as datasets."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import Dataset
from ..session import local_frame, small_side
from .jsonscan import SPLIT_BYTES, other_members, read_member

# Names of metadata entries and attributes in array stores.
ARRAY_META, ATTR_META, GROUP_META = ".zarray", ".zattrs", ".zgroup"
DIM_NAMES, COORD_NAMES = "_ARRAY_DIMENSIONS", "coordinates"
REFS = "refs"
#: What stands before each entry of an indented reference file, up to its key.
ENTRY_BREAK = '\n    "'
#: A chunk key ends in its indices.
CHUNK_KEY = r"^(.*?)/([0-9]+(?:[./][0-9]+)*)$"


def read_refs_json(spark: SparkSession, path: str | list[str],
                   layout: str = "any", split: int = SPLIT_BYTES) -> DataFrame:
    """Rows of the ``refs`` object of reference files.

    ``any`` reads JSON of any size and form: tasks scan ranges of ``split`` bytes. ``lines`` and
    ``indented`` read what ``write_refs_json`` makes without and with indentation in one pass.
    ``document`` takes one file per row, below 128 MiB each, from any store that Spark reads.
    """
    entry = F.col("value")
    if layout == "lines":
        lines = spark.read.text(path).where(entry.startswith('"'))
        entries = _single_entries(lines.withColumn("value", F.regexp_replace(entry, ",$", "")))
    elif layout == "indented":
        # A JSON string holds no raw line break, so this separator is found between entries only.
        pieces = spark.read.option("lineSep", ENTRY_BREAK).text(path)
        # A part of a folder begins with an entry instead of the outer braces.
        pieces = pieces.where(~entry.startswith("{\n") & (entry != "  }\n}")).withColumn(
            "value", F.regexp_replace(entry, '^    "', ""))
        entries = _single_entries(pieces.withColumn("value", F.concat(
            F.lit('"'), F.regexp_replace(entry, r"(,|\n  \}\n\})$", ""))))
    elif layout == "any":
        paths = [path] if isinstance(path, str) else list(path)
        entries = read_member(spark, paths, REFS, split).select(
            "key", F.parse_json("value").alias("value"))
    elif layout != "document":
        raise ValueError(f"layout: {layout!r}")
    else:
        entries = spark.sql(
            "SELECT key, e.value FROM {docs}, LATERAL variant_explode("
            "variant_get(doc, '$.refs', 'variant')) AS e(pos, key, value)", docs=_docs(spark, path))
    return entries.select("key", *_split_value(F.col("value")))


def _single_entries(lines: DataFrame) -> DataFrame:
    """Key and value of rows that each hold one ``"key": value``."""
    return lines.select(F.explode(F.from_json(
        F.concat(F.lit("{"), "value", F.lit("}")), "map<string,variant>")))


def _docs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("doc"))


def read_head_json(spark: SparkSession, path: str, layout: str = "any") -> str | None:
    """Text of a reference file's top-level object without ``refs``; NULL if it has no ``refs``."""
    if layout == "any":
        head = other_members(spark, path, REFS)
        return None if head is None else json.dumps(head)
    if layout == "document":
        return spark.sql("""
            SELECT if(bool_or(e.key = 'refs'), to_json(map_from_entries(
                       collect_list(struct(e.key, e.value)) FILTER (WHERE e.key <> 'refs'))),
                      NULL) AS head
            FROM {docs}, LATERAL variant_explode(doc) AS e(pos, key, value)
        """, docs=_docs(spark, path)).first()["head"]
    indented = layout == "indented"
    text = spark.read.option("lineSep", ENTRY_BREAK if indented else "\n").text(path)
    top = text.where(F.col("value").startswith("{\n" if indented else "{")).first()
    if top is None:
        return None
    # ``refs`` comes last, so the text before the entries ends in its brace.
    head = json.loads(re.sub(r"\{\s*(\}\s*\}\s*)?$", "{}}", top["value"]))
    return None if head.pop("refs", None) is None else json.dumps(head)


def _split_value(value: Column) -> list[Column]:
    """Kind and parts: a list led by a text is a reference, a text is inline, the rest is other."""
    kind_of = F.schema_of_variant(value)
    head = F.try_variant_get(value, "$[0]", "variant")
    is_ref = kind_of.startswith("ARRAY") & (F.schema_of_variant(head) == "STRING")
    kind = F.when(F.coalesce(is_ref, F.lit(False)), "ref").when(kind_of == "STRING", "inline"
                                                                ).otherwise("other")
    items = F.try_variant_get(value, "$", "array<variant>")
    return [
        kind.alias("kind"),
        F.when(kind == "ref", F.variant_get(head, "$", "string")).alias("url"),
        F.when(kind == "ref", F.to_json(F.slice(items, F.lit(2), F.size(items)))
               ).alias("tail_json"),
        F.when(kind == "inline", F.variant_get(value, "$", "string")).alias("inline_text"),
        F.when(kind == "other", F.to_json(value)).alias("other_json"),
    ]


def open_refs(spark: SparkSession, path: str, layout: str = "any") -> Dataset:
    """A reference file as a dataset: metadata rows and chunk rows, no array data read."""
    return refs_to_dataset(read_refs_json(spark, path, layout))


def open_refs_parquet(spark: SparkSession, path: str) -> Dataset:
    """What ``write_refs_parquet`` wrote. Chunks of one variable lie in one folder."""
    names = ("dims", "variables", "attrs", "chunk_refs", "coord_values")
    found = {name: spark.read.parquet(f"{path}/{name}") for name in names}
    axis = spark.read.parquet(f"{path}/axis")
    name = axis.select("axis_name").first()
    return Dataset(**found, axis=axis.drop("axis_name"), axis_name=name and name["axis_name"])


def _meta(refs: DataFrame, name: str) -> DataFrame:
    """Metadata entries of one kind: the variable (or '') and its JSON."""
    text = F.coalesce("inline_text", "other_json")
    return refs.where((F.col("key") == name) | F.col("key").endswith("/" + name)).select(
        F.regexp_replace(F.col("key"), r"/?\.z\w+$", "").alias("scope"),
        F.parse_json(text).alias("meta"))


def refs_to_dataset(refs: DataFrame) -> Dataset:
    spark = refs.sparkSession
    attrs = spark.sql("SELECT scope, e.key, to_json(e.value) AS value_json FROM {meta}, "
                      "LATERAL variant_explode(meta) AS e(pos, key, value)",
                      meta=_meta(refs, ATTR_META))
    dim_names = attrs.where(F.col("key") == DIM_NAMES).select(
        F.col("scope").alias("var"),
        F.from_json("value_json", "array<string>").alias("dims"))
    coords = attrs.where(F.col("key") == COORD_NAMES).select(F.explode(F.split(
        F.variant_get(F.parse_json("value_json"), "$", "string"), " ")).alias("coord")).distinct()
    raw = {name: F.to_json(F.variant_get("meta", f"$.{name}", "variant"))
           for name in ("compressor", "filters", "order", "fill_value")}
    arrays = _meta(refs, ARRAY_META).select(
        F.col("scope").alias("var"),
        F.variant_get("meta", "$.shape", "array<bigint>").alias("shape"),
        F.variant_get("meta", "$.chunks", "array<bigint>").alias("chunk_shape"),
        F.variant_get("meta", "$.dtype", "string").alias("dtype"),
        codec_json(raw["compressor"], raw["filters"], raw["order"]).alias("codec_json"),
        F.coalesce(raw["fill_value"], F.lit("null")).alias("fill_json"))
    no_dims = F.transform("shape", lambda n, i: F.concat(F.lit("dim_"), i.cast("string")))
    # One dataset's variables and coordinate names.
    variables = (arrays.join(small_side(dim_names), "var", "left")
                 .join(small_side(coords), F.col("var") == F.col("coord"), "left")
                 .select("var", F.coalesce("dims", no_dims).alias("dims"), "shape", "chunk_shape",
                         "dtype", "codec_json", "fill_json",
                         (F.col("coord").isNotNull() | F.array_contains(
                             F.coalesce("dims", no_dims), F.col("var"))).alias("is_coord"),
                         F.lit(False).alias("loadable")))
    dims = variables.select(F.explode(F.arrays_zip("dims", "shape")).alias("one")).select(
        F.col("one.dims").alias("dim"), F.col("one.shape").alias("size")).distinct()
    index = F.split(F.regexp_extract("key", CHUNK_KEY, 2), "[./]").cast("array<bigint>")
    tail = F.from_json("tail_json", "array<bigint>")
    chunks = refs.where(F.col("key").rlike(CHUNK_KEY)).select(
        F.regexp_extract("key", CHUNK_KEY, 1).alias("var"), index.alias("chunk_idx"), "url",
        F.get(tail, F.lit(0)).alias("offset"), F.get(tail, F.lit(1)).alias("length"),
        "inline_text")
    scalars = small_side(variables.where(F.size("shape") == 0).select(
        "var", F.lit(True).alias("scalar")))
    chunks = chunks.join(scalars, "var", "left").withColumn("chunk_idx", F.when(
        F.col("scalar"), F.array().cast("array<bigint>")).otherwise(F.col("chunk_idx"))
        ).drop("scalar")
    kept = attrs.where(~F.col("key").isin(DIM_NAMES)
                       & ~((F.col("key") == COORD_NAMES) & (F.col("scope") == "")))
    values = local_frame(spark, [], "var STRING, pos BIGINT, value DOUBLE")
    return Dataset(dims, variables, kept, chunks, values)


def codec_json(compressor: Column, filters: Column, order: Column) -> Column:
    """How chunk bytes are coded, as one JSON text."""
    null = F.lit("null")
    return F.concat(F.lit('{"compressor":'), F.coalesce(compressor, null), F.lit(',"filters":'),
                    F.coalesce(filters, null), F.lit(',"order":'),
                    F.coalesce(order, F.lit('"C"')), F.lit("}"))
