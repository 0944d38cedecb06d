"""Extract per-file manifests on the executors."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..schemas import Manifest
from ..session import local_frame, materialize, small_side
from .refs import ARRAY_META, ATTR_META, CHUNK_KEY, DIM_NAMES, GROUP_META, codec_json
from .walk import walk

#: A reader takes a path and yields facts: ``("dims", {...})``, ``("chunk_refs", {...})`` and so on.
Reader = Callable[[str], Iterable[tuple[str, dict]]]

# Tries per file; the wait after failed try n is n squared seconds.
ATTEMPTS = 4

_TABLES = {"dims": schemas.DIMS, "variables": schemas.VARIABLES, "attrs": schemas.ATTRS,
           "chunk_refs": schemas.CHUNK_REFS, "coord_values": schemas.COORD_VALUES}
_COLUMNS = ("granule_id STRING, path STRING, kind STRING, fact STRING")
_BATCH = 10_000


def backoff(attempt: int) -> float:
    return float(attempt ** 2)


def read_with_retry(reader: Reader, path: str, attempts: int,
                    wait: Callable[[int], float]) -> list[tuple[str, dict]]:
    """All facts of one file. A try that fails midway leaves nothing behind."""
    for attempt in range(1, attempts + 1):
        try:
            return list(reader(path))
        except Exception as error:  # noqa: BLE001 - any failure of a user's reader is retried
            time.sleep(wait(attempt))
            last = error
    raise RuntimeError(f"could not process file {path}: {last}") from last


def run_reader(paths: DataFrame, reader: Reader, partitions: int | None = None,
               attempts: int = ATTEMPTS, wait: Callable[[int], float] = backoff,
               on_error: str = "fail") -> DataFrame:
    """Facts of all files as rows ``(granule_id, path, kind, fact)``, read once and written."""
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error: {on_error!r}")
    spark = paths.sparkSession
    tasks = partitions or max(spark.sparkContext.defaultParallelism,
                              int(spark.conf.get("spark.sql.shuffle.partitions")))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for batch in batches:
            for granule, path in zip(batch["granule_id"], batch["path"]):
                try:
                    facts = read_with_retry(reader, path, attempts, wait)
                except RuntimeError as error:
                    if on_error == "fail":
                        raise
                    facts = [("errors", {"error": str(error)})]
                for kind, fact in facts:
                    rows.append((granule, path, kind, json.dumps({"granule_id": granule, **fact})))
                    if len(rows) >= _BATCH:
                        yield pd.DataFrame(rows, columns=["granule_id", "path", "kind", "fact"])
                        rows = []
        yield pd.DataFrame(rows, columns=["granule_id", "path", "kind", "fact"])

    # Round-robin, since the time per file does not depend on the name.
    facts = paths.select("granule_id", "path").repartition(tasks).mapInPandas(read, _COLUMNS)
    # Each table then reads only its own folder.
    return materialize(facts, "facts", ("kind",))


def virtualize(spark: SparkSession, paths: DataFrame | Sequence[str], reader: Reader | str,
               partitions: int | None = None, attempts: int = ATTEMPTS,
               wait: Callable[[int], float] = backoff, on_error: str = "fail") -> Manifest:
    """Run ``reader`` once per file, in parallel, and split the facts into manifest tables.

    ``paths`` has ``granule_id`` and ``path``; a list of paths names each granule by its path.
    ``on_error="fail"`` ends the job at a file that all attempts failed on; ``"quarantine"`` lists
    it in ``Manifest.errors`` instead.
    """
    if isinstance(reader, str):
        if reader == "zarr2":
            return zarr2_manifest_of(spark, paths, partitions, attempts, wait, on_error)
        reader = {"parquet": read_parquet_footer}[reader]
    if not isinstance(paths, DataFrame):
        paths = local_frame(spark, [(p, p) for p in paths], "granule_id STRING, path STRING")
    facts = run_reader(paths, reader, partitions, attempts, wait, on_error)

    def table(kind: str, schema: str) -> DataFrame:
        return facts.where(F.col("kind") == kind).select(
            F.from_json("fact", schema).alias("row")).select("row.*")

    errors = facts.where(F.col("kind") == "errors").select(
        "granule_id", "path", F.get_json_object("fact", "$.error").alias("error"))
    return Manifest(**{name: table(name, schema) for name, schema in _TABLES.items()},
                    errors=errors)


def read_parquet_footer(path: str) -> Iterator[tuple[str, dict]]:
    """A columnar file as arrays: one per column, one chunk per row group."""
    import pyarrow.parquet as pq

    from .storage import locate
    store, at = locate(path)
    meta = pq.ParquetFile(at, filesystem=store).metadata
    groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
    yield "dims", {"dim": "row", "size": meta.num_rows}
    for key, value in {"num_rows": meta.num_rows, "created_by": meta.created_by}.items():
        yield "attrs", {"scope": "", "key": key, "value_json": json.dumps(value)}
    for c in range(meta.num_columns):
        column = meta.schema.column(c)
        chunks = [group.column(c) for group in groups]
        codec = chunks[0].compression if chunks else "UNCOMPRESSED"
        yield "variables", {
            "var": column.path, "dims": ["row"], "shape": [meta.num_rows],
            "chunk_shape": [max((g.num_rows for g in groups), default=1)],
            "dtype": column.physical_type, "codec_json": json.dumps({"compressor": codec}),
            "fill_json": "null", "is_coord": False, "loadable": False}
        for i, chunk in enumerate(chunks):
            start = chunk.data_page_offset
            if chunk.dictionary_page_offset is not None:
                start = min(start, chunk.dictionary_page_offset)
            yield "chunk_refs", {"var": column.path, "chunk_idx": [i], "url": path,
                                 "offset": start, "length": chunk.total_compressed_size}


def read_zarr2_metadata(path: str) -> Iterator[tuple[str, dict]]:
    """Metadata files of one Zarr v2 store. Groups are listed; folders of chunks never are."""
    from pyarrow import fs as pafs

    from .storage import locate
    store, root = locate(path)
    folders = [root.rstrip("/")]
    while folders:
        folder = folders.pop()
        names = [f"{folder}/{name}" for name in (ARRAY_META, ATTR_META, GROUP_META)]
        found = [info for info in store.get_file_info(names) if info.type == pafs.FileType.File]
        for info in found:
            with store.open_input_stream(info.path) as f:
                yield "metadata", {"var": folder[len(root.rstrip("/")) + 1:],
                                   "name": info.base_name, "text": f.read().decode("utf-8")}
        if not any(info.base_name == ARRAY_META for info in found):
            inside = store.get_file_info(pafs.FileSelector(folder))
            folders += [info.path for info in inside if info.type == pafs.FileType.Directory]


def zarr2_manifest_of(spark: SparkSession, stores: DataFrame | Sequence[str],
                      partitions: int | None = None, attempts: int = ATTEMPTS,
                      wait: Callable[[int], float] = backoff,
                      on_error: str = "fail") -> Manifest:
    """Manifest of Zarr v2 directory stores; tasks list their folders, and chunk contents are not read."""
    if not isinstance(stores, DataFrame):
        stores = local_frame(spark, [(s, s) for s in stores], "granule_id STRING, path STRING")
    facts = run_reader(stores, read_zarr2_metadata, partitions, attempts, wait, on_error)
    meta = facts.where(F.col("kind") == "metadata").select("granule_id", F.from_json(
        "fact", "var STRING, name STRING, text STRING").alias("one")).select(
            "granule_id", "one.*")
    errors = facts.where(F.col("kind") == "errors").select(
        "granule_id", "path", F.get_json_object("fact", "$.error").alias("error"))
    good = stores.select("granule_id", "path").join(errors, "granule_id", "left_anti")
    listing = walk(spark, good.select(F.regexp_replace("path", "/+$", "").alias("root"))).select(
        F.concat_ws("/", "root", "key").alias("path"), F.col("size").alias("length"))
    return zarr2_manifest(good, listing, meta).with_(errors=errors)


def zarr2_manifest(stores: DataFrame, listing: DataFrame, meta: DataFrame) -> Manifest:
    """The same from tables: stores (granule_id, path), listing (path, length) and
    meta (granule_id, var, name, text).

    A listing table, such as a bucket inventory, keeps the driver from listing the objects. The
    store of an object is found by an equi-join on its parent folders, at the depths stores are at.
    """
    spark = stores.sparkSession
    plain = lambda c: F.regexp_replace(F.regexp_replace(c, "^file:/*", "/"), "/+$", "")
    roots = stores.select("granule_id", plain(F.col("path")).alias("root"))
    # A handful of numbers, however many stores there are.
    depths = sorted(row[0] for row in roots.select(
        F.size(F.split("root", "/"))).distinct().collect()) or [0]
    roots = small_side(roots)

    def inside(files: DataFrame) -> DataFrame:
        parts = F.split(plain(F.col("path")), "/")
        parents = F.array(*[F.array_join(F.slice(parts, F.lit(1), F.lit(n)), "/") for n in depths])
        return files.withColumn("root", F.explode(parents)).join(roots, "root").withColumn(
            "key", F.substr(plain(F.col("path")), F.length("root") + 2))

    arrays_raw = meta.where(F.col("name") == ARRAY_META).withColumn("meta", F.parse_json("text"))
    attrs = spark.sql(
        "SELECT granule_id, scope, e.key, to_json(e.value) AS value_json FROM {meta}, "
        "LATERAL variant_explode(meta) AS e(pos, key, value)",
        meta=meta.where(F.col("name") == ATTR_META).select(
            "granule_id", F.col("var").alias("scope"), F.parse_json("text").alias("meta")))
    names = attrs.where(F.col("key") == DIM_NAMES).select(
        "granule_id", F.col("scope").alias("var"),
        F.from_json("value_json", "array<string>").alias("dims"))
    raw = {name: F.to_json(F.variant_get("meta", f"$.{name}", "variant"))
           for name in ("compressor", "filters", "order", "fill_value")}
    no_dims = F.transform("shape", lambda n, i: F.concat(F.lit("dim_"), i.cast("string")))
    variables = arrays_raw.select(
        "granule_id", "var",
        F.variant_get("meta", "$.shape", "array<bigint>").alias("shape"),
        F.variant_get("meta", "$.chunks", "array<bigint>").alias("chunk_shape"),
        F.variant_get("meta", "$.dtype", "string").alias("dtype"),
        codec_json(raw["compressor"], raw["filters"], raw["order"]).alias("codec_json"),
        F.coalesce(raw["fill_value"], F.lit("null")).alias("fill_json"),
    ).join(names, ["granule_id", "var"], "left").select(
        "granule_id", "var", F.coalesce("dims", no_dims).alias("dims"), "shape", "chunk_shape",
        "dtype", "codec_json", "fill_json",
        F.array_contains(F.coalesce("dims", no_dims), F.col("var")).alias("is_coord"),
        F.lit(False).alias("loadable"))
    dims = variables.select("granule_id", F.explode(F.arrays_zip("dims", "shape")).alias("one")
                            ).groupBy("granule_id", F.col("one.dims").alias("dim")).agg(
                                F.max("one.shape").alias("size"))
    scalars = variables.where(F.size("shape") == 0).select(
        "granule_id", "var", F.lit(True).alias("scalar"))
    index = F.split(F.regexp_extract("key", CHUNK_KEY, 2), "[./]").cast("array<bigint>")
    chunks = (inside(listing).where(F.col("key").rlike(CHUNK_KEY))
              .select("granule_id", F.regexp_extract("key", CHUNK_KEY, 1).alias("var"),
                      index.alias("chunk_idx"), F.col("path").alias("url"),
                      F.lit(0).cast("bigint").alias("offset"), "length")
              .join(small_side(scalars), ["granule_id", "var"], "left")
              .select("granule_id", "var",
                      F.when(F.col("scalar"), F.array().cast("array<bigint>"))
                      .otherwise(F.col("chunk_idx")).alias("chunk_idx"), "url", "offset", "length",
                      F.lit(None).cast("string").alias("inline_text")))
    kept = attrs.where(F.col("key") != DIM_NAMES)
    return Manifest(dims, variables, kept, chunks,
                    local_frame(spark, [], schemas.COORD_VALUES))
