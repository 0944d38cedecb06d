"""The registered queries: each runs an operator of the engine over whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (basename, chunk_key, coord_vars, granule_fields, https_name, is_level2,
                         link, output_name, provider, rewrite_text, s3_to_https)
from ..operators.attrs import merge_attrs, require_attrs
from ..operators.classes import BASIC, schema_mismatches
from ..operators.combine import (EPOCH_ATTRS, GRANULE, SECONDS, SORTED, axis_table, choose_mode,
                                 combine, subset_by_start)
from ..operators.inventory import folders_by_bucket, inventory, top_folders
from ..operators.ordering import (assign_batches, delete_batches, first_k, order_by_start,
                                  with_ordinal, with_ordinal_sorted)
from ..operators.quality import compat_gate, dim_conflicts, var_mismatches
from ..operators.rewrite import rewrite_refs, urls_to_https
from ..operators.sync import SyncRequest, apply_plan, run_sync, sync_plan, sync_status
from ..schemas import Dataset, Manifest
from ..session import local_frame, materialize, prepare, scratch_path
from ..sinks.files import concat_parts
from ..sinks.refs import convert_refs, write_refs_json, write_refs_parquet
from ..sinks.records import open_records, write_records
from ..sinks.reports import write_inventory
from ..sources.arrays import read_array
from ..sources.catalog import direct_links, guard, search, search_specs
from ..sources.cells import cells
from ..sources.listing import list_objects
from ..sources.refs import open_refs_parquet, read_refs_json
from ..sources.storage import copy_object, locate
from ..sources.virtualize import virtualize
from ..streaming import CombinedStore
from . import bindings as b

SPECS = [
    {"short_name": "C1_L2", "granule_name": "C1_L2_*_f.nc", "temporal": ("1995-01-01", "1997-12-31")},
    {"short_name": "C1_L2", "granule_name": "C1*.nc", "temporal": ("1997-01-01", "1999-12-31")},
    {"short_name": "C2_L2", "granule_name": "*_o.nc", "temporal": None},
]


def _long(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def _epoch(c: str) -> Column:
    return F.unix_seconds(F.col(c))


def catalog_search(spark: SparkSession, sf: str) -> DataFrame:
    found = search(b.granules(spark, sf), "C1_L2", "1-15-1997", "1998-12-31")
    return found.select("granule_id", "name", _epoch("begin").alias("begin_s"))


def catalog_search_specs(spark: SparkSession, sf: str) -> DataFrame:
    found = search_specs(b.granules(spark, sf), SPECS)
    return with_ordinal(found, prefix=["spec_no"]).select(
        "granule_id", _long("spec_no").alias("spec_no"), "ordinal")


def catalog_search_many(spark: SparkSession, sf: str) -> DataFrame:
    """As many specs as customers over granules that last up to forty days."""
    found = search_specs(b.granules(spark, sf, F.col("o_custkey") % 40), b.customer_specs(spark, sf))
    return found.select("granule_id", _long("spec_no").alias("spec_no"))


def granule_fields_query(spark: SparkSession, sf: str) -> DataFrame:
    found = direct_links(granule_fields(b.granules(spark, sf)))
    return found.select(
        "granule_id", _epoch("begin").alias("begin_s"), "cycle", "ppass", "url",
        basename(link(F.col("links"), "https")).alias("filename"),
        provider(F.col("url"), b.PROVIDERS, b.DEFAULT_PROVIDER).alias("provider"))


def coord_vars_query(spark: SparkSession, sf: str) -> DataFrame:
    found = b.granules(spark, sf)
    csv = F.concat(F.lit(" lat, lon,,"), F.substring("name", -4, 1), F.lit(" "))
    names = coord_vars(csv, is_level2(F.col("collection")), F.col("collection"), ["C2_L2"],
                       ["line", "pixel"])
    return found.select("granule_id", F.array_join(names, "|").alias("coords"))


def epoch_axis(spark: SparkSession, sf: str) -> DataFrame:
    axis = axis_table(b.granules(spark, sf), SECONDS)
    return axis.select("granule_id", "ordinal", "start",
                       *[F.lit(text).alias(name) for name, text in EPOCH_ATTRS.items()])


def batches(spark: SparkSession, sf: str) -> DataFrame:
    links = direct_links(b.granules(spark, sf)).select("granule_id", "search_rank", "url")
    return assign_batches(links, b.PROVIDERS, b.DEFAULT_PROVIDER).select(
        "granule_id", "batch_no", "batch_total", "provider", "batch_provider")


def orbit_sort(spark: SparkSession, sf: str) -> DataFrame:
    found = granule_fields(b.granules(spark, sf)).select(
        "granule_id", "begin", "begin_raw", "search_rank")
    return with_ordinal_sorted(found, order_by_start()).select("granule_id", "ordinal")


def sample_links(spark: SparkSession, sf: str) -> DataFrame:
    links = direct_links(b.granules(spark, sf)).select("collection", "search_rank", "url")
    per_group = first_k(links, 5, ["search_rank"], ["collection"])
    overall = first_k(links, 3, ["search_rank"])
    return per_group.select(F.lit("collection").alias("sample"), "collection", "url").unionByName(
        overall.select(F.lit("all").alias("sample"), "collection", "url"))


def output_names(spark: SparkSession, sf: str) -> DataFrame:
    orders = b.load(spark, sf, "orders")
    start = F.when(F.col("o_orderstatus") == "F", None).when(
        F.col("o_orderstatus") == "O", "None").otherwise(F.date_format("o_orderdate", "M-d-yyyy"))
    end = F.when(F.col("o_totalprice") > 200000, "").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    name = output_name(F.col("o_orderpriority"), start, end)
    return orders.select(b.granule_id("o_orderkey"), name.alias("s3_name"),
                         https_name(name).alias("https_name"),
                         output_name(F.col("o_orderpriority"), start, end, "https").alias("direct"))


def dim_conflicts_query(spark: SparkSession, sf: str) -> DataFrame:
    found = dim_conflicts(*b.part_dims(spark, sf))
    return found.select("dim", "size", "n_granules",
                        F.array_join("sample_links", " ").alias("sample_links"),
                        _long("more").alias("more"))


def var_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    manifest, found = b.part_variables(spark, sf)
    return var_mismatches(manifest.variables, found)


def compat_gate_query(spark: SparkSession, sf: str) -> DataFrame:
    return compat_gate(*b.part_variables(spark, sf), strict=False).select(
        "granule_id", "n_missing", "n_extra", "n_different", "n_ragged")


def dim_conflicts_places(spark: SparkSession, sf: str) -> DataFrame:
    """Conflicts of granules that two specs found: each counts once, and links follow the specs."""
    dims, _ = b.part_dims(spark, sf)
    found = dim_conflicts(dims, b.part_places(spark, sf, "p_partkey"), k=3,
                          order=["spec_no", "search_rank"])
    return found.select("dim", "size", "n_granules",
                        F.array_join("sample_links", " ").alias("sample_links"),
                        _long("more").alias("more"))


def mismatch_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every place that differs from granule 0, with both values and both files."""
    manifest, _ = b.part_variables(spark, sf)
    found = schema_mismatches(manifest.variables, b.part_places(spark, sf, "p_size"),
                              ["spec_no", "search_rank"], (*BASIC, "extra", "chunks"))
    return found.withColumn("spec_no", _long("spec_no"))


def compat_places(spark: SparkSession, sf: str) -> DataFrame:
    """The gate by place: partial chunks are refused everywhere but at the last place."""
    manifest, _ = b.part_variables(spark, sf)
    two = manifest.variables.withColumn("chunk_shape", F.array(F.lit(2).cast("bigint")))
    return compat_gate(manifest.with_(variables=two), b.part_places(spark, sf, "p_size"), "n",
                       ["spec_no", "search_rank"], strict=False).withColumn("spec_no", _long("spec_no"))


def attrs_merge(spark: SparkSession, sf: str) -> DataFrame:
    return merge_attrs(b.part_attrs(spark, sf), with_dropped=True).select(
        "scope", "key", "value_json", _long("dropped").alias("dropped"))


def _chunks(ds: Dataset, *more: str) -> DataFrame:
    return ds.chunk_refs.select(chunk_key(F.col("var"), F.col("chunk_idx")).alias("key"), "url",
                                "offset", "length", *more)


def combine_existing(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks(combine(b.manifest_existing(spark, sf), b.granules(spark, sf)))


def combine_coords(spark: SparkSession, sf: str) -> DataFrame:
    """Auxiliary coordinates that only attributes name are taken from granule 0, not repeated."""
    return _chunks(combine(b.manifest_coords(spark, sf), b.granules(spark, sf)))


def combine_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Dimensions and variables of the combined dataset."""
    ds = combine(b.manifest_coords(spark, sf), b.granules(spark, sf))
    text = F.array_join(F.col("shape").cast("array<string>"), "|")
    return ds.variables.select(
        F.lit("var").alias("kind"), F.col("var").alias("name"), F.array_join("dims", "|").alias("dims"),
        text.alias("sizes"), _long("is_coord").alias("is_coord")).unionByName(ds.dims.select(
            F.lit("dim").alias("kind"), F.col("dim").alias("name"), F.lit(None).cast("string").alias("dims"),
            F.col("size").cast("string").alias("sizes"), F.lit(None).cast("bigint").alias("is_coord")))


def combine_attrs(spark: SparkSession, sf: str) -> DataFrame:
    """Attributes of the combined dataset, those of its new time axis included."""
    ds = combine(b.manifest_new(spark, sf), b.granules(spark, sf), SECONDS)
    return require_attrs(ds.attrs)


def combine_seconds(spark: SparkSession, sf: str) -> DataFrame:
    mode = choose_mode("C1_L2", level2=True)
    ds = combine(b.manifest_new(spark, sf), b.granules(spark, sf), mode)
    return _chunks(ds)


def combine_sorted(spark: SparkSession, sf: str) -> DataFrame:
    mode = choose_mode("C2_L2", level2=True, special={"C2_L2": SORTED.name})
    ds = combine(b.manifest_new(spark, sf), b.granules(spark, sf), mode, coords=["lat"])
    return _chunks(ds)


def combine_granule(spark: SparkSession, sf: str) -> DataFrame:
    ds = combine(b.manifest_new(spark, sf), b.granules(spark, sf), GRANULE, coords=["lat"])
    beside = ds.axis.select("granule_id", _epoch("orbit").alias("orbit_s"), "cycle", "ppass",
                            "filename")
    return _chunks(ds, "granule_id").join(beside, "granule_id").drop("granule_id")


def subset_by_start_query(spark: SparkSession, sf: str) -> DataFrame:
    ds = combine(b.manifest_new(spark, sf), b.granules(spark, sf), SECONDS)
    hits = search(b.granules(spark, sf), "C1_L2", "1997-01-01", "1997-06-30")
    return _chunks(subset_by_start(ds, hits.select(_epoch("begin").alias("start"))))


def url_translate(spark: SparkSession, sf: str) -> DataFrame:
    hosts = local_frame(spark, list(b.HOSTS.items()), "bucket STRING, host STRING")
    found = urls_to_https(b.urls(spark, sf), hosts, b.DEFAULT_HOST, out="by_table")
    return found.withColumn("by_map", s3_to_https(F.col("url"), b.HOSTS, b.DEFAULT_HOST))


def text_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    text = rewrite_text(F.col("text"), b.BUCKETS, b.HOSTS, b.DEFAULT_HOST)
    return b.texts(spark, sf).select("key", F.md5(text).alias("rewritten"))


def _refs_row(refs: DataFrame) -> DataFrame:
    return refs.select("key", "kind", "url", "tail_json", F.md5("inline_text").alias("inline_md5"),
                       "other_json")


def refs_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    return _refs_row(rewrite_refs(b.refs(spark, sf), b.BUCKETS, b.HOSTS, b.DEFAULT_HOST))


def refs_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "roundtrip")
    source, target = f"{folder}/x_virtual_s3.json", f"{folder}/x_virtual_https.json"
    write_refs_json(b.refs(spark, sf), source)
    convert_refs(spark, source, target, buckets=b.BUCKETS, hosts=b.HOSTS,
                 default_host=b.DEFAULT_HOST, layout="lines")
    return _refs_row(read_refs_json(spark, target, "indented"))


def refs_json_foreign(spark: SparkSession, sf: str) -> DataFrame:
    """A file of one line as others write it, ``refs`` between other members, read in ranges of 64 KiB."""
    quoted = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    docs = b.load(spark, sf, "documents").select(F.concat(
        quoted(F.concat(F.lit('d"{\\/'), "doc_id")), F.lit(" : "), quoted("text")).alias("value"))
    pages = b.load(spark, sf, "pages").select(F.concat(
        quoted(F.concat(F.lit("p/"), "page_id")), F.lit(":["), quoted("url"), F.lit(" ,0,"), F.length("html"), F.lit("]")))
    parts = scratch_path(spark, "foreign")
    docs.unionAll(pages).write.option("lineSep", ", ").text(parts)
    path = f"{parts}.json"
    concat_parts(spark, parts, path, '{"version":1,"x":{"refs":{"no":["}\\"",1]}},"refs":{', '"z":{"a":[]}},"after":["refs",{}]}')
    return read_refs_json(spark, path, split=1 << 16).select("key", "kind", "url", "tail_json", "inline_text", "other_json")


def refs_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "roundtrip")
    write_refs_parquet(combine(b.manifest_existing(spark, sf), b.granules(spark, sf)), folder)
    return _chunks(open_refs_parquet(spark, folder))


def refs_records_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "records")
    write_records(combine(b.manifest_existing(spark, sf), b.granules(spark, sf)), folder, size=1000)
    return _chunks(open_records(spark, folder))


def file_manifest(spark: SparkSession, sf: str) -> DataFrame:
    listed = list_objects(spark, sf, glob="*.parquet")
    paths = listed.select(F.col("key").alias("granule_id"),
                          F.concat("bucket", F.lit("/"), "key").alias("path"))
    return virtualize(spark, paths, "parquet").chunk_refs.select(
        "granule_id", chunk_key(F.col("var"), F.col("chunk_idx")).alias("key"), "offset", "length")


#: Vectors per chunk and per store that ``array_read`` writes.
CHUNK_ROWS, STORE_ROWS = 128, 256


def _write_stores(vectors: DataFrame, root: str) -> DataFrame:
    """Write vectors as Zarr v2 stores with one array ``emb(vec, dim)`` each; return the stores."""
    width = len(vectors.first()["embedding"])
    info = vectors.groupBy(F.expr(f"vec_id div {STORE_ROWS}").alias("store")).agg(
        (F.max(F.expr(f"vec_id % {STORE_ROWS}")) + 1).alias("n"))
    chunks = vectors.groupBy(
        F.expr(f"vec_id div {STORE_ROWS}").alias("store"),
        F.expr(f"vec_id % {STORE_ROWS} div {CHUNK_ROWS}").alias("chunk")).agg(
            F.collect_list(F.struct((F.col("vec_id") % CHUNK_ROWS).alias("at"), "embedding"))
            .alias("rows"))

    def put(path: str, data: bytes) -> None:
        fs, at = locate(path)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(at) as out:
            out.write(data)

    def write_chunks(pdfs):
        for pdf in pdfs:
            for store, chunk, rows in pdf.itertuples(index=False):
                cells = np.zeros((CHUNK_ROWS, width), "<f4")
                for row in rows:
                    cells[row["at"]] = row["embedding"]
                put(f"{root}/{store}.zarr/emb/{chunk}.0", cells.tobytes())
            yield pd.DataFrame({"store": pdf["store"]})

    def write_meta(pdfs):
        for pdf in pdfs:
            for store, n in pdf.itertuples(index=False):
                put(f"{root}/{store}.zarr/.zgroup", b'{"zarr_format":2}')
                put(f"{root}/{store}.zarr/.zattrs", b'{"title":"vectors"}')
                put(f"{root}/{store}.zarr/emb/.zattrs", b'{"_ARRAY_DIMENSIONS":["vec","dim"]}')
                put(f"{root}/{store}.zarr/emb/.zarray", (
                    f'{{"shape":[{n},{width}],"chunks":[{CHUNK_ROWS},{width}],"dtype":"<f4",'
                    '"compressor":null,"filters":null,"fill_value":0,"order":"C",'
                    '"zarr_format":2}').encode())
            yield pdf[["store"]]

    done = materialize(chunks.mapInPandas(write_chunks, "store BIGINT"), "chunks").distinct()
    meta = materialize(info.mapInPandas(write_meta, "store BIGINT"), "stores")
    return meta.join(done, "store", "left_semi").select(
        F.col("store").cast("string").alias("granule_id"), F.col("store").alias("search_rank"),
        F.concat(F.lit(f"{root}/"), "store", F.lit(".zarr")).alias("path"))


def array_read(spark: SparkSession, sf: str) -> DataFrame:
    stores = _write_stores(b.load(spark, sf, "embeddings").select("vec_id", "embedding"),
                           scratch_path(spark, "arrays"))
    manifest = virtualize(spark, stores, "zarr2")
    none = F.lit(None).cast("string")
    found = stores.withColumns({"begin": none.cast("timestamp"), "begin_raw": none})
    ds = combine(manifest, found, axis="vec")
    return read_array(ds, "emb").select(F.get("idx", F.lit(0)).alias("vec_id"),
                                        F.get("idx", F.lit(1)).alias("at"), "value")


def array_slice(spark: SparkSession, sf: str) -> DataFrame:
    """A box of the vectors' array by conditions on its dimensions, read through positional records."""
    stores = _write_stores(b.load(spark, sf, "embeddings").select("vec_id", "embedding"),
                           scratch_path(spark, "arrays"))
    none = F.lit(None).cast("string")
    found = stores.withColumns({"begin": none.cast("timestamp"), "begin_raw": none})
    folder = scratch_path(spark, "records")
    write_records(combine(virtualize(spark, stores, "zarr2"), found, axis="vec"), folder, size=16)
    return cells(spark, folder, "emb").where("vec >= 100 AND dim BETWEEN 3 AND 17").select(
        F.col("vec").alias("vec_id"), F.col("dim").alias("at"), "value")


def zarr_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The chunks of stores that are written from vectors, found by listing their folders in tasks."""
    stores = _write_stores(b.load(spark, sf, "embeddings").select("vec_id", "embedding"),
                           scratch_path(spark, "arrays"))
    return virtualize(spark, stores, "zarr2").chunk_refs.select(
        "granule_id", chunk_key(F.col("var"), F.col("chunk_idx")).alias("key"), "offset", "length")


def top_folders_query(spark: SparkSession, sf: str) -> DataFrame:
    return top_folders(b.objects(spark, sf)[1], "pre/")


def inventory_query(spark: SparkSession, sf: str) -> DataFrame:
    src, dst = b.objects(spark, sf)
    matrix = inventory(folders_by_bucket(src.unionByName(dst), "pre/"))
    root = scratch_path(spark, "report")
    key = write_inventory(matrix, root)
    return spark.read.option("header", "true").schema(matrix.schema).csv(f"{root}/{key}")


def _plan(mode: str, dest_prefix: str = "pre/", folder: str | None = None):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        request = SyncRequest("one", "two", "pre/", dest_prefix, mode, folder)
        return sync_plan(*b.objects(spark, sf), request).select("key", "action", "reason")
    return query


def sync_summary(spark: SparkSession, sf: str) -> DataFrame:
    src, dst = b.objects(spark, sf)
    good = SyncRequest("one", "two", "pre/", "pre/", "sync")
    wrong = SyncRequest("one", "two", "pre/", "pre/", "upload_folder")
    rows = sync_status(spark, src, dst, good).unionByName(sync_status(spark, src, dst, wrong))
    deletes = sync_plan(src, dst, good).where("action = 'delete'").select("key")
    per_batch = delete_batches(deletes, 50).groupBy("batch_no").agg(F.count(F.lit(1)).alias("n"))
    sizes = per_batch.agg(F.count(F.lit(1)).alias("batches"), F.max("n").alias("largest"))
    return rows.select(
        _long("status").alias("status"), "message", "copied", "skipped", "deleted", "mode",
        sizes.select("batches").scalar().alias("batches"),
        sizes.select("largest").scalar().alias("largest"))


def sync_apply(spark: SparkSession, sf: str) -> DataFrame:
    """Copy the files of a store, copy again, and list what is there, in folders made for the run."""
    src, dst = scratch_path(spark, "source"), scratch_path(spark, "target")
    docs = b.load(spark, sf, "documents").select("source", "lang", "text")
    docs.select("source", F.col("text").alias("value")).write.partitionBy("source").text(
        f"{src}/pre")
    docs.select("lang", F.col("text").alias("value")).write.partitionBy("lang").text(f"{dst}/pre")
    request = SyncRequest(src, dst, "pre/", "pre/", "sync")

    def listing(root: str) -> DataFrame:
        return list_objects(spark, root, "pre/", glob="part-*", etag="md5")

    done = apply_plan(sync_plan(listing(src), listing(dst), request), request)
    again = sync_plan(listing(src), listing(dst), request)
    folder = F.split_part(F.col("key"), F.lit("/"), F.lit(2)).alias("folder")
    first = done.groupBy(folder, "action").agg(F.count_if("ok").alias("n"))
    second = again.groupBy(folder, "action").agg(F.count(F.lit(1)).alias("n"))
    return first.select(F.lit("applied").alias("run"), "folder", "action", "n").unionByName(
        second.select(F.lit("planned again").alias("run"), "folder", "action", "n"))


#: Documents per object, and objects per folder, that ``sync_run`` writes.
OBJECT_DOCS, FOLDER_OBJECTS = 20, 100


class _Stopped(BaseException):
    """Ends a run as a lost driver would."""


def _stopping_copy(source: str, target: str) -> None:
    if target.endswith("7.txt"):
        raise _Stopped(target)
    copy_object(source, target)


def _object_writer(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes batches of ``(k, content)`` as objects; contents go out from Arrow's memory, not as Python texts."""
    def put(path: str, content: pa.Buffer | bytes) -> None:
        fs, at = locate(path)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(at) as out:
            out.write(content)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = batch.column(1).view(pa.binary())
            for i, k in enumerate(batch.column(0).to_pandas()):
                put(f"{root}/src/in/{k // FOLDER_OBJECTS}/{k}.txt", contents[i].as_buffer())
                if k % 3 == 0:
                    put(f"{root}/dst/out/{k // FOLDER_OBJECTS}/{k}.txt", b"old")
                if k % 5 == 0:
                    put(f"{root}/dst/out/{k // FOLDER_OBJECTS}/gone-{k}.txt", b"x")
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["k"])

    return write


def sync_run(spark: SparkSession, sf: str) -> DataFrame:
    """Sync objects made of documents to another prefix: a run that is stopped, taken up again, and a second run."""
    root = scratch_path(spark, "sync")
    pieces = b.load(spark, sf, "documents").groupBy(F.expr(f"doc_id div {OBJECT_DOCS}").alias("k")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda d: d["text"]), "\n")
        .alias("content"))

    materialize(pieces.mapInArrow(_object_writer(root), "k BIGINT"), "objects")
    fs, at = locate(f"{root}/src/in/empty")
    fs.create_dir(at)
    request = SyncRequest(f"{root}/src", f"{root}/dst", "in/", "out/", "sync")
    try:
        run_sync(spark, request, f"{root}/state", slices=4, copy=_stopping_copy)
    except Exception as stop:  # noqa: BLE001 - whatever a failed job raises
        if "_Stopped" not in str(stop):
            raise
    # The destination's own etags differ, so only the stamps say what is the same.
    first = run_sync(spark, request, f"{root}/state", slices=4)
    second = run_sync(spark, request, f"{root}/state", dest_etag=None)
    sizes = first.plan.select("key", "size")
    return (first.outcomes.where("ok").join(sizes, "key").select(F.lit("first").alias("run"), "key", "action", "size")
            .unionByName(second.plan.select(F.lit("second").alias("run"), "key", "action", "size")))


def guard_status(spark: SparkSession, sf: str) -> DataFrame:
    found = b.granules(spark, sf)
    names = ("C1_L2", "C3_L4", "absent")
    rows = [guard(search(found, name)).withColumn("collection", F.lit(name)) for name in names]
    out = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return out.select("collection", "status", "reason", "granules", "links")


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    found = b.granules(spark, sf)
    old = F.col("umm.TemporalExtent.RangeDateTime.BeginningDateTime") < b.SPLIT_DAY
    return found.where(old), found.where(~old)


def append_batch(spark: SparkSession, sf: str) -> DataFrame:
    store = CombinedStore(spark, scratch_path(spark, "store"))
    manifest = b.manifest_existing(spark, sf)
    for number, part in enumerate(_halves(spark, sf)):
        store.append(manifest, part, number)
    return _chunks(store.read())


#: Batches of ``append_many``, whose parts are merged by twos.
BATCHES = 5


def append_many(spark: SparkSession, sf: str) -> DataFrame:
    """All granules in several batches, with merges in between."""
    store = CombinedStore(spark, scratch_path(spark, "store"), fan=2)
    found = b.granules(spark, sf)
    for number in range(BATCHES):
        def batch(rank: Column, number: int = number) -> Column:
            return rank % BATCHES == number
        # The manifest of these granules only, as a reader of their files would give it.
        store.append(b.manifest_existing(spark, sf, batch), found.where(batch(F.col("search_rank"))), number)
    return _chunks(store.read())


def append_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Granule files arrive twice; the stream is started anew for each arrival."""
    store = CombinedStore(spark, scratch_path(spark, "store"), SECONDS)
    arriving, checkpoint = scratch_path(spark, "arriving"), scratch_path(spark, "progress")

    def manifest_for(batch: DataFrame) -> Manifest:
        # A micro-batch is read with all its columns at each use, so its ids are written once.
        return b.manifest_new(spark, sf, materialize(batch.select("granule_id"), "batch"))

    for part in _halves(spark, sf):
        part.write.mode("append").parquet(arriving)
        stream = spark.readStream.schema(part.schema).parquet(arriving)
        store.append_stream(stream, manifest_for, checkpoint).trigger(
            availableNow=True).start().awaitTermination()
    return _chunks(store.read())


_ALL = {
    "combine_existing": combine_existing,
    "catalog_search": catalog_search,
    "catalog_search_specs": catalog_search_specs,
    "catalog_search_many": catalog_search_many,
    "granule_fields": granule_fields_query,
    "coord_vars": coord_vars_query,
    "epoch_axis": epoch_axis,
    "batches": batches,
    "orbit_sort": orbit_sort,
    "sample_links": sample_links,
    "output_names": output_names,
    "dim_conflicts": dim_conflicts_query,
    "var_mismatch": var_mismatch,
    "compat_gate": compat_gate_query,
    "dim_conflicts_places": dim_conflicts_places,
    "mismatch_values": mismatch_values,
    "compat_places": compat_places,
    "attrs_merge": attrs_merge,
    "combine_coords": combine_coords,
    "combine_shapes": combine_shapes,
    "combine_attrs": combine_attrs,
    "combine_seconds": combine_seconds,
    "combine_sorted": combine_sorted,
    "combine_granule": combine_granule,
    "subset_by_start": subset_by_start_query,
    "url_translate": url_translate,
    "text_rewrite": text_rewrite,
    "refs_rewrite": refs_rewrite,
    "refs_json_roundtrip": refs_json_roundtrip,
    "refs_json_foreign": refs_json_foreign,
    "refs_parquet_roundtrip": refs_parquet_roundtrip,
    "refs_records_roundtrip": refs_records_roundtrip,
    "file_manifest": file_manifest,
    "array_read": array_read,
    "array_slice": array_slice,
    "zarr_manifest": zarr_manifest,
    "top_folders": top_folders_query,
    "inventory": inventory_query,
    "sync_plan_copy": _plan("copy"),
    "sync_plan_sync": _plan("sync"),
    "sync_plan_upload": _plan("upload_folder", folder="BUILDING"),
    "sync_plan_delete": _plan("delete_folder", folder="SUP"),
    "sync_summary": sync_summary,
    "sync_apply": sync_apply,
    "sync_run": sync_run,
    "guard_status": guard_status,
    "append_batch": append_batch,
    "append_many": append_many,
    "append_stream": append_stream,
}


def _prepared(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir.rstrip("/"))
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES = {name: _prepared(query) for name, query in _ALL.items()}
