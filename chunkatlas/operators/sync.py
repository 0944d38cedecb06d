"""Plan and apply copies and deletes between stores."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import folder_prefix, not_dir, reroot
from ..schemas import OBJECTS
from ..session import local_frame, materialize
from ..sinks.files import exists, folders, write_text
from ..sources.listing import list_objects
from ..sources.storage import copy_object, delete_object, delete_objects
from .ordering import delete_batches

# Modes, actions and the number of keys in one delete request.
COPY, SYNC, UPLOAD, DELETE = "copy", "sync", "upload_folder", "delete_folder"
MODES = (COPY, SYNC, UPLOAD, DELETE)
DELETE_BATCH = 1000

PLAN = ("key STRING, source_key STRING, action STRING, reason STRING, size BIGINT, etag STRING")


@dataclass(frozen=True)
class SyncRequest:
    """What to sync. ``folder`` narrows both prefixes in the folder modes."""

    source_bucket: str
    dest_bucket: str
    source_prefix: str = ""
    dest_prefix: str = ""
    mode: str = COPY
    folder: str | None = None
    ignore_is_same: bool = False

    def problem(self) -> str | None:
        if self.mode not in MODES:
            return f"Unknown mode: {self.mode}"
        if self.mode in (UPLOAD, DELETE) and not self.folder:
            return f"Missing 'folder' for {self.mode} mode"
        return None

    @property
    def scope(self) -> str | None:
        return self.folder if self.mode in (UPLOAD, DELETE) else None

    @property
    def source_root(self) -> str:
        return folder_prefix(self.source_prefix, self.scope)

    @property
    def dest_root(self) -> str:
        return folder_prefix(self.dest_prefix, self.scope)


def is_same(size: Column, etag: Column, dst_size: Column, dst_etag: Column,
            dst_source_etag: Column) -> Column:
    """Equal sizes, and the source's etag is the one stamped on the copy, or else the copy's own."""
    stamped = dst_source_etag.isNotNull() & (dst_source_etag != "")
    return F.coalesce(size == dst_size, F.lit(False)) & etag.eqNullSafe(
        F.when(stamped, dst_source_etag).otherwise(dst_etag))


def sync_plan(src: DataFrame, dst: DataFrame, request: SyncRequest) -> DataFrame:
    """One row per object to copy, skip or delete. Reads two listings and changes nothing.

    Both listings are joined on the key, which is unique in a bucket, so no key is hot.
    """
    if problem := request.problem():
        raise ValueError(problem)
    source = (src.where(F.col("key").startswith(request.source_root) & not_dir(F.col("key")))
              .select(reroot(F.col("key"), request.source_root, request.dest_root).alias("key"),
                      F.col("key").alias("source_key"), "size", "etag", F.lit(True).alias("_src")))
    target = dst.where(F.col("key").startswith(request.dest_root) & not_dir(F.col("key"))).select(
        "key", F.col("size").alias("_size"), F.col("etag").alias("_etag"),
        F.col("source_etag").alias("_stamp"), F.lit(True).alias("_dst"))
    null = F.lit(None).cast("string")
    if request.mode == DELETE:
        return target.select("key", null.alias("source_key"), F.lit("delete").alias("action"),
                             F.lit("in folder").alias("reason"),
                             F.lit(None).cast("bigint").alias("size"), null.alias("etag"))
    force = F.lit(request.ignore_is_same and request.mode in (COPY, UPLOAD))
    same = ~force & F.col("_dst").isNotNull() & is_same(
        F.col("size"), F.col("etag"), F.col("_size"), F.col("_etag"), F.col("_stamp"))
    # In sync mode one full outer join finds both what to copy and what the source lacks.
    joined = source.join(target, "key", "full" if request.mode == SYNC else "left")
    extra = F.col("_src").isNull()
    return joined.select(
        "key", "source_key",
        F.when(extra, "delete").when(same, "skip").otherwise("copy").alias("action"),
        F.when(extra, "not in source").when(same, "same")
        .when(force, "forced").when(F.col("_dst").isNull(), "absent").otherwise("changed")
        .alias("reason"), "size", "etag")


def sync_summary(plan: DataFrame, request: SyncRequest) -> DataFrame:
    """Counts of a plan, with the request beside them."""
    count = lambda action: F.count_if(F.col("action") == action)
    return plan.agg(count("copy").alias("copied"), count("skip").alias("skipped"),
                    count("delete").alias("deleted")).select(
        F.lit(200).alias("status"), F.lit(None).cast("string").alias("message"),
        "copied", "skipped", "deleted", *_echo(request))


def _echo(request: SyncRequest) -> list[Column]:
    return [F.lit(request.source_bucket).alias("source_bucket"),
            F.lit(request.source_root).alias("source_prefix"),
            F.lit(request.dest_bucket).alias("dest_bucket"),
            F.lit(request.dest_root).alias("dest_prefix"),
            F.lit(request.mode).alias("mode"),
            F.lit(request.folder).cast("string").alias("folder")]


def sync_status(spark: SparkSession, src: DataFrame, dst: DataFrame,
                request: SyncRequest) -> DataFrame:
    """The summary row, or a row with status 400 and the reason for a request that is not valid."""
    if problem := request.problem():
        zero = F.lit(0).cast("bigint")
        return spark.range(1).select(
            F.lit(400).alias("status"), F.lit(problem).alias("message"), zero.alias("copied"),
            zero.alias("skipped"), zero.alias("deleted"), *_echo(request))
    return sync_summary(sync_plan(src, dst, request), request)


def stamped_objects(plan: DataFrame, bucket: str) -> DataFrame:
    """Destination records of copied objects: the source's etag is kept as ``source_etag``."""
    return plan.where(F.col("action") == "copy").select(
        F.lit(bucket).alias("bucket"), "key", "size", "etag", F.col("etag").alias("source_etag"),
        F.current_timestamp().alias("modified"))


def apply_plan(plan: DataFrame, request: SyncRequest, partitions: int | None = None) -> DataFrame:
    """Copy and delete what the plan says, in parallel; one row per key with what happened.

    A failure is a row, not the end of the job. Deletes run in batches of 1000 keys. The plan is
    fixed before anything changes. Both actions can be repeated, so a task that is run again does
    no harm, and the result is written once.
    """
    spark = plan.sparkSession
    plan = materialize(plan.select("key", "source_key", "action"), "plan")
    tasks = partitions or spark.sparkContext.defaultParallelism
    work = plan.where(F.col("action") == "copy").select("key", "source_key", "action")
    copies = work.withColumn("batch_no", F.lit(None).cast("bigint")).repartition(tasks)
    deletes = delete_batches(plan.where(F.col("action") == "delete")
                             .select("key", "source_key", "action"), DELETE_BATCH)
    deletes = deletes.select(copies.columns).repartition(tasks, "batch_no")
    from_bucket, to_bucket = request.source_bucket.rstrip("/"), request.dest_bucket.rstrip("/")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                error = None
                try:
                    if row.action == "copy":
                        copy_object(f"{from_bucket}/{row.source_key}", f"{to_bucket}/{row.key}")
                    else:
                        delete_object(f"{to_bucket}/{row.key}")
                except FileNotFoundError as failure:
                    error = None if row.action == "delete" else str(failure)
                except Exception as failure:  # noqa: BLE001 - reported as a row
                    error = str(failure)
                rows.append((row.key, row.action, error is None, error))
            yield pd.DataFrame(rows, columns=["key", "action", "ok", "error"])

    schema = "key STRING, action STRING, ok BOOLEAN, error STRING"
    done = copies.mapInPandas(run, schema).unionByName(deletes.mapInPandas(run, schema))
    return materialize(done, "applied")


#: Keys of a plan that are worked on, and journalled, together.
SLICE_KEYS = 1_000_000
_STAMPS = "key STRING, source_etag STRING"
_OUTCOMES = "key STRING, action STRING, etag STRING, ok BOOLEAN, error STRING"


@dataclass(frozen=True)
class SyncRun:
    """One run: its number, the plan, an outcome per key that was copied or deleted, and the summary row."""

    number: int
    plan: DataFrame
    outcomes: DataFrame
    summary: DataFrame


def run_sync(spark: SparkSession, request: SyncRequest, state: str, etag: str | None = "md5",
             dest_etag: str | None = "md5", slices: int | None = None,
             copy: Callable[[str, str], None] = copy_object,
             delete: Callable[[Sequence[str]], dict[str, str]] = delete_objects) -> SyncRun:
    """List both sides, plan, copy and delete in tasks, stamp what was copied, and count what was done.

    ``state`` is the journal of this pair of stores: for each run its request, its plan (what is intended), and,
    slice by slice, the outcomes; and after each run the stamps, a table of each copied key's source etag, which
    stands beside the destination as stores have no place for it. A run that stopped is taken up again with its
    plan, and only slices without outcomes are worked on; all actions can be repeated. A key that fails is an
    outcome and not the end of the run: it keeps its old stamp, so the next run plans it anew.
    """
    if problem := request.problem():
        raise ValueError(problem)
    state = state.rstrip("/")
    stamped = [int(name.partition("=")[2]) for name in folders(spark, f"{state}/stamps", "version=*")
               if exists(spark, f"{state}/stamps/{name}/_SUCCESS")] if exists(spark, f"{state}/stamps") else []
    last = max(stamped, default=0)
    home, stamps = f"{state}/run={last + 1:06d}", local_frame(spark, [], _STAMPS)
    if last:
        stamps = spark.read.schema(_STAMPS).parquet(f"{state}/stamps/version={last:06d}")
    if exists(spark, f"{home}/request"):
        asked = spark.read.text(f"{home}/request", wholetext=True).first()[0]
        if asked != repr(request):
            raise ValueError(f"the run in {home} was asked for {asked}")
    else:
        write_text(spark, f"{home}/request", repr(request))
    if not exists(spark, f"{home}/plan/_SUCCESS"):
        source = _listed(spark, request.source_bucket, request.source_root, etag, None, f"{home}/source")
        target = _listed(spark, request.dest_bucket, request.dest_root, dest_etag, stamps, f"{home}/target")
        made = materialize(sync_plan(source, target, request), "planned")
        count = slices or max(1, -(-made.count() // SLICE_KEYS))
        (made.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(count)).cast("int"))
         .write.mode("overwrite").partitionBy("slice").parquet(f"{home}/plan"))
    plan = spark.read.schema(f"{PLAN}, slice INT").parquet(f"{home}/plan")
    for number in sorted(int(name.partition("=")[2]) for name in folders(spark, f"{home}/plan", "slice=*")):
        done = f"{home}/outcomes/slice={number}"
        if not exists(spark, f"{done}/_SUCCESS"):
            work = plan.where((F.col("slice") == number) & F.col("action").isin("copy", "delete"))
            _carried_out(work, request, copy, delete).write.mode("overwrite").parquet(done)
    outcomes = (spark.read.schema(f"{_OUTCOMES}, slice INT").parquet(f"{home}/outcomes").drop("slice")
                if exists(spark, f"{home}/outcomes") else local_frame(spark, [], _OUTCOMES))
    good = outcomes.where("ok")
    copied = good.where("action = 'copy'").select("key", F.col("etag").alias("source_etag"))
    path = f"{state}/stamps/version={last + 1:06d}"
    stamps.join(good.select("key"), "key", "left_anti").unionByName(copied).write.mode("overwrite").parquet(path)
    count = lambda condition: F.count_if(F.expr(condition))
    did = outcomes.agg(count("ok AND action = 'copy'").alias("copied"), count("ok AND action = 'delete'").alias("deleted"),
                       count("NOT ok").alias("failed"))
    skipped = plan.agg(count("action = 'skip'").alias("skipped"))
    summary = did.join(skipped).select(F.when(F.col("failed") > 0, 500).otherwise(200).alias("status"),
                                       "copied", "skipped", "deleted", "failed", *_echo(request))
    return SyncRun(last + 1, plan.drop("slice"), outcomes, summary)


def _listed(spark: SparkSession, bucket: str, prefix: str, etag: str | None, stamps: DataFrame | None,
            state: str) -> DataFrame:
    """All objects below a prefix; none if a destination's folder is not there yet."""
    folder = prefix.rpartition("/")[0]
    if stamps is not None and not exists(spark, f"{bucket.rstrip('/')}/{folder}"):
        return local_frame(spark, [], OBJECTS)
    return list_objects(spark, bucket, prefix, etag=etag, stamps=stamps, hidden=True, markers=True, state=state)


def _carried_out(work: DataFrame, request: SyncRequest, copy: Callable[[str, str], None],
                 delete: Callable[[Sequence[str]], dict[str, str]]) -> DataFrame:
    """One row per key with what happened. Deletes go out in requests of up to 1000 keys."""
    spark = work.sparkSession
    from_bucket, to_bucket = request.source_bucket.rstrip("/"), request.dest_bucket.rstrip("/")
    kinds = {"key": pa.string(), "action": pa.string(), "etag": pa.string(), "ok": pa.bool_(), "error": pa.string()}

    def record(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.values())], list(kinds))

    def deleted(keys: list[str]) -> pa.RecordBatch:
        failed = delete([f"{to_bucket}/{k}" for k in keys])
        errors = [failed.get(f"{to_bucket}/{k}") for k in keys]
        return record([(k, "delete", None, e is None, e) for k, e in zip(keys, errors)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[str] = []
        for batch in batches:
            for key, source, action, etag in zip(*(c.to_pylist() for c in batch.columns)):
                if action == "delete":
                    waiting.append(key)
                    if len(waiting) == DELETE_BATCH:
                        yield deleted(waiting)
                        waiting = []
                    continue
                error = None
                try:
                    copy(f"{from_bucket}/{source}", f"{to_bucket}/{key}")
                except Exception as failure:  # noqa: BLE001 - reported as a row
                    error = str(failure) or type(failure).__name__
                yield record([(key, action, etag, error is None, error)])
        if waiting:
            yield deleted(waiting)

    # As many tasks as the work is worth; copies and deletes in tasks of their own.
    tasks = max(spark.sparkContext.defaultParallelism, -(-work.count() // DELETE_BATCH))
    rows = work.select("key", "source_key", "action", "etag")
    copies = rows.where("action = 'copy'").repartition(tasks).mapInArrow(run, _OUTCOMES)
    deletes = rows.where("action = 'delete'")
    deletes = deletes.repartition(max(1, -(-deletes.count() // DELETE_BATCH))).mapInArrow(run, _OUTCOMES)
    return copies.unionByName(deletes)
