"""Incremental combination.

A store is a folder of tables, each of which has a folder per part, and a commit log (``log.py``). A batch
writes a part under a name of its own and then publishes the version that names it, which makes it count.
A batch that failed midway, or that a restarted stream repeats, leaves the same result; parts that no version
names are never read. Parts of older versions stay, so whoever has opened one can go on reading it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import granule_fields, utc_timestamp
from ..operators.attrs import attr_summary, merge_attrs
from ..operators.combine import (MODES, Mode, axis_inputs, axis_sizes, axis_table, combine_chunks,
                                 combine_coord_values, combined_variables, roles, with_axis_attrs)
from ..operators.coords import with_auxiliary
from ..operators.quality import compat_gate
from ..schemas import Dataset, Manifest
from ..session import fits, hashed_side, local_frame, materialize, small_side, together
from .log import CommitLog, ConflictingWriter, Part, Version, full_tiers

_COMMITS = "batch_id BIGINT, granules BIGINT, axis_size BIGINT"
_TABLES = ("axis", "chunk_refs", "coord_values", "attrs", "dims")


class CombinedStore:
    """A combined dataset on disk that grows by batches.

    Every batch goes behind the ones before it, in search order within the batch. Granules that the
    store already has are left out. Sorting by start time would move stored positions, so the
    ``sorted`` mode has to be combined anew instead.
    """

    def __init__(self, spark: SparkSession, root: str, mode: Mode | str = "existing",
                 gate: bool = True, prefix: Sequence[str] = (), fan: int = 8):
        self.spark, self.root = spark, root.rstrip("/")
        self.mode = MODES[mode] if isinstance(mode, str) else mode
        if self.mode.by_start:
            raise ValueError("a dataset sorted by start time cannot be appended to")
        if fan < 2:
            raise ValueError("fan must be at least 2")
        self.gate, self.prefix, self.fan = gate, tuple(prefix), fan
        self.log = CommitLog(spark, f"{self.root}/log")

    def commits(self) -> DataFrame:
        """One row per finished batch."""
        now = self.log.latest()
        if now is None:
            return local_frame(self.spark, [], _COMMITS)
        return self._table("commits", [part.name for part in now.parts])

    def _table(self, name: str, parts: Sequence[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{name}/{part}" for part in parts])

    def append(self, manifest: Manifest, granules: DataFrame, batch_id: int) -> int:
        """Combine new granules behind the stored ones; return how many were new.

        Batches come in ascending order of their numbers; one that was finished is not run again. If another
        writer has published a batch meanwhile, ConflictingWriter is raised and this batch does not count.
        """
        base = self.log.latest()
        if base is not None and batch_id <= base.batch_id:
            done = self.commits().where(F.col("batch_id") == batch_id).first()
            if done is None:
                raise ValueError(f"batch {batch_id} comes after batch {base.batch_id}")
            return done["granules"]
        base = base or Version(-1, -1, 0, 0, None, ())
        first_batch = base.granules == 0
        part = f"{batch_id}-{uuid.uuid4().hex[:12]}"
        new = materialize(self._new(granules, base), "arrived")
        if new.isEmpty():
            self._commit(base, part, batch_id, 0, 0)
            return 0

        order = [*self.prefix, "search_rank"]
        if first_batch:
            # A value, not a subquery: it reaches both sides of whatever joins the manifest consists of.
            head = new.agg(F.min_by("granule_id", F.struct(*order))).first()[0]
            reference = with_auxiliary(manifest.variables.where(F.col("granule_id") == head), manifest.attrs)
            self._write(reference, "reference", part)
        reference = self._table("reference", [part if first_batch else base.reference])
        sizes = None if self.mode.new_axis else axis_sizes(manifest.dims, self.mode.axis)
        jobs = [partial(self._write, axis_table(new, self.mode, sizes, base.granules, base.axis_size,
                                                prefix=self.prefix), "axis", part)]
        if self.gate:
            jobs.append(partial(compat_gate, self._only(manifest, new), new,
                                None if self.mode.new_axis else self.mode.axis, order,
                                reference=reference))
        together(self.spark, *jobs)

        index = self._table("axis", [part])
        role = small_side(roles(reference, self.mode))
        place = hashed_side(index.select("granule_id", "ordinal", "axis_offset", "axis_size"))
        ids = place.select("granule_id")
        # Only the first batch has granule 0, whose dimensions are kept.
        zero = index.where(F.col("ordinal") == 0).first() if first_batch else None
        tables = {
            "chunk_refs": combine_chunks(manifest.chunk_refs, role, place, self.mode),
            "coord_values": combine_coord_values(manifest.coord_values, role, place, self.mode),
            "attrs": attr_summary(manifest.attrs.join(ids, "granule_id", "left_semi")),
            "dims": manifest.dims.where(F.col("granule_id") == zero["granule_id"] if zero else F.lit(False))
            .select("dim", "size")}
        together(self.spark, *[partial(self._write, table, name, part) for name, table in tables.items()])
        added = index.agg(F.count(F.lit(1)), F.sum("axis_size")).first()
        self._commit(base, part, batch_id, added[0], added[1])
        return added[0]

    def _new(self, granules: DataFrame, base: Version) -> DataFrame:
        """Arrivals that are not stored, with what the axis needs; of a repeated granule the first one."""
        order = [*self.prefix, "search_rank"]
        known = "begin" in granules.columns
        rows = granules if known else granule_fields(granules)
        # Only these columns are moved, not the whole records of the search.
        columns = dict.fromkeys(["granule_id", *order, "begin" if known else "begin_raw",
                                 *[c for c in axis_inputs(self.mode) if c != "begin"]])
        rows = rows.groupBy("granule_id").agg(
            F.min_by(F.struct(*columns), F.struct(*order)).alias("row")).select("row.*")
        if not known:
            rows = rows.withColumn("begin", utc_timestamp(F.col("begin_raw")))
        if base.granules == 0:
            return rows
        stored = self._table("axis", base.filled).select("granule_id")
        # The arrivals are few beside the store: the store is scanned, not shuffled.
        ids = granules.select("granule_id")
        if fits(ids):
            stored = stored.join(F.broadcast(ids), "granule_id", "left_semi")
        return rows.join(stored, "granule_id", "left_anti")

    @staticmethod
    def _only(manifest: Manifest, granules: DataFrame) -> Manifest:
        ids = granules.select("granule_id")
        # The gate asks for these granules only; without a broadcast, its counts move fewer rows than a join.
        if not fits(ids):
            return manifest
        return manifest.with_(variables=manifest.variables.join(F.broadcast(ids), "granule_id", "left_semi"))

    def _write(self, table: DataFrame, name: str, part: str) -> None:
        table.write.option("compression", "zstd").parquet(f"{self.root}/{name}/{part}")

    def _commit(self, base: Version, part: str, batch_id: int, granules: int, axis_size: int) -> None:
        row = local_frame(self.spark, [(batch_id, granules, axis_size)], _COMMITS)
        self._write(row.coalesce(1), "commits", part)
        now = Version(base.number + 1, batch_id, base.granules + granules, base.axis_size + axis_size,
                      base.reference or (part if granules else None),
                      (*base.parts, Part(part, 0, granules > 0)))
        self.log.publish(now)
        self._compact(now)

    def _compact(self, now: Version) -> None:
        """Merge full tiers, all by one version. A merge that another writer overtakes is given up."""
        old, level = full_tiers(now.parts, self.fan)
        if not old:
            return
        merged = Part(uuid.uuid4().hex, level, any(p.filled for p in old))
        # Small files of several parts are read together, so merged parts have fewer files, without a shuffle.
        self._write(self._table("commits", [p.name for p in old]).coalesce(1), "commits", merged.name)
        for name in _TABLES if merged.filled else ():
            self._write(self._table(name, [p.name for p in old if p.filled]), name, merged.name)
        try:
            self.log.publish(replace(now, number=now.number + 1, parts=(*now.parts[:-len(old)], merged)))
        except ConflictingWriter:
            return

    def read(self) -> Dataset:
        """The dataset as of the newest version."""
        now = self.log.latest()
        if now is None or not now.granules:
            raise ValueError(f"nothing stored in {self.root}")

        def table(name: str) -> DataFrame:
            return self._table(name, now.filled)

        length = F.lit(now.axis_size).cast("bigint")
        axis = self.mode.axis
        reference = self._table("reference", [now.reference])
        dims = table("dims").select("dim", F.when(F.col("dim") == axis, length)
                                    .otherwise(F.col("size")).alias("size"))
        if self.mode.new_axis:
            dims = dims.unionByName(local_frame(self.spark, [(axis, now.axis_size)], "dim STRING, size BIGINT"))
        return Dataset(
            dims=dims,
            variables=combined_variables(reference, roles(reference, self.mode), self.mode, length),
            attrs=with_axis_attrs(merge_attrs(table("attrs")), self.mode),
            chunk_refs=table("chunk_refs"), coord_values=table("coord_values"),
            axis=table("axis"), axis_name=axis)

    def append_stream(self, arrivals: DataFrame, manifest_for: Callable[[DataFrame], Manifest],
                      checkpoint: str) -> DataStreamWriter:
        """A writer that appends each micro-batch of arriving granules.

        ``manifest_for`` gives the manifest of a batch of granules: it reads their files, or takes
        their rows from manifest tables.
        """
        def each(batch: DataFrame, batch_id: int) -> None:
            self.append(manifest_for(batch), batch, batch_id)

        return (arrivals.writeStream.foreachBatch(each)
                .option("checkpointLocation", checkpoint))
