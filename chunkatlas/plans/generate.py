"""Search, extract, check, combine, write, publish and translate, as one run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coord_vars, granule_fields, https_name, is_level2, output_name, s3_to_https
from ..functions.dates import temporal_range
from ..operators.attrs import require_attrs
from ..operators.combine import choose_mode, combine, combine_order
from ..operators.quality import dim_conflicts, var_mismatches
from ..session import local_frame, materialize, small_side
from ..sinks.refs import convert_refs, write_refs_json, write_refs_parquet
from ..sinks.reports import publish
from ..sources.arrays import load_coords
from ..sources.catalog import direct_links, guard, search, search_specs
from ..sources.refs import open_refs, open_refs_parquet
from ..sources.virtualize import ATTEMPTS, Reader, virtualize


@dataclass(frozen=True)
class RunConfig:
    """One run. Rules that belong to certain collections or stores are given here, as data."""

    collection: str
    out_dir: str
    start: str | None = None
    end: str | None = None
    loadable: str = "latitude,longitude,time"
    level2: bool | None = None
    reader: Reader | str = "zarr2"
    specs: Mapping[str, Sequence[Mapping]] = field(default_factory=dict)
    modes: Mapping[str, str] = field(default_factory=dict)
    special_coords: Sequence[str] = ()
    buckets: Sequence[str] = ()
    hosts: Mapping[str, str] = field(default_factory=dict)
    default_host: str = ""
    dests: Sequence[str] = ()
    links: str = "direct"
    layout: str = "file"
    on_error: str = "fail"
    attempts: int = ATTEMPTS


STATUS = ("status STRING, reason STRING, granules BIGINT, links BIGINT, spec_override BOOLEAN, "
          "s3_file STRING, https_file STRING, dim_conflicts BIGINT, var_mismatches BIGINT")


def run(spark: SparkSession, granules: DataFrame, config: RunConfig,
        report: Callable[[str, DataFrame], None] | None = None) -> DataFrame:
    """Run all stages and return one status row.

    The results of the search, of the extraction and of the combination are tables on disk, so that
    a stage that fails can be run again alone. ``report`` receives the tables of findings.
    """
    override = config.collection in config.specs
    if override:
        found = search_specs(granules, config.specs[config.collection])
        prefix: tuple[str, ...] = ("spec_no",)
    else:
        found = search(granules, config.collection,
                       *(temporal_range(config.start, config.end) or (None, None)))
        prefix = ()
    found = materialize(found, "found")
    state = guard(found, config.links).first()
    if state["status"] != "ok":
        return local_frame(spark, [(state["status"], state["reason"], state["granules"],
                                       state["links"], override, None, None, 0, 0)], STATUS)

    coll = F.lit(config.collection)
    level2 = is_level2(coll) if config.level2 is None else F.lit(config.level2)
    args = [F.lit(v).cast("string") for v in (config.start, config.end)]
    plan = spark.range(1).select(
        level2.alias("level2"),
        coord_vars(F.lit(config.loadable), level2, coll, list(config.modes),
                   config.special_coords).alias("coords"),
        output_name(coll, *args).alias("s3"),
        https_name(output_name(coll, *args)).alias("https")).first()

    linked = direct_links(found, config.links)
    # A granule that two specs found is read once and placed twice.
    manifest = virtualize(spark, linked.select("granule_id", F.col("url").alias("path")).distinct(),
                          config.reader, attempts=config.attempts, on_error=config.on_error)
    if config.on_error == "quarantine":
        failed = materialize(manifest.errors, "errors")
        ids = small_side(failed.select("granule_id").distinct())
        found, linked = (t.join(ids, "granule_id", "left_anti") for t in (found, linked))
        if report:
            report("errors", failed)
    if plan["coords"]:
        manifest = load_coords(manifest, plan["coords"])
    conflicts = dim_conflicts(manifest.dims, linked, order=[*prefix, "search_rank"])
    mode = choose_mode(config.collection, plan["level2"], dict(config.modes))
    mismatches = var_mismatches(manifest.variables, granule_fields(found),
                                combine_order(mode, prefix))
    counts = conflicts.count(), mismatches.count()
    if report:
        report("dim_conflicts", conflicts)
        report("var_mismatches", mismatches)

    ds = combine(manifest, found, mode, prefix=prefix)
    require_attrs(ds.attrs)
    s3_file, https_file = (f"{config.out_dir.rstrip('/')}/{plan[kind]}" for kind in ("s3", "https"))
    # Links that are HTTPS already need no second file.
    first = https_file if config.links == "https" else s3_file
    tables = first.removesuffix(".json") + ".parquet"
    write_refs_parquet(ds, tables, "overwrite")
    write_refs_json(open_refs_parquet(spark, tables), first, layout=config.layout)
    if open_refs(spark, first, "lines").variables.isEmpty():
        raise ValueError(f"{first} opens without variables")
    if first != https_file:
        convert_refs(spark, first, https_file, buckets=config.buckets, hosts=config.hosts,
                     default_host=config.default_host, overwrite=True, layout="lines",
                     out_layout=config.layout)
    published = publish(spark, config.out_dir, config.dests, f"{config.collection}/")
    lost = published.where(~F.coalesce("ok", F.lit(False))).count()
    return local_frame(spark, [("ok", f"{lost} not published" if lost else None,
                                state["granules"], state["links"], override,
                                None if config.links == "https" else s3_file, https_file,
                                *counts)], STATUS)


def translate(spark: SparkSession, arg: str, dst: str | None = None, *, buckets: Sequence[str],
              hosts: Mapping[str, str], default_host: str, overwrite: bool = False) -> str:
    """A single object-store URL is translated and returned; anything else is a file to convert."""
    if arg.startswith("s3://"):
        return spark.range(1).select(s3_to_https(F.lit(arg), hosts, default_host)).first()[0]
    return convert_refs(spark, arg, dst, buckets=buckets, hosts=hosts, default_host=default_host,
                        overwrite=overwrite)
