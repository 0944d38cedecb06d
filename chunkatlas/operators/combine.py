"""Combine the manifests of many granules into one dataset.

Only positions change; no array data is read. Everything that depends on a granule (its ordinal
and its offset on the axis) is computed on the granule table and then joined to the chunk table,
and everything that depends on a variable comes from granule 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import basename, epoch_seconds, granule_fields, link
from ..schemas import Dataset, Manifest
from ..session import local_frame, materialize, small_side
from .attrs import merge_attrs
from .coords import with_auxiliary
from .ordering import order_by_start, with_ordinal, with_ordinal_sorted
from .quality import compat_gate, reference_variables


@dataclass(frozen=True)
class Mode:
    """How to combine: the axis, whether it is new, the order, and which coordinates follow it."""

    name: str
    axis: str
    new_axis: bool
    coords: tuple[str, ...] = ()
    by_start: bool = False


# Axis and coordinate names that results carry.
EXISTING = Mode("existing", "time", new_axis=False)
SECONDS = Mode("seconds", "orbit_segment_start_time", new_axis=True, coords=("lat", "lon"))
SORTED = Mode("sorted", "orbit", new_axis=True, coords=("latitude", "longitude"), by_start=True)
GRANULE = Mode("granule", "granule", new_axis=True, coords=("latitude", "longitude"))
MODES = {mode.name: mode for mode in (EXISTING, SECONDS, SORTED, GRANULE)}

# Attributes of a time axis counted in seconds.
EPOCH_ATTRS = {"units": "seconds since 1970-01-01T00:00:00", "calendar": "gregorian"}
MICRO_ATTRS = {"units": "microseconds since 1970-01-01T00:00:00", "calendar": "gregorian"}


def choose_mode(collection: str, level2: bool, special: dict[str, str] | None = None) -> Mode:
    """Level 2 collections get a new axis, in the way listed for the collection if it is listed."""
    if not level2:
        return EXISTING
    return MODES[(special or {}).get(collection, SECONDS.name)]


def axis_attrs(axis: str, values: dict[str, str] = EPOCH_ATTRS) -> list[tuple[str, str, str]]:
    """Attribute rows ``(scope, key, value_json)`` of a time axis."""
    return [(axis, key, f'"{text}"') for key, text in values.items()]


def combine_order(mode: Mode, prefix: Sequence[str] = ()) -> list:
    """Sort columns that make the first granule granule 0."""
    return order_by_start(prefix) if mode.by_start else [*prefix, "search_rank"]


def axis_table(granules: DataFrame, mode: Mode, sizes: DataFrame | None = None,
               base_ordinal: int = 0, base_offset: int = 0,
               rank: str = "search_rank", prefix: Sequence[str] = ()) -> DataFrame:
    """One row per granule in axis order: ordinal, offset, size and the coordinates of the axis.

    ``sizes`` (granule_id, axis_size) is needed for an existing axis. A new axis grows by one per
    granule.
    """
    if "begin" not in granules.columns:
        granules = granule_fields(granules)
    order = [*(("begin", "begin_raw") if mode.by_start else ()), *prefix, rank]
    rows = granules.select("granule_id", *_axis_columns(mode), *order)
    if mode.by_start:
        rows = with_ordinal_sorted(rows, order_by_start(prefix, rank), base=base_ordinal)
    elif mode.new_axis:
        rows = with_ordinal(rows, rank, prefix, base=base_ordinal)
    else:
        rows = rows.join(sizes, "granule_id", "left").withColumn(
            "axis_size", F.coalesce("axis_size", F.lit(0)).cast("bigint"))
        return with_ordinal(rows, rank, prefix, base=base_ordinal, sums={
            "axis_offset": ("axis_size", base_offset)}).drop(*order)
    return rows.drop(*order).withColumns({
        "axis_offset": F.col("ordinal") - base_ordinal + base_offset,
        "axis_size": F.lit(1).cast("bigint")})


def _axis_columns(mode: Mode) -> list[Column]:
    if mode.name == SECONDS.name:
        return [epoch_seconds(F.col("begin_raw")).alias("start")]
    if mode.name == SORTED.name:
        return [F.col("begin").alias("start")]
    if mode.name == GRANULE.name:
        return [F.col("begin").alias("orbit"), F.col("cycle"), F.col("ppass"),
                basename(link(F.col("links"), "https")).alias("filename")]
    return []


def axis_inputs(mode: Mode) -> list[str]:
    """The columns of granules that ``_axis_columns`` reads."""
    return {SECONDS.name: ["begin_raw"], SORTED.name: ["begin", "begin_raw"],
            GRANULE.name: ["begin", "cycle", "ppass", "links"]}.get(mode.name, [])


def axis_sizes(dims: DataFrame, axis: str) -> DataFrame:
    """Length of the axis per granule, which has each of its dimensions once."""
    return dims.where(F.col("dim") == axis).select("granule_id", F.col("size").alias("axis_size"))


def roles(reference: DataFrame, mode: Mode) -> DataFrame:
    """What happens to each variable of granule 0.

    ``shift``: it has the axis and moves along it. ``stack``: it gets the new axis. ``spread``: a
    data variable without the existing axis gets it, its chunks repeated for each step of the
    granule. ``first``: taken from granule 0 unchanged, as all coordinates without the axis are.
    """
    at = F.array_position("dims", F.lit(mode.axis)).cast("int") - 1
    follows = ~F.coalesce("is_coord", F.lit(False))
    if mode.coords:
        follows = follows | F.col("var").isin(*mode.coords)
    if mode.new_axis:
        role = F.when(follows, "stack").otherwise("first")
    else:
        role = F.when(at >= 0, "shift").when(follows, "spread").otherwise("first")
    inner = F.aggregate("shape", F.lit(1).cast("bigint"), lambda a, n: a * n)
    return reference.select(
        "var", role.alias("role"), F.when(at >= 0, at).alias("at"),
        F.when(at >= 0, F.get("chunk_shape", at)).alias("chunk_len"),
        # Values of one step along the axis, for coordinates kept as values.
        F.when(at == 0, inner / F.greatest(F.get("shape", at), F.lit(1))).otherwise(inner)
        .cast("bigint").alias("step"))


def _placed(rows: DataFrame, role: DataFrame, index: DataFrame) -> DataFrame:
    """Rows of the variables that are kept, with role, ordinal and offset beside them."""
    first = index.where(F.col("ordinal") == 0).select("granule_id").limit(1).scalar()
    # Dropped before the join with the axis, which may have to shuffle.
    kept = rows.join(role, "var").where(
        (F.col("role") != "first") | (F.col("granule_id") == first))
    return kept.join(index, "granule_id").where(
        (F.col("role") != "first") | (F.col("ordinal") == 0))


def _stepped(rows: DataFrame, mode: Mode | None) -> DataFrame:
    """Rows with ``_step``, one for each step of the granule if they are spread. A new axis spreads none."""
    if mode is not None and mode.new_axis:
        return rows.withColumn("_step", F.lit(0).cast("bigint"))
    step = F.when(F.col("role") == "spread",
                  F.when(F.col("axis_size") > 0, F.sequence(F.lit(0), F.col("axis_size") - 1))
                  .otherwise(F.array().cast("array<bigint>"))).otherwise(
                      F.array(F.lit(0).cast("bigint")))
    return rows.withColumn("_step", F.explode(step))


def combine_chunks(chunk_refs: DataFrame, role: DataFrame, index: DataFrame,
                   mode: Mode | None = None) -> DataFrame:
    """Chunk rows with indices that count over the whole axis.

    A granule that would begin within a chunk has no index of its own, so it ends the job. ``mode``, that
    of ``role``, tells what need not be looked for.
    """
    rows = _stepped(_placed(chunk_refs, role, index), mode)
    whole = F.when(F.col("axis_offset") % F.col("chunk_len") == 0, F.expr("axis_offset div chunk_len")
                   ).otherwise(F.raise_error(F.concat(
                       F.lit("a partial chunk of "), "var", F.lit(" lies before granule "),
                       "granule_id")).cast("bigint"))
    shifted = F.transform("chunk_idx", lambda i, n: F.when(
        n == F.col("at"), i + whole).otherwise(i))
    # One dimension is the usual case, and compiled code does it several times faster.
    alone = (F.col("at") == 0) & (F.size("chunk_idx") == 1)
    shifted = F.when(alone, F.array(F.get("chunk_idx", F.lit(0)) + whole)).otherwise(shifted)
    leading = F.concat(F.array(F.col("axis_offset") + F.col("_step")), F.col("chunk_idx"))
    idx = (F.when(F.col("role") == "shift", shifted)
           .when(F.col("role") == "first", F.col("chunk_idx")).otherwise(leading))
    return rows.select("granule_id", "var", idx.alias("chunk_idx"), "url", "offset", "length",
                       *[c for c in ("inline_text",) if c in chunk_refs.columns])


def combine_coord_values(values: DataFrame, role: DataFrame, index: DataFrame,
                         mode: Mode | None = None) -> DataFrame:
    """Values of loaded coordinates at their positions in the combined variable."""
    leads = F.when((F.col("role") == "shift") & (F.col("at") != 0), F.raise_error(F.concat(
        F.lit("a loaded coordinate must lead with the axis: "), F.col("var"))).cast("bigint"))
    moved = F.coalesce(leads, F.when(F.col("role") == "first", F.col("pos")).otherwise(
        F.col("pos") + (F.col("axis_offset") + F.col("_step")) * F.col("step")))
    return (_stepped(_placed(values, role, index), mode)
            .select("granule_id", "var", moved.alias("pos"), "value"))


def combined_variables(reference: DataFrame, role: DataFrame, mode: Mode,
                       axis_length: Column) -> DataFrame:
    """The variables of granule 0 with the shapes they have in the combined dataset."""
    lead = F.col("role").isin("stack", "spread")
    grown = F.transform("shape", lambda n, i: F.when(i == F.col("at"), F.col("_length")).otherwise(n))
    rows = reference.drop("granule_id").join(role.select("var", "role", "at"), "var")
    return rows.withColumn("_length", axis_length).select(
        "var",
        F.when(lead, F.concat(F.array(F.lit(mode.axis)), "dims")).otherwise(F.col("dims"))
        .alias("dims"),
        F.when(lead, F.concat(F.array("_length"), "shape"))
        .when(F.col("role") == "shift", grown).otherwise(F.col("shape")).alias("shape"),
        F.when(lead, F.concat(F.array(F.lit(1).cast("bigint")), "chunk_shape"))
        .otherwise(F.col("chunk_shape")).alias("chunk_shape"),
        "dtype", "codec_json", "fill_json", "is_coord", "loadable")


def combine(manifest: Manifest, granules: DataFrame, mode: Mode | str = EXISTING,
            coords: Sequence[str] | None = None, gate: bool = True, axis: str | None = None,
            prefix: Sequence[str] = ()) -> Dataset:
    """Combine the granules in search order (``sorted`` mode: by start time).

    ``coords`` replaces the mode's list of coordinates that follow a new axis, ``axis`` its axis
    name. ``gate`` raises first if the granules do not fit together.
    """
    mode = MODES[mode] if isinstance(mode, str) else mode
    if coords is not None or axis is not None:
        mode = Mode(mode.name, axis or mode.axis, mode.new_axis,
                    tuple(mode.coords if coords is None else coords), mode.by_start)
    granules = granule_fields(granules) if "begin" not in granules.columns else granules
    order = combine_order(mode, prefix)
    # Both are read several times below and are far smaller than the tables they come from.
    reference = materialize(with_auxiliary(reference_variables(manifest.variables, granules, order),
                                           manifest.attrs), "reference")
    if gate:
        compat_gate(manifest, granules, None if mode.new_axis else mode.axis, order,
                    reference=reference)
    sizes = None if mode.new_axis else axis_sizes(manifest.dims, mode.axis)
    index = materialize(axis_table(granules, mode, sizes, prefix=prefix), "axis")
    return assemble(manifest, mode, reference, index)


def assemble(manifest: Manifest, mode: Mode, reference: DataFrame, index: DataFrame) -> Dataset:
    """The combined dataset, given granule 0's variables and the axis table."""
    role = small_side(roles(reference, mode))
    place = small_side(index.select("granule_id", "ordinal", "axis_offset", "axis_size"))
    length = index.agg(F.coalesce(F.sum("axis_size"), F.lit(0)).cast("bigint")).scalar()
    first = index.where(F.col("ordinal") == 0).select("granule_id")
    dims = manifest.dims.join(F.broadcast(first), "granule_id", "left_semi").select(
        "dim", F.when(F.col("dim") == mode.axis, length).otherwise(F.col("size")).alias("size"))
    if mode.new_axis:
        dims = dims.unionByName(index.agg(
            F.lit(mode.axis).alias("dim"),
            F.coalesce(F.sum("axis_size"), F.lit(0)).cast("bigint").alias("size")))
    used = manifest.attrs.join(place.select("granule_id"), "granule_id", "left_semi")
    return Dataset(
        dims=dims,
        variables=combined_variables(reference, role, mode, length),
        attrs=with_axis_attrs(merge_attrs(used), mode),
        chunk_refs=combine_chunks(manifest.chunk_refs, role, place, mode),
        coord_values=combine_coord_values(manifest.coord_values, role, place, mode),
        axis=index, axis_name=mode.axis)


def with_axis_attrs(attrs: DataFrame, mode: Mode) -> DataFrame:
    """Add the attributes of a new time axis."""
    if mode.name == SECONDS.name:
        rows = axis_attrs(mode.axis)
    elif mode.name == SORTED.name:
        rows = axis_attrs(mode.axis, MICRO_ATTRS)
    elif mode.name == GRANULE.name:
        rows = axis_attrs("orbit", MICRO_ATTRS)
    else:
        return attrs
    added = local_frame(attrs.sparkSession, rows, "scope STRING, key STRING, value_json STRING")
    return attrs.unionByName(added)


def subset_by_start(ds: Dataset, hits: DataFrame, start: str = "start") -> Dataset:
    """The part of a combined dataset whose granules start when one of ``hits`` does.

    Axis positions stay those of the whole dataset.
    """
    wanted = small_side(hits.select(start).distinct())
    axis = ds.axis.join(wanted, start, "left_semi")
    place = small_side(axis.select("granule_id", F.lit(True).alias("_wanted")).distinct())
    along = ds.variables.where(F.array_contains("dims", F.lit(ds.axis_name))).select(
        "var", F.lit(True).alias("_along"))
    on_axis = small_side(along)

    def part(table: DataFrame) -> DataFrame:
        return (table.join(on_axis, "var", "left").join(place, "granule_id", "left")
                .where("_along is null or _wanted").select(*table.columns))

    return Dataset(ds.dims, ds.variables, ds.attrs, part(ds.chunk_refs), part(ds.coord_values),
                   axis, ds.axis_name)
