"""Do granules fit together?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import Manifest
from ..session import small_side
from .classes import BASIC, reference_variables, schema_mismatches
from .ordering import first_k


class IncompatibleGranules(ValueError):
    """Granules cannot be combined with the first one."""


def dim_conflicts(dims: DataFrame, granules: DataFrame, k: int = 5,
                  order: Sequence[str] = ("search_rank",)) -> DataFrame:
    """Dimensions with more than one size; per size the granule count and the first k links.

    ``granules`` has ``granule_id``, ``url`` and the columns of ``order``. A granule that was found
    more than once counts once, at its first place.
    """
    sizes = dims.groupBy("dim", "size").agg(F.count(F.lit(1)).alias("n_granules"))
    bad = (sizes.groupBy("dim").agg(F.min("size").alias("low"), F.max("size").alias("high"))
           .where("low <> high").select("dim"))
    bad = small_side(bad)
    places = granules.groupBy("granule_id").agg(F.min(F.struct(
        F.struct(*order).alias("place"), "url")).alias("first")).select("granule_id", "first.*")
    # Only k links per size leave a task: the rank limit is applied before the exchange.
    ranked = dims.join(bad, "dim", "left_semi").join(places, "granule_id")
    samples = (first_k(ranked, k, ["place"], ["dim", "size"])
               .groupBy("dim", "size")
               .agg(F.array_sort(F.collect_list(F.struct("place", "url"))).alias("found"))
               .select("dim", "size", F.col("found.url").alias("sample_links")))
    return (sizes.join(bad, "dim", "left_semi").join(samples, ["dim", "size"])
            .withColumn("more", F.col("n_granules") > k))


def _against(variables: DataFrame, reference: DataFrame, how: str) -> DataFrame:
    """Each variable row beside the row of the same variable in granule 0, as struct ``ref``."""
    ref = reference.select("var", F.struct(
        "dims", "shape", "chunk_shape", "dtype", "codec_json").alias("ref"))
    return variables.join(small_side(ref), "var", how)


def var_mismatches(variables: DataFrame, granules: DataFrame,
                   order: Sequence[str] = ("search_rank",), extra: bool = False) -> DataFrame:
    """Differences from granule 0: ``missing``, ``dtype``, ``shape`` and, on demand, ``extra``.

    Shapes are compared only where the dimensions are equal. A granule found twice differs at both
    its places; ``schema_mismatches`` also tells the places and the values.
    """
    kinds = (*BASIC, "extra") if extra else BASIC
    return schema_mismatches(variables, granules, order, kinds).select("granule_id", "var", "kind")


def _names(order: Sequence[str | Column]) -> list[str]:
    """The columns of an order that are plain columns."""
    return [c for c in order if isinstance(c, str)]


def _without(shape: str, at: Column) -> Column:
    """The sizes but for the one at position ``at``, which counts from 1."""
    return F.concat(F.slice(shape, F.lit(1), at - 1), F.slice(shape, at + 1, F.size(shape)))


def compat_report(manifest: Manifest, granules: DataFrame, axis: str | None = None,
                  order: Sequence[str] = ("search_rank",),
                  reference: DataFrame | None = None) -> DataFrame:
    """One row per place whose granule cannot be combined with granule 0, with the counts of reasons.

    All variables of both must be the same, with equal dims, dtype, codec, chunk shape and sizes
    apart from ``axis``. On an existing axis only the last granule may end in a partial chunk.
    Codec and chunks of coordinates kept as values may differ.
    """
    if reference is None:
        reference = reference_variables(manifest.variables, granules, order)
    pairs = _against(manifest.variables, reference, "left")
    known = F.col("ref").isNotNull()
    # How a coordinate was stored does not matter once its values are held.
    held = F.coalesce("loadable", F.lit(False))
    same_shape = F.col("shape") == F.col("ref.shape")
    partial = F.lit(False)
    if axis is not None:
        at = F.array_position("dims", F.lit(axis)).cast("int")
        along, chunk = F.get("shape", at - 1), F.get("chunk_shape", at - 1)
        # The length along the axis may differ; only then are the other sizes compared one by one.
        same_shape = F.when(same_shape, True).when(at > 0, _without("shape", at).eqNullSafe(
            _without("ref.shape", at))).otherwise(False)
        partial = (at > 0) & ~held & (along % chunk != 0)
    equal = ((F.col("dims") == F.col("ref.dims")) & (F.col("dtype") == F.col("ref.dtype"))
             & (held | (F.col("codec_json").eqNullSafe(F.col("ref.codec_json"))
                        & (F.col("chunk_shape") == F.col("ref.chunk_shape")))) & same_shape)
    per_granule = pairs.groupBy("granule_id").agg(
        F.count_if(known).alias("n_known"), F.count_if(~known).alias("n_extra"),
        F.count_if(known & ~F.coalesce(equal, F.lit(False))).alias("n_different"),
        F.count_if(F.coalesce(partial, F.lit(False))).alias("n_ragged"))
    needed = reference.agg(F.count(F.lit(1))).scalar()
    place = F.struct(*order)
    last = granules.agg(F.max(place)).scalar()
    zero = F.lit(0)
    # The last place is exempt, not the granule that stands there: it may have an earlier one too.
    return (granules.select("granule_id", (place == last).alias("_last"), *_names(order))
            .join(per_granule, "granule_id", "left")
            .select("granule_id", *_names(order),
                    (needed - F.coalesce("n_known", zero)).alias("n_missing"),
                    F.coalesce("n_extra", zero).alias("n_extra"),
                    F.coalesce("n_different", zero).alias("n_different"),
                    F.when(F.col("_last"), zero)
                    .otherwise(F.coalesce("n_ragged", zero)).cast("bigint").alias("n_ragged"))
            .where("n_missing + n_extra + n_different + n_ragged > 0"))


def compat_gate(manifest: Manifest, granules: DataFrame, axis: str | None = None,
                order: Sequence[str] = ("search_rank",), strict: bool = True,
                reference: DataFrame | None = None) -> DataFrame:
    """The report; with ``strict``, an error naming the count and some granules if it has rows."""
    report = compat_report(manifest, granules, axis, order, reference)
    if strict:
        bad = report.count()
        if bad:
            some = [row["granule_id"] for row in report.select("granule_id").take(5)]
            raise IncompatibleGranules(f"cannot combine: {bad} incompatible granule(s), e.g. {some}")
    return report
