"""Schemas of granules as classes: interned once, compared once, expanded only where they differ.

Of many granules most have the same variables. A granule's whole schema gets an order-free
fingerprint, whose sums combine in the tasks; granules with equal fingerprints are one class. The
variables of one member stand for the class, so that granule 0 is compared with classes, which are
few, and not with granules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, small_side

#: The kinds of differences that are always told, and all there are.
BASIC = ("missing", "dtype", "shape")
KINDS = (*BASIC, "extra", "dims", "codec", "chunks")
#: The columns that make a variable's schema.
FACTS = ("var", "dims", "shape", "chunk_shape", "dtype", "codec_json")


def reference_variables(variables: DataFrame, granules: DataFrame,
                        order: Sequence[str] = ("search_rank",)) -> DataFrame:
    """The variables of granule 0: the first granule in the order given."""
    first = granules.agg(F.min_by("granule_id", F.struct(*order))).scalar()
    return variables.where(F.col("granule_id") == first)


def _half(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 16), 16, 10).cast("decimal(20,0)")


def schema_classes(variables: DataFrame, facts: Sequence[str] = FACTS) -> tuple[DataFrame, DataFrame]:
    """``members`` (granule_id, class_id) and ``classes`` (class_id, n_granules, *facts).

    The class is the number of variables and two exact sums over the halves of their MD5 hashes, so
    neither the order of variables nor that of rows matters. Granules without variables are in no
    class. ``members`` has one row per granule and is written once, as it is read twice.
    """
    digest = F.md5(F.to_json(F.struct(*facts)))
    hashed = variables.select("granule_id", _half(digest, 1).alias("a"), _half(digest, 17).alias("b"))
    members = materialize(hashed.groupBy("granule_id").agg(F.concat_ws(
        ":", F.count(F.lit(1)), F.sum("a"), F.sum("b")).alias("class_id")), "members")
    heads = members.groupBy("class_id").agg(
        F.min("granule_id").alias("granule_id"), F.count(F.lit(1)).alias("n_granules"))
    classes = variables.select("granule_id", *facts).join(small_side(heads), "granule_id")
    return members, materialize(classes.select("class_id", "n_granules", *facts), "classes")


def class_differences(classes: DataFrame, reference: DataFrame,
                      kinds: Sequence[str] = BASIC) -> DataFrame:
    """``class_id, var, kind, expected, found`` of each class against the variables of ``reference``.

    Values are JSON text; a variable that is missing or extra tells its dtype and shape. Shapes and
    chunks are compared only where the dimensions are equal.
    """
    ref = small_side(reference.select("var", F.struct(*FACTS[1:]).alias("ref")))
    known, same_dims = F.col("ref").isNotNull(), F.col("dims") == F.col("ref.dims")

    def told(kind: str, column: str, where: Column) -> Column:
        differs = known & where & ~F.col(column).eqNullSafe(F.col(f"ref.{column}"))
        return F.when(F.lit(kind in kinds) & differs, F.struct(
            F.lit(kind).alias("kind"), _text(f"ref.{column}").alias("expected"),
            _text(column).alias("found")))

    yes = F.lit(True)
    found = F.array(
        told("dtype", "dtype", yes), told("dims", "dims", yes), told("shape", "shape", same_dims),
        told("chunks", "chunk_shape", same_dims), told("codec", "codec_json", yes),
        F.when(F.lit("extra" in kinds) & ~known, F.struct(
            F.lit("extra").alias("kind"), F.lit(None).cast("string").alias("expected"),
            _brief("dtype", "shape").alias("found"))))
    pairs = classes.join(ref, "var", "left")
    out = pairs.select("class_id", "var", F.explode(F.filter(found, lambda one: one.isNotNull()))
                       .alias("one")).select("class_id", "var", "one.*")
    if "missing" not in kinds:
        return out
    # Only classes that lack something are expanded to the names of granule 0.
    needed = reference.agg(F.count(F.lit(1))).scalar()
    have = pairs.groupBy("class_id").agg(F.count_if(known).alias("n")).where(F.col("n") < needed)
    names = reference.agg(F.collect_list(F.struct("var", _brief("dtype", "shape").alias("expected")))).scalar()
    lacking = (have.select("class_id", F.explode(names).alias("one")).select("class_id", "one.*")
               .join(classes.select("class_id", "var"), ["class_id", "var"], "left_anti"))
    return out.unionByName(lacking.select(
        "class_id", "var", F.lit("missing").alias("kind"), "expected",
        F.lit(None).cast("string").alias("found")))


def _text(column: str) -> Column:
    return F.regexp_replace(F.to_json(F.array(column)), r"^\[|\]$", "")


def _brief(*columns: str) -> Column:
    return F.concat_ws(" ", *map(_text, columns))


def schema_mismatches(variables: DataFrame, granules: DataFrame,
                      order: Sequence[str] = ("search_rank",),
                      kinds: Sequence[str] = BASIC) -> DataFrame:
    """Every place whose granule differs from granule 0, with both values and both files.

    One row per place, variable and kind: ``granule_id``, the plain columns of ``order``, ``var``,
    ``kind``, ``expected``, ``found`` and, if ``granules`` has ``url``, ``url`` and ``first_url``. A
    granule found by two specs has two places. A granule without variables lacks all.
    """
    unknown = set(kinds) - set(KINDS)
    if unknown:
        raise ValueError(f"no such kinds of differences: {sorted(unknown)}")
    members, classes = schema_classes(variables)
    reference = materialize(reference_variables(variables, granules, order), "reference")
    none = F.lit("")
    differences = class_differences(classes, reference, kinds)
    if "missing" in kinds:
        differences = differences.unionByName(reference.select(
            none.alias("class_id"), "var", F.lit("missing").alias("kind"),
            _brief("dtype", "shape").alias("expected"), F.lit(None).cast("string").alias("found")))
    differences = materialize(differences, "differences")
    beside = [c for c in order if isinstance(c, str)]
    if "url" in granules.columns:
        first = granules.agg(F.min_by("url", F.struct(*order))).scalar()
        granules = granules.withColumn("first_url", first)
        beside += ["url", "first_url"]
    placed = granules.select("granule_id", *beside).join(members, "granule_id", "left").withColumn(
        "class_id", F.coalesce("class_id", none))
    # Most granules are of granule 0's class and end here.
    return placed.join(small_side(differences), "class_id").drop("class_id")
