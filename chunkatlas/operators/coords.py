"""Which variables are coordinates, by the attributes that name them.

A variable that bears the name of its own dimension is a coordinate, which a reader knows from the
variable alone. Auxiliary coordinates, such as a latitude over two dimensions, are named by the
``coordinates`` attribute of other variables or of the whole file. One that is named makes those
that it names coordinates too; as every name counts, whoever gives it, no step by step walk is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the attribute that lists auxiliary coordinates, separated by blanks.
COORDINATES = "coordinates"


def named_coordinates(attrs: DataFrame) -> DataFrame:
    """``granule_id, var`` of each name that some ``coordinates`` attribute of the granule lists.

    Values that are no text name nothing; names of variables that do not exist are kept.
    """
    text = F.get_json_object(F.concat(F.lit('{"v":'), "value_json", F.lit("}")), "$.v")
    names = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")
    return (attrs.where((F.col("key") == COORDINATES) & F.col("value_json").startswith('"'))
            .select("granule_id", F.explode(names).alias("var")).where("var <> ''").distinct())


def with_auxiliary(variables: DataFrame, attrs: DataFrame) -> DataFrame:
    """The variables, with ``is_coord`` also for those that their granule's attributes name.

    Only the attributes of granules in ``variables`` are looked at: for granule 0 alone, a few rows.
    """
    ids = variables.select("granule_id").distinct()
    named = named_coordinates(attrs.join(ids, "granule_id", "left_semi")).withColumn("_named", F.lit(True))
    is_coord = F.coalesce("is_coord", F.lit(False)) | F.coalesce("_named", F.lit(False))
    return (variables.join(named, ["granule_id", "var"], "left").withColumn("is_coord", is_coord)
            .select(*variables.columns))
