"""The metadata tables of the engine, as Spark DDL, and the two bundles made of them."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame

GRANULES = """
    granule_id STRING, collection STRING, name STRING, search_rank BIGINT,
    umm STRUCT<
        TemporalExtent: STRUCT<RangeDateTime: STRUCT<BeginningDateTime: STRING, EndingDateTime: STRING>>,
        SpatialExtent: STRUCT<HorizontalSpatialDomain: STRUCT<
            Track: STRUCT<Cycle: BIGINT, Passes: ARRAY<STRUCT<Pass: BIGINT>>>>>>,
    links ARRAY<STRUCT<access: STRING, url: STRING>>
"""
SEARCH_SPECS = ("collection STRING, spec_no INT, short_name STRING, granule_glob STRING, "
                "date_from DATE, date_to DATE")
DIMS = "granule_id STRING, dim STRING, size BIGINT"
VARIABLES = ("granule_id STRING, var STRING, dims ARRAY<STRING>, shape ARRAY<BIGINT>, "
             "chunk_shape ARRAY<BIGINT>, dtype STRING, codec_json STRING, fill_json STRING, "
             "is_coord BOOLEAN, loadable BOOLEAN")
ATTRS = "granule_id STRING, scope STRING, key STRING, value_json STRING"
#: ``inline_text`` holds the bytes of a chunk that is stored in the reference file itself.
CHUNK_REFS = ("granule_id STRING, var STRING, chunk_idx ARRAY<BIGINT>, url STRING, "
              "offset BIGINT, length BIGINT, inline_text STRING")
COORD_VALUES = "granule_id STRING, var STRING, pos BIGINT, value DOUBLE"
REFS = ("key STRING, kind STRING, url STRING, tail_json STRING, inline_text STRING, "
        "other_json STRING")
OBJECTS = ("bucket STRING, key STRING, size BIGINT, etag STRING, source_etag STRING, "
           "modified TIMESTAMP")
HOSTS = "bucket STRING, host STRING"


@dataclass(frozen=True)
class Manifest:
    """What was read from a set of granules, one row per fact and granule."""

    dims: DataFrame
    variables: DataFrame
    attrs: DataFrame
    chunk_refs: DataFrame
    coord_values: DataFrame
    errors: DataFrame | None = None

    def with_(self, **tables: DataFrame) -> Manifest:
        return replace(self, **tables)


@dataclass(frozen=True)
class Dataset:
    """One logical dataset: the same tables with indices that count over the whole axis.

    ``axis`` has one row per granule in axis order: ``ordinal``, ``granule_id``, ``axis_offset``,
    ``axis_size`` and, for a new axis, its coordinate columns.
    """

    dims: DataFrame
    variables: DataFrame
    attrs: DataFrame
    chunk_refs: DataFrame
    coord_values: DataFrame
    axis: DataFrame | None = None
    axis_name: str | None = None

    def tables(self) -> dict[str, DataFrame]:
        found = {f.name: getattr(self, f.name) for f in fields(self)}
        return {name: df for name, df in found.items() if isinstance(df, DataFrame)}
