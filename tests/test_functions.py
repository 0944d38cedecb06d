"""Column functions against the golden cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from chunkatlas import functions as fn

HOSTS = {"b-s-protected": "S", "b-s-public": "S"}
BUCKETS = ["b-s-protected", "b-s-public", "b-protected", "b-public"]


def values(spark, inputs, expression, schema="x STRING"):
    table = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,)))
                                   for i, v in enumerate(inputs)], f"i INT, {schema}")
    return [row[0] for row in table.orderBy("i").select(expression).collect()]


def test_date_sentinels(spark):
    assert values(spark, ["None", "", None, "1-1-2022", "none"], fn.is_valid_date(F.col("x"))) == [
        False, False, False, True, True]
    assert fn.temporal_range(None, "") is None
    assert fn.temporal_range("None", "1-1-2022") == (None, "1-1-2022")


def test_parse_day(spark):
    day = dt.date(2022, 1, 5)
    for text in ("1-5-2022", "01-05-2022", "2022-01-05", "2022-1-5"):
        assert values(spark, [text], fn.parse_day(F.col("x"))) == [day]
        assert values(spark, ["-"], fn.parse_day(text)) == [day]
    assert values(spark, [None, "None"], fn.parse_day(F.col("x"))) == [None, None]
    with pytest.raises(ValueError):
        fn.parse_day("5/1/2022")
    with pytest.raises(Exception, match="not a date"):
        values(spark, ["2022-13-40"], fn.parse_day(F.col("x")))


def test_window_overlap_with_last_day_included(spark):
    cases = [("2022-01-04 23:59:59", "2022-01-05 00:00:00"), ("2022-01-06 23:59:59", None),
             ("2022-01-07 00:00:00", None), ("2022-01-01 00:00:00", "2022-01-04 23:59:59")]
    begin, end = F.col("b").cast("timestamp"), F.col("e").cast("timestamp")
    got = lambda lo, hi: values(spark, cases, fn.in_window(begin, end, lo, hi),
                                "b STRING, e STRING")
    assert got("1-5-2022", "1-6-2022") == [True, True, False, False]
    assert got("1-5-2022", None) == [True, True, True, False]
    assert got("", "1-4-2022") == [True, False, False, True]
    assert got(None, None) == [True] * 4
    assert got(F.lit(None).cast("date"), F.lit(dt.date(2022, 1, 4))) == [True, False, False, True]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_seconds_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2023-07-26T00:00:00Z", "2023-07-26T00:00:00", "2023-07-26T00:00:00.900Z",
                 "1969-12-31T23:59:59.500Z", "2023-07-26", "2023-07-26T02:00:00+02:00",
                 "2023-07-26T00:00:00.123456789Z", None]
        assert values(spark, texts, fn.epoch_seconds(F.col("x"))) == [
            1690329600, 1690329600, 1690329600, -1, 1690329600, 1690329600, 1690329600, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_report_key(spark):
    at = F.timestamp_seconds(F.lit(1690329600))
    key = lambda c: fn.report_key(F.lit("reports//"), at, c)
    assert values(spark, [None, "", "own/key.csv"], key(F.col("x"))) == [
        "reports/virtual_collections_20230726T000000Z.csv",
        "reports/virtual_collections_20230726T000000Z.csv", "own/key.csv"]
    assert values(spark, ["-"], fn.report_key(F.lit("r"), at)) == [
        "r/virtual_collections_20230726T000000Z.csv"]


def test_provider_link_basename(spark):
    assert values(spark, ["s3://x-wide/a", "s3://x-WIDE/a", None],
                  fn.provider(F.col("x"), [("wide", "W")], "P")) == ["W", "P", None]
    assert values(spark, ["https://h/a/b.nc", "b.nc", "https://h/a/b.nc/", "", "/"],
                  fn.basename(F.col("x"))) == ["b.nc", "b.nc", "b.nc", "", ""]
    links = F.array(F.struct(F.lit("https").alias("access"), F.col("x").alias("url")),
                    F.struct(F.lit("https").alias("access"), F.lit("second").alias("url")))
    assert values(spark, ["u"], fn.link(links, "https")) == ["u"]
    assert values(spark, ["u"], fn.link(links, "direct", strict=False)) == [None]
    with pytest.raises(Exception, match="no direct link"):
        values(spark, ["u"], fn.link(links, "direct"))


def test_glob(spark):
    names = ["A_L2_x.nc", "AXL2_x.nc", "A_L2_x.txt", "A_L2_50%.nc", "A_L2_50a.nc", "back\\s.nc"]
    for glob, expected in [("A_L2*.nc", [1, 0, 0, 1, 1, 0]), ("*50%*", [0, 0, 0, 1, 0, 0]),
                           ("A?L2_x.nc", [1, 1, 0, 0, 0, 0]), ("*", [1] * 6), ("", [0] * 6),
                           ("back\\s*", [0, 0, 0, 0, 0, 1])]:
        wanted = [bool(e) for e in expected]
        assert values(spark, names, fn.glob_match(F.col("x"), glob)) == wanted
        assert values(spark, names, fn.glob_match(F.col("x"), F.lit(glob))) == wanted


def test_url_translation(spark):
    cases = {"s3://b-protected/a/b.nc": "https://D/b-protected/a/b.nc",
             "s3://b-s-public/x": "https://S/b-s-public/x", "s3://other/x": "https://D/other/x",
             "s3://only": "https://D/only", "s3://b/s3://c": "https://D/b/c",
             "S3://x/y": "S3://x/y", "https://x/y": "https://x/y", "": ""}
    assert values(spark, list(cases), fn.s3_to_https(F.col("x"), HOSTS, "D")) == list(cases.values())
    assert values(spark, ["s3://b/x"], fn.s3_to_https(F.col("x"), {}, "D")) == ["https://D/b/x"]


def test_text_rewrite(spark):
    cases = {"fsspec.S3FileSystem": "fsspec.HTTPFileSystem",
             "s3://b-public/x": "https://D/b-public/x", "b-public/x": "https://D/b-public/x",
             "b-public/x b-s-public/y": "b-public/x https://S/b-s-public/y",
             "s3://b-public": "s3://https://D/b-public",
             "see https://h/ b-public/x": "see https://h/ b-public/x",
             "s3://other/x": "s3://other/x", "base64:AA==": "base64:AA==", "": ""}
    got = values(spark, list(cases), fn.rewrite_text(F.col("x"), BUCKETS, HOSTS, "D"))
    assert got == list(cases.values())


def test_coord_vars(spark):
    names = lambda level2, coll: fn.coord_vars(
        F.col("x"), F.lit(level2), F.lit(coll), ["SP"], ["num_lines", "num_pixels"])
    assert values(spark, ["lat, lon,,time ", "", "\tlat\n", None], names(False, "SP")) == [
        ["lat", "lon", "time"], [], ["lat"], []]
    assert values(spark, ["lat", ""], names(True, "C")) == [[], []]
    assert values(spark, ["lat", ""], names(True, "SP")) == [["num_lines", "num_pixels"]] * 2
    assert values(spark, ["A_L2_B", "A_l2", "A_L4"], fn.is_level2(F.col("x"))) == [True, False, False]


def test_output_names(spark):
    cases = [(None, None), ("None", ""), ("1-1-2022", None), ("", "12-31-2022"),
             ("1-1-2022", "12-31-2022")]
    name = fn.output_name(F.lit("C"), F.col("s"), F.col("e"))
    assert values(spark, cases, name, "s STRING, e STRING") == [
        "C_virtual_s3.json", "C_virtual_s3.json", "C_1-1-2022_to_present_virtual_s3.json",
        "C_beginning_to_12-31-2022_virtual_s3.json", "C_1-1-2022_to_12-31-2022_virtual_s3.json"]
    names = ["C_virtual_s3.json", "C_virtual_s3_x.json", "a_virtual_s3.json_virtual_s3.json"]
    assert values(spark, names, fn.https_name(F.col("x"))) == [
        "C_virtual_https.json", "C_virtual_s3_x.json", "a_virtual_https.json_virtual_s3.json"]


def test_object_keys(spark):
    keys = ["p/A/x", "p/A/", "p/top.json", "p//x", "q/A/x", "p/A/b/c"]
    assert values(spark, keys, fn.top_folder(F.col("x"), "p/")) == ["A", "A", None, None, None, "A"]
    assert values(spark, keys, fn.not_dir(F.col("x"))) == [True, False, True, True, True, True]
    assert values(spark, ["p/A/x"], fn.reroot(F.col("x"), "p/", "d/")) == ["d/A/x"]
    assert values(spark, ["p/A/x"], fn.reroot(F.col("x"), "p/", "d//", "A")) == ["d/A/x"]


def test_chunk_key(spark):
    table = spark.createDataFrame([("v", [1, 0, 12]), ("s", [])], "v STRING, i ARRAY<BIGINT>")
    assert [r[0] for r in table.select(fn.chunk_key(F.col("v"), F.col("i"))).collect()] == [
        "v/1.0.12", "s/0"]
