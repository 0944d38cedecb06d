import datetime as dt
import random

import pytest
from conftest import granule, granules, rows
from pyspark.sql import functions as F

from chunkatlas.functions import granule_fields
from chunkatlas.operators.ordering import assign_batches, first_k, with_ordinal
from chunkatlas.operators import overlap as overlap_module
from chunkatlas.operators.overlap import overlap_pairs, range_bins
from chunkatlas.schemas import SEARCH_SPECS
from chunkatlas.session import local_frame
from chunkatlas.sources import catalog as catalog_module
from chunkatlas.sources.catalog import direct_links, guard, search, search_specs


@pytest.fixture
def catalog(spark):
    return granules(spark, [
        granule("g0", 0, "2022-01-01T00:00:00Z", "2022-01-01T12:00:00Z", name="C_PA_0.nc"),
        granule("g1", 1, "2022-01-02T00:00:00Z", None, name="C_PA_1.nc"),
        granule("g2", 2, "2022-01-03T00:00:00", None, name="C_PB_2.nc"),
        granule("g3", 3, "2022-01-03T00:00:00Z", None, collection="D", name="C_PA_3.nc")])


def test_search(catalog):
    assert rows(search(catalog, "C"), "granule_id") == [("g0",), ("g1",), ("g2",)]
    assert rows(search(catalog, "C", "1-2-2022", "1-2-2022"), "granule_id") == [("g1",)]
    assert rows(search(catalog, "C", None, "2022-01-01"), "granule_id") == [("g0",)]
    assert rows(search(catalog, "X"), "granule_id") == []


def test_specs_append_and_keep_duplicates(catalog):
    specs = [{"short_name": "C", "granule_name": "*_PB_*", "temporal": ("2022-01-01", "2023-01-01")},
             {"short_name": "C", "granule_name": "C*", "temporal": ("2022-01-02", "2022-01-03")}]
    found = with_ordinal(search_specs(catalog, specs), prefix=["spec_no"])
    assert rows(found, "ordinal", "granule_id", "spec_no") == [
        (0, "g2", 0), (1, "g1", 1), (2, "g2", 1)]


def test_many_specs_meet_by_bins(spark, monkeypatch):
    draw = random.Random(7)
    day = dt.date(2021, 12, 1)

    def date(n):
        return (day + dt.timedelta(days=n)).isoformat()

    found = []
    for i in range(60):
        begin = draw.choice([None, *range(60)])
        end = draw.choice([None, *range(begin or 0, 70)])
        found.append(granule(f"g{i}", i, begin is not None and date(begin) + "T05:00:00Z" or None,
                             end is not None and date(end) + "T04:00:00Z" or None,
                             collection=draw.choice("CCD"), name=draw.choice(["ab", "a_", "abc", "b", "", "é"]) + f"{i}.nc"))
    found.append(granule("old", 60, "1850-01-01T00:00:00Z", "2100-01-01T00:00:00Z", name="ab"))
    found.append(granule("reversed", 61, "2022-01-20T00:00:00Z", "2022-01-02T00:00:00Z", name="ab"))
    table = granules(spark, found)
    specs = [(draw.choice("CCDE"), i, draw.choice("CCD"), draw.choice(["*", "a*", "ab?*", "?b*.nc", "ab1.nc", "a_*", "é*", "", None]),
              draw.choice([None, day + dt.timedelta(days=draw.randrange(60))]),
              draw.choice([None, day + dt.timedelta(days=draw.randrange(60))])) for i in range(80)]
    specs += [("C", 80, "C", "ab", dt.date(1800, 1, 1), dt.date(1850, 1, 1)),
              ("C", 81, "C", "ab", dt.date(2099, 1, 1), dt.date(2200, 1, 1))]
    frame = local_frame(spark, specs, SEARCH_SPECS)
    monkeypatch.setattr(catalog_module, "DIRECT", 10 ** 6)
    plain = rows(search_specs(table, frame), "spec_no", "granule_id")
    monkeypatch.setattr(catalog_module, "DIRECT", 0)
    binned = search_specs(table, frame)
    assert rows(binned, "spec_no", "granule_id") == plain
    assert len(set(plain)) == len(plain) > 300
    assert search_specs(table, frame.limit(0)).columns == binned.columns
    assert rows(search_specs(table.limit(0), frame)) == []


def test_globs_meet_by_their_ends(spark, monkeypatch):
    """Names meet only globs whose beginning, end and length fit; the work on pairs is spread over tasks."""
    names = ["", "a", "?", "*", "ab", "a?b", "axb", "a*b", "abab", "aéb", "a\U0001f600b", "ab\nab", "a_7_x.nc", "a_17_x.nc"]
    globs = ["", "*", "**", "?", "a*", "*b", "a?b", "a?*?b", "a*b*", "*b*a*", "ab*ab", "a*7_?.nc", "?*", "a\U0001f600?", None]
    table = granules(spark, [granule(f"g{i}", i, "2022-01-01T00:00:00Z", name=n) for i, n in enumerate(names)])
    frame = local_frame(spark, [("C", i, "C", g, None, None) for i, g in enumerate(globs)], SEARCH_SPECS)
    monkeypatch.setattr(catalog_module, "DIRECT", 10 ** 6)
    plain = rows(search_specs(table, frame), "spec_no", "name")
    monkeypatch.setattr(catalog_module, "DIRECT", 0)
    binned = search_specs(table.coalesce(1), frame)
    assert rows(binned, "spec_no", "name") == plain
    assert binned.rdd.getNumPartitions() > 1
    left = table.withColumns({"_low": F.lit(9), "_high": F.lit(9)})
    right = frame.drop("collection").withColumnRenamed("short_name", "collection").withColumns({
        "_from": F.lit(0), "_to": F.lit(99)})
    pairs = overlap_pairs(left, right, "collection", "name", "granule_glob")
    assert rows(pairs.where("NOT _open"), "spec_no", "name") == [p for p in plain if p[0] not in (8, 9)]


def moved_rows(plan):
    """Rows written by all exchanges of a plan that was run."""
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return moved_rows(plan.executedPlan())
    if "QueryStage" in plan.nodeName():
        return moved_rows(plan.plan())
    below = sum(moved_rows(plan.children().apply(i)) for i in range(plan.children().size()))
    return below + (plan.metrics().apply("shuffleRecordsWritten").value() if plan.nodeName() == "Exchange" else 0)


def test_granules_do_not_move_once_per_bin(spark, monkeypatch):
    """Where specs are too many to be broadcast, a granule moves a few times, however its days are cut."""
    draw = random.Random(5)
    day = dt.date(2021, 1, 1)

    def date(n):
        return day + dt.timedelta(days=n)

    found = []
    for i in range(400):
        begin = draw.randrange(1000)
        found.append(granule(f"g{i}", i, f"{date(begin)}T05:00:00Z", f"{date(begin + draw.randrange(30))}T04:00:00Z",
                             name=f"{draw.choice('abcd')}_{i}.nc"))
    found += [granule("long", 400, "1850-01-01T00:00:00Z", "2100-01-01T00:00:00Z", name="a_x.nc"),
              granule("reversed", 401, f"{date(400)}T00:00:00Z", f"{date(300)}T00:00:00Z", name="b_x.nc"),
              granule("never", 402, None, None, name="a_y.nc")]
    table = granules(spark, found)
    specs = []
    for i in range(150):
        low = draw.randrange(1000)
        specs.append(("C", i, "C", draw.choice(["a*", "b*", "?_1*.nc", "x*"]), draw.choice([None, *[date(low)] * 6]),
                      draw.choice([None, *[date(low + draw.choice([-50, 0, 30, 200]))] * 6])))
    specs += [("C", 150 + i, "C", "a_*", date(100), date(500)) for i in range(40)]
    frame = local_frame(spark, specs, SEARCH_SPECS)
    monkeypatch.setattr(catalog_module, "DIRECT", 10 ** 6)
    plain = rows(search_specs(table, frame), "spec_no", "granule_id")
    monkeypatch.setattr(catalog_module, "DIRECT", 0)
    monkeypatch.setattr(overlap_module, "BROADCAST_ROWS", 0, raising=False)
    monkeypatch.setattr(overlap_module, "small_side", lambda df: df if "_bin" in df.columns else F.broadcast(df))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = search_specs(table, frame).select("spec_no", "granule_id")
        assert rows(pairs) == plain
        assert len(set(plain)) == len(plain) > 2000
        # One move spreads the granules' file, one meets the specs.
        assert moved_rows(pairs._jdf.queryExecution().executedPlan()) < 6 * len(found) + 30 * len(specs)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_bins_are_disjoint_and_complete(spark):
    ranges = [(0, 0), (0, 65535), (1, 1), (3, 12), (5, 4), (65535, 65535), (7, 40000)]
    table = spark.createDataFrame(ranges, "a INT, b INT")
    for row in table.withColumn("bins", range_bins("a", "b")).collect():
        days = [d for x in row["bins"] for d in range(x["bin"] << x["level"], (x["bin"] + 1) << x["level"])]
        assert sorted(days) == list(range(row["a"], row["b"] + 1))


def test_fields(catalog):
    got = granule_fields(catalog).where("granule_id = 'g0'").first()
    assert (got["begin_raw"], got["cycle"], got["ppass"]) == ("2022-01-01T00:00:00Z", 1, 2)


def test_no_pass(spark):
    table = granules(spark, [granule("g", 0, "2022-01-01T00:00:00Z", passes=())])
    assert granule_fields(table).first()["ppass"] is None


def test_guard(spark, catalog):
    assert rows(guard(search(catalog, "C"))) == [("ok", None, 3, 3)]
    assert rows(guard(search(catalog, "X"))) == [("empty", "no granules found", 0, 0)]
    bare = granules(spark, [granule("g", 0, "2022-01-01T00:00:00Z", links=[])])
    assert rows(guard(bare)) == [("empty", "no links found", 1, 0)]
    with pytest.raises(Exception, match="no direct link"):
        direct_links(bare).collect()


def test_batches(spark):
    links = spark.createDataFrame([(i * 3, f"s3://{'x-wide' if i == 4 else 'b'}/{i}")
                                   for i in range(10)], "search_rank BIGINT, url STRING")
    got = assign_batches(links, [("wide", "W")], "P", size=4)
    assert rows(got, "search_rank", "batch_no", "batch_total", "provider", "batch_provider") == sorted(
        [(i * 3, i // 4 + 1, 3, "W" if i == 4 else "P", "W" if 4 <= i < 8 else "P")
         for i in range(10)], key=repr)


def test_first_k(spark):
    table = spark.createDataFrame([(i % 3, i) for i in range(30)], "k INT, n INT")
    assert rows(first_k(table, 2, ["n"], ["k"]), "n") == [(n,) for n in range(6)]
    assert rows(first_k(table, 3, ["n"]), "n") == [(0,), (1,), (2,)]
    plan = first_k(table, 2, ["n"], ["k"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
