import pytest
from conftest import granule, granules, manifest, rows, variable
from pyspark.sql import functions as F

from chunkatlas import session
from chunkatlas.operators import combine as combine_module
from chunkatlas.operators.combine import combine
from chunkatlas.operators.quality import IncompatibleGranules
from chunkatlas.plans import bindings, queries
from chunkatlas.streaming import CombinedStore
from chunkatlas.streaming import append as module
from chunkatlas.streaming.log import CommitLog, ConflictingWriter, Part, Version, full_tiers, tier

SIZES = {"g0": 2, "g1": 1, "g2": 3, "g3": 2, "g4": 1}


@pytest.fixture
def found(spark):
    return granules(spark, [granule(g, i, f"2022-01-0{9 - i}T00:00:00Z", cycle=i)
                            for i, g in enumerate(SIZES)])


@pytest.fixture
def facts(spark):
    """``v`` has the axis in ``existing`` mode; all granules are alike in the other modes."""
    def make(same_size):
        sizes = {g: 2 if same_size else n for g, n in SIZES.items()}
        variables, chunks = [], []
        for g, n in sizes.items():
            variables += [variable(g, "v", ["time"], (n,), (1,)),
                          variable(g, "lat", ["y"], (1,), (1,), coord=True),
                          variable(g, "t", ["time"], (n,), (1,), coord=True, loadable=True)]
            chunks += [(g, "v", [i], f"s3://b/{g}", i, 1, None) for i in range(n)]
            chunks += [(g, "lat", [0], f"s3://b/{g}", 0, 1, None)]
        attrs = [(g, "", "title", '"A"') for g in sizes] + [
            (g, "", "n", f"{i % 2}") for i, g in enumerate(sizes)] + [
            (g, "", "late", f"{int(g == 'g4')}") for g in sizes]
        values = [(g, "t", i, float(i)) for g, n in sizes.items() for i in range(n)]
        dims = [(g, "time", n) for g, n in sizes.items()] + [(g, "y", 1) for g in sizes]
        return manifest(spark, dims, variables, attrs, chunks, values)
    return make


def pick(found, *ids):
    return found.where(F.col("granule_id").isin(*ids))


def same(ours, theirs):
    for name, table in theirs.tables().items():
        columns = sorted(table.columns)
        assert rows(getattr(ours, name), *columns) == rows(table, *columns), name


@pytest.mark.parametrize("mode", ["existing", "seconds", "granule"])
def test_append_is_a_rebuild(spark, folder, found, facts, mode):
    m = facts(mode != "existing")
    store = CombinedStore(spark, folder, mode)
    assert store.append(m, pick(found, "g0", "g1"), 0) == 2
    assert store.append(m, pick(found, "g2"), 1) == 1
    assert store.append(m, pick(found, "g3", "g4"), 2) == 2
    same(store.read(), combine(m, found, mode))


def test_repeats_are_left_out(spark, folder, found, facts):
    m = facts(False)
    store = CombinedStore(spark, folder)
    store.append(m, pick(found, "g0", "g1"), 0)
    assert store.append(m, pick(found, "g0", "g1"), 0) == 2
    assert store.append(m, pick(found, "g0"), 1) == 0
    twice = pick(found, "g2", "g3", "g4").unionByName(pick(found, "g2", "g1"))
    assert store.append(m, twice, 2) == 3
    same(store.read(), combine(m, found))


def test_batch_that_failed_midway_is_run_again(spark, folder, found, facts, monkeypatch):
    m = facts(False)
    store = CombinedStore(spark, folder)
    store.append(m, pick(found, "g0", "g1"), 0)
    before = rows(store.read().chunk_refs)

    def broken(*args):
        raise OSError("lost")
    with monkeypatch.context() as patch:
        patch.setattr(module, "combine_coord_values", broken)
        with pytest.raises(OSError):
            store.append(m, pick(found, "g2", "g3", "g4"), 1)
    assert rows(store.read().chunk_refs) == before
    store.append(m, pick(found, "g2", "g3", "g4"), 1)
    same(store.read(), combine(m, found))


def test_parts_are_merged_in_tiers(spark, folder, found, facts):
    m = facts(False)
    store = CombinedStore(spark, folder, fan=2)
    for number, g in enumerate(SIZES):
        assert store.append(m, pick(found, g), number) == 1
        now = store.log.latest()
        levels = [part.level for part in now.parts]
        assert levels == [i for i in range(3, -1, -1) if (number + 1) >> i & 1]
    assert store.append(m, pick(found, "g0"), 7) == 0
    same(store.read(), combine(m, found))
    assert rows(store.commits(), "batch_id", "granules") == [(i, 1) for i in range(5)] + [(7, 0)]
    assert store.append(m, found, 3) == 1
    with pytest.raises(ValueError, match="batch 6"):
        store.append(m, found, 6)


def test_second_writer_is_refused(spark, folder, found, facts, monkeypatch):
    m = facts(False)
    store, other = CombinedStore(spark, folder), CombinedStore(spark, folder)
    store.append(m, pick(found, "g0"), 0)
    real = module.combine_coord_values

    def meanwhile(*args):
        monkeypatch.setattr(module, "combine_coord_values", real)
        other.append(m, pick(found, "g1"), 1)
        return real(*args)
    monkeypatch.setattr(module, "combine_coord_values", meanwhile)
    with pytest.raises(ConflictingWriter):
        store.append(m, pick(found, "g2"), 1)
    same(store.read(), combine(m, pick(found, "g0", "g1")))


def test_log(spark, folder):
    log = CommitLog(spark, f"{folder}/log")
    assert log.latest() is None
    for number in range(40):
        log.publish(Version(number, number, number, 0, None, (Part("p", 0, True),)))
    assert log.latest() == Version(39, 39, 39, 0, None, (Part("p", 0, True),))
    with pytest.raises(ConflictingWriter):
        log.publish(Version(7, 0, 0, 0, None, ()))
    assert log._read("hint")["number"] == 32
    parts: tuple = ()
    for n in range(1000):
        parts += (Part(str(n), 0, True),)
        while old := tier(parts, 8):
            parts = (*parts[:-8], Part("m", old[0].level + 1, True))
        assert len(parts) <= 7 * 4


def test_incompatible_arrivals_are_refused(spark, folder, found, facts):
    store = CombinedStore(spark, folder)
    store.append(facts(False), pick(found, "g0"), 0)
    other = facts(False)
    other = other.with_(variables=other.variables.withColumn("dtype", F.lit("<f8")))
    with pytest.raises(IncompatibleGranules):
        store.append(other, pick(found, "g1"), 1)
    assert store.read().axis.count() == 1


def test_sorted_mode_is_refused(spark, folder):
    with pytest.raises(ValueError):
        CombinedStore(spark, folder, "sorted")
    assert combine_module.SORTED.by_start


def test_stream_restarted_midway(spark, folder, found, facts):
    m = facts(False)
    store = CombinedStore(spark, f"{folder}/store")

    def run(*ids):
        pick(found, *ids).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(found.schema).parquet(f"{folder}/in")
        writer = store.append_stream(stream, lambda batch: m, f"{folder}/progress")
        writer.trigger(availableNow=True).start().awaitTermination()

    run("g0", "g1")
    run("g2")
    run("g1", "g3", "g4")
    same(store.read(), combine(m, found))


def test_merged_rows_are_written_once(spark, folder, found, facts, monkeypatch):
    """A part that fills the next tier at once is not written for the tier between."""
    parts = tuple(Part(str(i), level, True) for i, level in enumerate([2, 1, 0, 0]))
    assert full_tiers(parts, 2) == (parts, 3)
    assert full_tiers(parts[:3], 2) == ((), 0) and full_tiers((Part("x", 3, True), *parts[1:]), 2) == (parts[1:], 2)
    m, written = facts(False), []
    store = CombinedStore(spark, folder, fan=2)
    real = CombinedStore._write

    def counting(self, table, name, part):
        if name == "chunk_refs":
            written.append(table.count())
        real(self, table, name, part)
    monkeypatch.setattr(CombinedStore, "_write", counting)
    for number, g in enumerate(["g0", "g1", "g2", "g3"]):
        store.append(m, pick(found, g), number)
    # g0 brings the latitude; the last merge takes (g0 g1), g2 and g3 together.
    assert written == [3, 1, 4, 3, 2, 9]
    same(store.read(), combine(m, pick(found, "g0", "g1", "g2", "g3")))


def test_arrivals_without_their_records(spark, folder, found, facts):
    """Of the search's rows only what the axis needs is kept and moved."""
    store = CombinedStore(spark, folder)
    kept = store._new(found, Version(-1, -1, 0, 0, None, ()))
    assert sorted(kept.columns) == ["begin", "begin_raw", "granule_id", "search_rank"]
    assert rows(kept, "granule_id") == [(g,) for g in SIZES]


def tables_of_orders(spark, folder):
    """Orders and lines as the queries' tables have them; order 9 has no lines."""
    spark.sql("""select id as o_orderkey, id % 3 as o_custkey, if(id % 2 = 0, 'O', 'F') as o_orderstatus,
        id * 1.5D as o_totalprice, timestamp'1998-05-25' + make_interval(0, 0, 0, int(id)) as o_orderdate,
        '1-URGENT' as o_orderpriority from range(14)""").write.parquet(f"{folder}/orders.parquet")
    spark.sql("""select o.id as l_orderkey, l.id + o.id * 10 as l_partkey, int(l.id % 3) + 1 as l_linenumber,
        double(l.id) as l_quantity, if(o.id % 4 = 0, 'O', 'F') as l_linestatus
        from range(14) o, range(5) l where o.id <> 9""").write.parquet(f"{folder}/lineitem.parquet")


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_stream_batches_get_their_own_manifest(spark, folder, monkeypatch, limit):
    """A micro-batch costs what its granules cost, however many the tables have, by any kind of join."""
    tables_of_orders(spark, folder)
    for sized in (session.fits, session.small_side, session.hashed_side):
        monkeypatch.setattr(sized, "__defaults__", (limit, *sized.__defaults__[1:]))
    if limit == 2:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    seen, real = [], CombinedStore.append

    def watched(self, manifest, granules, batch_id):
        ids = {row[0] for row in granules.select("granule_id").collect()}
        seen.append(ids)
        for name in ("dims", "variables", "attrs", "chunk_refs"):
            assert {row[0] for row in getattr(manifest, name).select("granule_id").collect()} <= ids, name
        return real(self, manifest, granules, batch_id)
    monkeypatch.setattr(CombinedStore, "append", watched)
    try:
        ours = rows(queries.append_stream(spark, folder))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert seen == [{str(i) for i in range(7)}, {str(i) for i in range(7, 14)}]
    whole = combine(bindings.manifest_new(spark, folder), bindings.granules(spark, folder), "seconds")
    assert ours == rows(queries._chunks(whole)) and len(ours) == 13 * 3 + 14 + 1


def test_larger_sides_are_hashed_by_partition(spark):
    table = spark.range(40).withColumnRenamed("id", "k")

    def kind(rows_):
        plan = table.join(session.hashed_side(table, max_rows=rows_), "k")._jdf.queryExecution().toString()
        return next(k for k in ("BroadcastHashJoin", "ShuffledHashJoin", "SortMergeJoin") if k in plan)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [kind(n) for n in (40, 10, 9)] == ["BroadcastHashJoin", "ShuffledHashJoin", "SortMergeJoin"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_jobs_that_run_together_all_end(spark):
    done = []

    def broken():
        raise OSError("lost")
    with pytest.raises(OSError):
        session.together(spark, broken, lambda: done.append(spark.range(3).count()))
    assert done == [3]
