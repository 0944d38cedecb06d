"""Metadata tables derived from the given test tables.

Orders stand for granules, order lines for chunks, parts for dimensions, variables and attributes,
customers and suppliers for stored objects, documents and pages for reference entries. Every
binding covers its whole tables. Each has the same definition in SQL in ``oracles.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import COORD_VALUES, Manifest
from ..session import hashed_side, local_frame

HOSTS = {"b-src1": "h-one", "b-src2": "h-two"}
DEFAULT_HOST = "h-all"
BUCKETS = ["b-src1", "b-src2", "b-src3"]
PROVIDERS = [("b-f", "FIRST"), ("b-o", "OTHER")]
DEFAULT_PROVIDER = "REST"
SPLIT_DAY = "1998-06-01"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def granule_id(key: str) -> Column:
    return F.col(key).cast("string").alias("granule_id")


def granules(spark: SparkSession, sf_dir: str, days: Column | int = 0) -> DataFrame:
    """Orders as granules that last six hours, or some days more."""
    orders = load(spark, sf_dir, "orders")
    digit = F.substring("o_orderpriority", 1, 1)
    level = F.when(digit.isin("1", "2"), "_L2").otherwise("_L4")
    coll = F.concat(F.lit("C"), digit, level)
    name = F.concat(coll, F.lit("_"), "o_orderkey", F.lit("_"), F.lower("o_orderstatus"),
                    F.lit(".nc"))
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    days = days if isinstance(days, Column) else F.lit(days)
    end = F.col("o_orderdate") + F.make_dt_interval(days.cast("int"), F.lit(6))
    direct = F.concat(F.lit("s3://b-"), F.lower("o_orderstatus"), F.lit("/"), name)
    return orders.select(
        granule_id("o_orderkey"), coll.alias("collection"), name.alias("name"),
        F.col("o_orderkey").alias("search_rank"),
        F.struct(
            F.struct(F.struct(F.date_format("o_orderdate", iso).alias("BeginningDateTime"),
                              F.date_format(end, iso).alias("EndingDateTime"))
                     .alias("RangeDateTime")).alias("TemporalExtent"),
            F.struct(F.struct(F.struct(
                F.col("o_custkey").alias("Cycle"),
                F.array(F.struct(F.dayofyear("o_orderdate").cast("bigint").alias("Pass")))
                .alias("Passes")).alias("Track")).alias("HorizontalSpatialDomain"))
            .alias("SpatialExtent")).alias("umm"),
        F.array(F.struct(F.lit("direct").alias("access"), direct.alias("url")),
                F.struct(F.lit("https").alias("access"),
                         F.concat(F.lit("https://h/"), name).alias("url"))).alias("links"))


def customer_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A search spec per customer, every third for one collection; some bounds are open."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    coll = F.when(key % 3 == 0, "C1_L2").otherwise(F.concat(F.lit("C"), key % 3 + 2, F.lit("_L4")))
    start = F.date_add(F.lit("1992-01-01").cast("date"), (key % 2400).cast("int"))
    return load(spark, sf_dir, "customer").select(
        key.cast("int").alias("spec_no"), coll.alias("short_name"),
        F.when(key % 5 == 0, F.concat(F.lit("C*"), key % 100, F.lit("_?.nc")))
        .otherwise(F.concat(coll, F.lit("_"), key % 50, F.lit("*"))).alias("granule_glob"),
        F.when(nation > 1, start).alias("date_from"),
        F.when(nation < 23, F.date_add(start, (key % 400).cast("int"))).alias("date_to"))


def _dealt(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Rows by granule, moved once: neither groups by granule nor a join with granules moves them again.

    ``ids`` leaves those of its granules; a join that has to move rows deals them by granule itself.
    """
    if ids is None:
        return rows.repartition("granule_id")
    return rows.join(ids, "granule_id", "left_semi")


def _line_chunks(lines: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One chunk per order, line status and line number."""
    dealt = _dealt(lines.select(granule_id("l_orderkey"), "l_linestatus", "l_linenumber", "l_partkey",
                                "l_quantity"), ids)
    return dealt.groupBy("granule_id", "l_linestatus", "l_linenumber").agg(
        F.min("l_partkey").alias("offset"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("length")).select(
            "granule_id", F.concat(F.lit("v_"), "l_linestatus").alias("var"),
            F.array(F.col("l_linenumber").cast("bigint") - 1).alias("chunk_idx"),
            file_url("granule_id"), "offset", "length", F.lit(None).cast("string")
            .alias("inline_text"))


def file_url(key: str) -> Column:
    return F.concat(F.lit("s3://b/"), F.col(key), F.lit(".nc")).alias("url")


def _order_chunks(orders: DataFrame, names: list[str], ids: DataFrame | None = None) -> DataFrame:
    """One chunk of each named variable per order, dealt by granule as the chunks of lines are."""
    dealt = _dealt(orders.select(granule_id("o_orderkey"), F.col("o_custkey").alias("offset"),
                                 F.floor("o_totalprice").alias("length")), ids)
    return dealt.select(
        "granule_id", F.explode(F.array(*map(F.lit, names))).alias("var"),
        F.array(F.lit(0).cast("bigint")).alias("chunk_idx"), file_url("granule_id"),
        "offset", "length", F.lit(None).cast("string").alias("inline_text"))


def _variables(sized: DataFrame, rows: list[tuple[str, str, Column, Column, bool]]) -> DataFrame:
    """Variable rows of every granule, from ``(var, dim, size, chunk size, is_coord)``."""
    each = F.explode(F.array(*[F.struct(
        F.lit(var).alias("var"), F.array(F.lit(dim)).alias("dims"),
        F.array(size.cast("bigint")).alias("shape"), F.array(chunk.cast("bigint"))
        .alias("chunk_shape"), F.lit(coord).alias("is_coord"))
        for var, dim, size, chunk, coord in rows]))
    return sized.select("granule_id", each.alias("one")).select(
        "granule_id", "one.var", "one.dims", "one.shape", "one.chunk_shape",
        F.lit("<f4").alias("dtype"),
        F.lit('{"compressor":null,"filters":null,"order":"C"}').alias("codec_json"),
        F.lit("null").alias("fill_json"), "one.is_coord", F.lit(False).alias("loadable"))


def order_attrs(orders: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    rows = orders.select(granule_id("o_orderkey"), "o_orderstatus")
    if ids is not None:
        rows = _dealt(rows, ids)
    return rows.select(
        "granule_id", F.explode(F.array(
            F.struct(F.lit("").alias("scope"), F.lit("title").alias("key"),
                     F.lit('"orders"').alias("value_json")),
            F.struct(F.lit("").alias("scope"), F.lit("status").alias("key"),
                     F.to_json(F.array("o_orderstatus")).alias("value_json")))).alias("one")
    ).select("granule_id", "one.*")


def manifest_existing(spark: SparkSession, sf_dir: str,
                      batch: Callable[[Column], Column] | None = None) -> Manifest:
    """Granules with a ``time`` axis as long as their highest line number.

    ``batch``, a condition on the order's key, leaves the manifest of the granules of one batch.
    """
    lines, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    if batch is not None:
        lines, orders = lines.where(batch(F.col("l_orderkey"))), orders.where(batch(F.col("o_orderkey")))
    dims = lines.groupBy(granule_id("l_orderkey")).agg(F.max("l_linenumber").alias("n")).select(
        "granule_id", F.lit("time").alias("dim"), F.col("n").cast("bigint").alias("size"))
    sized = orders.select(granule_id("o_orderkey")).join(
        dims.select("granule_id", "size"), "granule_id", "left").select(
            "granule_id", F.coalesce("size", F.lit(0)).alias("size"))
    one, four = F.lit(1), F.lit(4)
    variables = _variables(sized, [
        ("v_F", "time", F.col("size"), one, False), ("v_O", "time", F.col("size"), one, False),
        ("m_total", "y", four, four, False), ("lat", "y", four, four, True)])
    chunks = _line_chunks(lines).unionByName(_order_chunks(orders, ["m_total", "lat"]))
    return Manifest(dims, variables, order_attrs(orders), chunks,
                    local_frame(spark, [], COORD_VALUES))


def manifest_coords(spark: SparkSession, sf_dir: str) -> Manifest:
    """As ``manifest_existing``, with a latitude over two dimensions that attributes name.

    Variable ``v_F`` names ``lat2`` and one that does not exist, and ``lat2`` names ``aux``.
    """
    base, orders = manifest_existing(spark, sf_dir), load(spark, sf_dir, "orders")
    like = base.variables.where("var = 'm_total'")
    two = [F.lit(4).cast("bigint"), F.lit(3).cast("bigint")]
    variables = base.variables.unionByName(like.withColumn("var", F.lit("aux"))).unionByName(
        like.withColumns({"var": F.lit("lat2"), "dims": F.array(F.lit("y"), F.lit("x")),
                          "shape": F.array(*two), "chunk_shape": F.array(*two)}))
    zero = F.lit(0).cast("bigint")
    chunks = _order_chunks(orders, ["aux", "lat2"]).withColumn("chunk_idx", F.when(
        F.col("var") == "lat2", F.array(zero, zero)).otherwise(F.array(zero)))
    named = orders.select(granule_id("o_orderkey"), F.explode(F.array(*[
        F.struct(F.lit(scope).alias("scope"), F.lit("coordinates").alias("key"),
                 F.lit(value).alias("value_json"))
        for scope, value in (("v_F", '"lat2 gone"'), ("lat2", '"aux"'))])).alias("one")).select(
            "granule_id", "one.*")
    return base.with_(variables=variables, attrs=base.attrs.unionByName(named),
                      chunk_refs=base.chunk_refs.unionByName(chunks))


def manifest_new(spark: SparkSession, sf_dir: str, batch: DataFrame | None = None) -> Manifest:
    """Granules of equal shape for a new axis: ``line`` is as long as the highest line number of all.

    ``batch``, granules that arrived together, leaves the manifest of these. Their rows are taken before
    they are grouped or made several, as a reader of their files would give them.
    """
    lines, orders = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    wanted = None if batch is None else hashed_side(batch.select("granule_id"))
    ids = orders.select(granule_id("o_orderkey"))
    if wanted is not None:
        ids = _dealt(ids, wanted)
    longest = lines.agg(F.max("l_linenumber").cast("bigint")).scalar()
    sized = ids.withColumn("size", longest)
    one, four = F.lit(1), F.lit(4)
    variables = _variables(sized, [
        ("v_F", "line", F.col("size"), one, False), ("v_O", "line", F.col("size"), one, False),
        ("lat", "y", four, four, True), ("crs", "y", four, four, True)])
    dims = sized.select("granule_id", F.lit("line").alias("dim"), "size").unionByName(
        ids.select("granule_id", F.lit("y").alias("dim"), F.lit(4).cast("bigint").alias("size")))
    chunks = _line_chunks(lines, wanted).unionByName(_order_chunks(orders, ["lat", "crs"], wanted))
    return Manifest(dims, variables, order_attrs(orders, wanted), chunks,
                    local_frame(spark, [], COORD_VALUES))


def part_dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Dimension sizes per part, and the parts as granules with links."""
    part = load(spark, sf_dir, "part")
    dims = part.select(granule_id("p_partkey"), F.col("p_type").alias("dim"), F.when(
        F.col("p_type").isin("SMALL", "LARGE"), 100).otherwise(F.col("p_size")).cast("bigint")
        .alias("size"))
    links = part.select(granule_id("p_partkey"), F.col("p_partkey").alias("search_rank"), F.concat(
        F.lit("s3://b-parts/"), "p_partkey").alias("url"))
    return dims, links


def part_variables(spark: SparkSession, sf_dir: str) -> tuple[Manifest, DataFrame]:
    """Brands as variables of granules that are part sizes."""
    part = load(spark, sf_dir, "part")
    grouped = part.groupBy("p_size", "p_brand").agg(
        F.min("p_type").alias("dtype"), F.count(F.lit(1)).alias("n"))
    variables = grouped.select(
        granule_id("p_size"), F.col("p_brand").alias("var"), F.array(F.lit("n")).alias("dims"),
        F.array("n").alias("shape"), F.array("n").alias("chunk_shape"), "dtype",
        F.lit("{}").alias("codec_json"), F.lit("null").alias("fill_json"),
        F.lit(False).alias("is_coord"), F.lit(False).alias("loadable"))
    found = part.groupBy("p_size").agg(F.first("p_size").cast("bigint").alias("search_rank")
                                       ).select(granule_id("p_size"), "search_rank")
    empty = local_frame(spark, [], COORD_VALUES)
    return Manifest(empty, variables, empty, empty, empty), found


def part_places(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Parts as granules by a key, found by two specs: the larger half first, then all of them."""
    found = load(spark, sf_dir, "part").groupBy(key).agg(F.max("p_size").alias("s")).select(
        granule_id(key), F.col(key).cast("bigint").alias("search_rank"), F.concat(
            F.lit("s3://b-parts/"), key, F.lit(".nc")).alias("url"), F.col("s"))
    return found.where("s > 25").withColumn("spec_no", F.lit(0)).unionByName(
        found.withColumn("spec_no", F.lit(1))).drop("s")


def part_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    value = F.when(F.col("p_size") % 2 == 0, '"const"').otherwise(
        F.concat(F.lit('"'), "p_type", F.lit('"')))
    return part.select(granule_id("p_partkey"), F.lit("").alias("scope"), F.concat(
        F.lit("a"), "p_size").alias("key"), value.alias("value_json"))


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pages = load(spark, sf_dir, "documents"), load(spark, sf_dir, "pages")
    return docs.select(F.concat(F.lit("s3://b-"), "source", F.lit("/"), "doc_id").alias("url")
                       ).unionByName(pages.select("url"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents and pages with bucket names in front."""
    docs, pages = load(spark, sf_dir, "documents"), load(spark, sf_dir, "pages")
    known = F.concat(F.lit("fsspec.S3FileSystem s3://b-"), "source", F.lit("/"), "doc_id",
                     F.lit(" "), "text")
    bare = F.concat(F.lit("b-src2/"), "page_id", F.lit(" b-src3 "), "html")
    return docs.select(F.concat(F.lit("d"), "doc_id").alias("key"), known.alias("text")
                       ).unionByName(pages.select(F.concat(F.lit("p"), "page_id").alias("key"),
                                                  bare.alias("text")))


def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference entries: a byte range per document, a text per page, an object per part."""
    docs, pages = load(spark, sf_dir, "documents"), load(spark, sf_dir, "pages")
    part = load(spark, sf_dir, "part")
    none = F.lit(None).cast("string")

    def entry(df: DataFrame, key: Column, kind: str, **values: Column) -> DataFrame:
        return df.select(key.alias("key"), F.lit(kind).alias("kind"), *[
            values.get(name, none).alias(name)
            for name in ("url", "tail_json", "inline_text", "other_json")])

    return entry(
        docs, F.concat(F.lit("doc/"), "doc_id"), "ref",
        url=F.concat(F.lit("s3://b-"), "source", F.lit("/"), "doc_id"),
        tail_json=F.concat(F.lit("["), "doc_id", F.lit(","), "n_chars", F.lit("]")),
    ).unionByName(entry(
        pages, F.concat(F.lit("page/"), "page_id"), "inline",
        inline_text=F.concat(F.lit("s3://b-src1/"), "page_id", F.lit(" "), "html"),
    )).unionByName(entry(
        part, F.concat(F.lit("part/"), "p_partkey"), "other",
        other_json=F.concat(F.lit('{"size":'), "p_size", F.lit("}"))))


def objects(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A source and a destination listing.

    The destination lacks the objects of customers in debt, has another size for nation 3, another
    etag for nation 4, a matching stamp for nation 5 beside a foreign etag, and a wrong stamp for
    nation 6. Suppliers are in the destination only.
    """
    cust, supp = load(spark, sf_dir, "customer"), load(spark, sf_dir, "supplier")
    key = F.concat(F.lit("pre/"), "c_mktsegment", F.lit("/"), "c_custkey")
    size, etag = F.col("c_nationkey").cast("bigint"), F.md5("c_name")
    none = F.lit(None).cast("string")
    now = F.lit("2024-01-01").cast("timestamp").alias("modified")
    nation = F.col("c_nationkey")
    src = cust.select(F.lit("one").alias("bucket"), key.alias("key"), size.alias("size"),
                      etag.alias("etag"), none.alias("source_etag"), now)
    dst = cust.where("c_acctbal >= 0").select(
        F.lit("two").alias("bucket"), key.alias("key"),
        F.when(nation == 3, size + 1).otherwise(size).alias("size"),
        F.when(nation.isin(4, 5), F.lit("other")).otherwise(etag).alias("etag"),
        F.when(nation == 5, etag).when(nation == 6, F.lit("x")).otherwise(none)
        .alias("source_etag"), now)
    extra = supp.select(
        F.lit("two").alias("bucket"), F.concat(F.lit("pre/SUP/"), "s_suppkey").alias("key"),
        F.col("s_nationkey").cast("bigint").alias("size"), F.md5("s_name").alias("etag"),
        none.alias("source_etag"), now)
    return src, dst.unionByName(extra)
