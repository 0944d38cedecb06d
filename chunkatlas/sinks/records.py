"""Chunk references as positional records (K2): where a chunk's record stands follows from its number.

The chunks of a variable are numbered in row-major order of their indices. A row of the table holds ``size``
records of WIDTH bytes in that order: the URL's number, the offset and the length, all little-endian. A chunk that
is absent is a record of URL number -1, and one whose bytes stand in the reference itself has -2 and a row in
``inline``. URLs are a dictionary of two levels: a number gives a name and the number of the folder it is in.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import with_ordinal_sorted
from ..schemas import Dataset
from ..session import materialize, small_side

RECORD = np.dtype([("url", "<i8"), ("offset", "<i8"), ("length", "<i8")])
WIDTH = RECORD.itemsize
ABSENT, INLINE = -1, -2
#: Records of one row.
ROW_RECORDS = 1 << 14


def grid(shape: Column, chunk_shape: Column) -> Column:
    """Number of chunks along each dimension."""
    return F.zip_with(shape, chunk_shape, lambda n, c: F.ceil(n / c).cast("bigint"))


def chunk_number(chunk_idx: Column, counts: Column) -> Column:
    """Place of a chunk in row-major order; 0 without dimensions."""
    pairs = F.zip_with(chunk_idx, counts, lambda i, n: F.struct(i.alias("i"), n.alias("n")))
    return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda acc, x: acc * x["n"] + x["i"])


def chunk_index(number: Column, counts: Column) -> Column:
    """The indices of a chunk, from its place. Few dimensions are done without a loop, in compiled code."""
    start = F.struct(number.cast("bigint").alias("rest"), F.array().cast("array<bigint>").alias("idx"))
    looped = F.aggregate(F.reverse(counts), start, lambda acc, n: F.struct(
        F.floor(acc["rest"] / n).cast("bigint").alias("rest"),
        F.concat(F.array(acc["rest"] % n), acc["idx"]).alias("idx")), lambda acc: acc["idx"])
    number = number.cast("bigint")
    first, second = F.get(counts, F.lit(0)), F.get(counts, F.lit(1))
    return (F.when(F.size(counts) == 1, F.array(number % first))
            .when(F.size(counts) == 2, F.array(F.floor(number / second).cast("bigint") % first, number % second))
            .otherwise(looped))


def _write_ranged(table: DataFrame, order: list[str], path: str, mode: str, *folders: str) -> None:
    """Write files, named in order, of ranges of ``order``, so that a row is found by bisection."""
    (table.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode)
     .option("parquet.block.size", 1 << 20).partitionBy(*folders).parquet(path))


def write_records(ds: Dataset, path: str, size: int = ROW_RECORDS, mode: str = "errorifexists") -> None:
    """Write the dataset's chunk references as records, and its other tables as ``write_refs_parquet`` does.

    A chunk outside its variable's grid is an error. Rows without any chunk are not written. Of a variable's rows
    each is built in one task from at most ``size`` chunks, so a variable with most of the chunks is spread.
    """
    spark = ds.variables.sparkSession
    shapes = ds.variables.select("var", grid(F.col("shape"), F.col("chunk_shape")).alias("counts")).distinct()
    name = F.substring_index("url", "/", -1)
    folder = F.left("url", F.length("url") - F.length(name))
    found = ds.chunk_refs.select("var", "chunk_idx", "url", "offset", "length", "inline_text").join(small_side(shapes), "var")
    inside = F.forall(F.zip_with("chunk_idx", "counts", lambda i, n: (i >= 0) & (i < n)), lambda x: F.coalesce(x, F.lit(False)))
    # One and two dimensions are the usual cases, and compiled code does them several times faster.
    rank = lambda n: (F.size("chunk_idx") == n) & (F.size("counts") == n)
    (i, m), (j, n) = [(F.get("chunk_idx", F.lit(d)), F.get("counts", F.lit(d))) for d in (0, 1)]
    first, second = (i >= 0) & (i < m), (j >= 0) & (j < n)
    number = F.when(rank(1) & first, i).when(rank(2) & first & second, i * n + j).when(
        inside & (F.size("chunk_idx") == F.size("counts")), chunk_number(F.col("chunk_idx"), F.col("counts"))).otherwise(
        F.raise_error(F.concat(F.lit("chunk outside its grid: "), "var", F.lit(" "), F.to_json("chunk_idx"))).cast("bigint"))
    found = materialize(found.select("var", number.alias("n"), folder.alias("folder"),
                                     name.alias("name"), "offset", "length", "inline_text"), "chunks")
    folders = with_ordinal_sorted(found.where("folder IS NOT NULL").select("folder").distinct(), ["folder"], out="folder_id")
    urls = with_ordinal_sorted(found.where("folder IS NOT NULL").select("folder", "name").distinct(), ["folder", "name"], out="url_id")
    _write_ranged(folders.select("folder_id", "folder"), ["folder_id"], f"{path}/folders", mode)
    _write_ranged(urls.join(small_side(folders), "folder").select("url_id", "folder_id", "name"), ["url_id"],
                  f"{path}/urls", mode)
    inline = found.where("inline_text IS NOT NULL").select("var", "n", "inline_text")
    _write_ranged(inline, ["var", "n"], f"{path}/inline", mode, "var")
    # Names come first, as the folders of most URLs begin alike: a sort then compares few of them beyond their first bytes.
    placed = found.join(small_side(urls), ["name", "folder"], "left").select(
        "var", F.expr(f"n div {size}").alias("row"), F.expr(f"n % {size}").cast("int").alias("at"),
        F.when(F.col("inline_text").isNotNull(), INLINE).otherwise(F.coalesce("url_id", F.lit(ABSENT))).cast("bigint").alias("url"),
        F.coalesce("offset", F.lit(-1)).cast("bigint").alias("offset"), F.coalesce("length", F.lit(-1)).cast("bigint").alias("length"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The rows of one hash, which are one but for collisions.
        now, held = None, {}

        def closed() -> Iterator[pa.RecordBatch]:
            for (var, row), records in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (var, row, records.tobytes())], ["var", "row", "records"])

        for batch in batches:
            var, row, hashes = batch.column(0), batch.column(1), batch.column(2).to_numpy()
            columns = [batch.column(c).to_numpy() for c in range(3, 7)]
            turns = [pc.not_equal(c.slice(1), c.slice(0, max(len(c) - 1, 0))).to_numpy(zero_copy_only=False) for c in (var, row)]
            cuts = [0, *(np.flatnonzero(turns[0] | turns[1]) + 1).tolist(), len(row)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if hashes[lo] != now:
                    yield from closed()
                    now, held = hashes[lo], {}
                key = (var[lo].as_py(), row[lo].as_py())
                if key not in held:
                    held[key] = np.full(size, np.array((ABSENT, -1, -1), RECORD))
                at = columns[0][lo:hi]
                for name, values in zip(RECORD.names, columns[1:]):
                    held[key][name][at] = values[lo:hi]
        yield from closed()

    # One number is sorted much faster than variable and row.
    rows = placed.select("var", "row", F.xxhash64("var", "row").alias("hash"), "at", "url", "offset", "length").repartition(
        "hash").sortWithinPartitions("hash").mapInArrow(build, "var STRING, row BIGINT, records BINARY")
    _write_ranged(materialize(rows, "records"), ["var", "row"], f"{path}/records", mode, "var")
    ds.variables.withColumn("row_records", F.lit(size)).write.mode(mode).parquet(f"{path}/variables")
    for name in ("dims", "attrs", "coord_values"):
        getattr(ds, name).write.mode(mode).parquet(f"{path}/{name}")


def read_records(spark: SparkSession, path: str, var: str | None = None, numbers: Sequence[int] | None = None) -> DataFrame:
    """var, chunk_idx, url, offset, length, inline_text of the chunks that are there.

    With ``var`` only its folder is read, and with ``numbers`` too only the rows in which these records stand;
    of them only the records' own bytes are decoded. URLs are looked up by number.
    """
    variables = spark.read.parquet(f"{path}/variables")
    first = variables.select("row_records").first()
    size = first["row_records"] if first else ROW_RECORDS
    shapes = variables.select("var", grid(F.col("shape"), F.col("chunk_shape")).alias("counts")).distinct()
    rows = spark.read.schema("row BIGINT, records BINARY, var STRING").parquet(f"{path}/records")
    if var is not None:
        rows = rows.where(F.col("var") == var)
    wanted = None
    if numbers is not None:
        wanted = sorted(set(numbers))
        rows = rows.where(F.col("row").isin(sorted({n // size for n in wanted})))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for var, row, data in zip(*(c.to_pylist() for c in batch.columns)):
                if wanted is None:
                    records, at = np.frombuffer(data, RECORD), np.arange(size)
                else:
                    at = np.array([n - row * size for n in wanted if n // size == row], np.int64)
                    records = np.array([np.frombuffer(data, RECORD, 1, i * WIDTH)[0] for i in at.tolist()], RECORD)
                there = records["url"] != ABSENT
                records, at = records[there], at[there]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(var), len(at)), pa.array(at + row * size),
                     *(pa.array(np.ascontiguousarray(records[name])) for name in RECORD.names)],
                    ["var", "n", "url_id", "offset", "length"])

    found = rows.select("var", "row", "records").mapInArrow(
        decode, "var STRING, n BIGINT, url_id BIGINT, offset BIGINT, length BIGINT")
    urls = spark.read.parquet(f"{path}/urls").join(small_side(spark.read.parquet(f"{path}/folders")), "folder_id").select(
        "url_id", F.concat("folder", "name").alias("url"))
    inline = spark.read.schema("n BIGINT, inline_text STRING, var STRING").parquet(f"{path}/inline")
    known = lambda c: F.when(F.col(c) >= 0, F.col(c)).alias(c)
    return (found.join(small_side(urls), "url_id", "left").join(small_side(inline), ["var", "n"], "left")
            .join(small_side(shapes), "var").select("var", chunk_index(F.col("n"), F.col("counts")).alias("chunk_idx"),
                                                    "url", known("offset"), known("length"), "inline_text"))


def open_records(spark: SparkSession, path: str) -> Dataset:
    """What ``write_records`` wrote, as a dataset."""
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in ("dims", "attrs", "coord_values")}
    return Dataset(variables=spark.read.parquet(f"{path}/variables").drop("row_records"),
                   chunk_refs=read_records(spark, path), **tables)
