"""Session defaults, tables in the shared folder, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import NumericType, StringType, StructType

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where a later operator then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Reference files may repeat a key; the last one counts, as with most JSON readers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Index conditions reach the reader of array cells.
    "spark.sql.python.filterPushdown.enabled": "true",
}

#: Largest side that is ever broadcast explicitly.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 << 20

_local_scratch: str | None = None
_shipped: set[str] = set()


def build_session(app: str = "chunkatlas", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Put the engine's runtime settings on a session that was built elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    _ship(spark)
    return spark


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose readers import it; once per Spark application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="run-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for local sessions without it."""
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="run-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/chunkatlas/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Used where a result must not be computed twice (positions taken from a physical order, or
    files read by Python). Later stages read only the columns and partitions they need, and
    losing an executor costs no recomputation of what lies before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *jobs: Callable[[], object]) -> None:
    """Run jobs that do not need each other at once: the last tasks of one leave no core idle.

    All of them have ended when this returns or raises the first error.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows as a DataFrame that holds them itself.

    Rows given to ``createDataFrame`` as a list are turned by Python workers at each use; an Arrow
    table is not.
    """
    fields = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(pa.Table.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, fields)], schema=fields))


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` of text and numbers.

    Two sums, aggregated in the tasks; no row leaves them.
    """
    size = _size(df)
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def _size(df: DataFrame) -> Row:
    # Plain columns need no text to be measured; keys of many granules are measured several times a batch.
    plain = [f.name for f in df.schema if isinstance(f.dataType, (StringType, NumericType))]
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    nested = [c for c in df.columns if c not in plain]
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(8 * len(plain)))
    if nested:
        width += F.octet_length(F.to_json(F.struct(*nested)))
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS,
               max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if it is small enough now.

    Otherwise it comes back unmarked, and the join is a sort-merge join whose skewed partitions
    adaptive execution splits.
    """
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def hashed_side(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """As ``small_side``; a side that is larger, but small enough in each shuffle partition, is hashed there.

    Its keys must be unique or the join must only ask for them, since they have to spread evenly. The
    other side, which is larger by far, is then not sorted.
    """
    size, parts = _size(df), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size["rows"] <= max_rows and size["bytes"] <= max_bytes:
        return F.broadcast(df)
    if size["rows"] <= max_rows * parts and size["bytes"] <= max_bytes * parts:
        return df.hint("shuffle_hash")
    return df
