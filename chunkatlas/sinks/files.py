"""Single files on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession

_COPY_BUFFER = 8 << 20


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop(spark, path)
    return fs.exists(at)


def folders(spark: SparkSession, root: str, glob: str) -> list[str]:
    """Names of the folders directly below ``root`` that match ``glob``."""
    fs, at = _hadoop(spark, f"{root.rstrip('/')}/{glob}")
    return sorted(status.getPath().getName() for status in fs.globStatus(at) or []
                  if status.isDirectory())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a short text as one file."""
    fs, at = _hadoop(spark, path)
    stream = fs.create(at, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def concat_parts(spark: SparkSession, parts: str, out: str, top: str, bottom: str) -> None:
    """Join the part files of a folder, in name order, into one file with text around them.

    Bytes are streamed with a fixed buffer. The result appears under its name only when complete.
    """
    jvm = spark._jvm
    from_fs, folder = _hadoop(spark, parts)
    to_fs, target = _hadoop(spark, out)
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.part")
    found = sorted((status.getPath() for status in from_fs.listStatus(folder)
                    if status.getPath().getName().startswith("part-")),
                   key=lambda path: path.getName())
    stream = to_fs.create(staged, True)
    try:
        stream.write(bytearray(top, "utf-8"))
        for part in found:
            source = from_fs.open(part)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, stream, _COPY_BUFFER, False)
            finally:
                source.close()
        stream.write(bytearray(bottom, "utf-8"))
    finally:
        stream.close()
    if to_fs.exists(target):
        to_fs.delete(target, True)
    if not to_fs.rename(staged, target):
        raise OSError(f"cannot rename {staged.toString()} to {target.toString()}")
