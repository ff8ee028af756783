"""The few file operations Spark's readers and writers do not offer, in whatever store Hadoop reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def exists(spark: SparkSession, path: str) -> bool:
    fs, there = _at(spark, path)
    return fs.exists(there)


def make_folder(spark: SparkSession, path: str) -> None:
    """A folder that is there, empty if it was not before."""
    fs, there = _at(spark, path)
    fs.mkdirs(there)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all it holds; nothing happens where there is none."""
    fs, there = _at(spark, path)
    fs.delete(there, True)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Give a path the lifetime of this session's process."""
    fs, there = _at(spark, path)
    fs.deleteOnExit(there)


def folders(spark: SparkSession, path: str, depth: int = 1) -> list[str]:
    """Folders ``depth`` levels below a path, named from there, sorted."""
    fs, there = _at(spark, path)
    level, found = [there], []
    for _ in range(depth):
        level = [s.getPath() for p in level if fs.exists(p) for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName()[0] not in "_."]
    for p in level:
        names, up = [], p
        for _ in range(depth):
            names.append(up.getName())
            up = up.getParent()
        found.append("/".join(reversed(names)))
    return sorted(found)


def names(spark: SparkSession, path: str) -> list[str]:
    fs, there = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(there)) if fs.exists(there) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, there = _at(spark, path)
    stream = fs.open(there)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all; an error where the path is taken.

    The text is written beside the path and renamed, which fails if another run was first.
    """
    fs, there = _at(spark, path)
    if fs.exists(there):
        raise FileExistsError(path)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    beside = jvm.org.apache.hadoop.fs.Path(there.getParent(), f".{there.getName()}-{jvm.java.util.UUID.randomUUID()}")
    stream = fs.create(beside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(there.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(context.makeQualified(beside), context.makeQualified(there), gateway.new_array(rename, 0))
    except Exception:
        fs.delete(beside, False)
        raise
