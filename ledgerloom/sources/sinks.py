"""Sinks. Each is a plain partitioned write that can be repeated safely after a failure.

Rows are rebalanced by the partition columns before the write, so each target
partition gets few, large files, and adaptive execution splits one that holds
far more rows than the others over several writers, by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.sources import files


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a target partition together, in few, large files."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Columns, order and types of the target table, given as DDL.

    A table keeps one type per column over its whole life; the type an
    aggregate happens to have must not leak into some of its files.
    """
    target = StructType.fromDDL(schema)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])


def append_history(df: DataFrame, path: str, schema: str, partition_by: Sequence[str]) -> None:
    """Append to an accumulation table."""
    part = conform(df, schema)
    clustered(part, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def truncate_reload(df: DataFrame, path: str, schema: str, partition_by: Sequence[str]) -> None:
    """Clear the accumulation table and load it again."""
    part = clustered(conform(df, schema), partition_by)
    writer = part.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*partition_by).parquet(path)


def replace_batches(
    df: DataFrame, path: str, schema: str, batch_keys: Sequence[str] = ("brand", "batchid"),
    partition_by: Sequence[str] | None = None, cleared: DataFrame | None = None,
) -> None:
    """Replace exactly the batches present in ``df``, and empty those listed in ``cleared``; all other batches stay.

    ``cleared`` has the batch keys and the partition columns. Its batches lose
    their old rows even where ``df`` brings no new ones; what is left of a
    partition is written back, and a partition left empty is removed.

    Repeating the call with the same rows leaves the table as it was after the
    first, which is what makes a publish safe to retry.

    The table is partitioned by the batch itself, or, where a batch is only a
    few lines, by the coarser ``partition_by``. In that case the partitions the
    new batches fall in are rewritten: their other batches are read back and
    written together with the new ones, so files stay large and few.
    """
    new = conform(df, schema)
    parts = list(partition_by or batch_keys)
    emptied = []
    if partition_by is not None and table_exists(df.sparkSession, path):
        listed = list(dict.fromkeys([*parts, *batch_keys]))
        keys = new.select(*listed)
        keys = (keys if cleared is None else keys.union(cleared.select(*listed))).distinct()
        old = conform(df.sparkSession.read.schema(schema).parquet(path), schema)
        old = old.join(keys.select(*parts).distinct(), parts, "left_semi")
        new = replaced_batches(old, new, batch_keys, keys)
        if cleared is not None:  # a row per partition of the batches listed, so as few as months are closed
            emptied = cleared.select(*parts).distinct().join(new.select(*parts).distinct(), parts, "left_anti").collect()
    writer = clustered(new, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(path)
    for row in emptied:
        files.remove(df.sparkSession, "/".join([path, *[f"{c}={row[c]}" for c in parts]]))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything has been written to ``path`` yet. Asks for the path alone; any failure is raised, never read as absence."""
    return files.exists(spark, path)


def replaced_batches(
    old: DataFrame, new: DataFrame, batch_keys: Sequence[str] = ("brand", "batchid"), keys: DataFrame | None = None
) -> DataFrame:
    """Old rows of batches not in ``new``, and the new rows. ``keys`` lists the new batches if already known."""
    keys = new.select(*batch_keys).distinct() if keys is None else keys
    return old.join(keys, list(batch_keys), "left_anti").select(*new.columns).unionByName(new)
