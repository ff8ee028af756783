"""Delivery files: report rows as they arrive, with their day in the name of the file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_deliveries(spark: SparkSession, folder: str, schema: str, file_name: str = "file_name", **options) -> DataFrame:
    """Rows of all files with header in a folder, each with the name of its file.

    The file scans (``scan_file_prefix``, ``scan_file_exact``) apply to it. With ``days`` their range of names is a condition
    on the file itself, so files of other days are not opened. A row that does not fit the schema is an error unless
    ``mode`` is given.
    """
    rows = spark.read.schema(schema).options(**{"header": "true", "mode": "FAILFAST", **options}).csv(folder)
    return rows.withColumn(file_name, F.col("_metadata.file_name"))


def write_delivery(df: DataFrame, folder: str, name: str) -> None:
    """Add a delivery to a folder: files with header whose names begin with ``name``, one for each partition of df."""
    df.write.mode("append").option("header", "true").option("mapreduce.output.basename", name).csv(folder)
