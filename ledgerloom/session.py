"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources import files

# Correctness settings: every job needs these, whatever its size.
SEMANTICS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Sizing is left to adaptive execution: it coalesces small shuffles, splits
# skewed join partitions and turns a join into a broadcast only when the
# measured side is below the threshold. Nothing in the library forces a
# broadcast with a hint.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}

# A generated method above 8000 bytes is never compiled by the JVM's JIT; above
# this limit Spark evaluates the stage operator by operator in smaller methods.
CODEGEN = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# A close has more than the default of 100 generated classes; with fewer kept, a
# session compiles the same stages again each time.
COMPILED = {"spark.sql.codegen.cache.maxEntries": "2000"}

# Call sites of column functions are not recorded: plans here have thousands of
# expressions, and recording costs more than building them.
BUILD = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTICS, **ADAPTIVE, **CODEGEN, **COMPILED, **BUILD, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it from there; it is removed when the process ends."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    files.remove_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder the cluster names in spark.checkpoint.dir.

    Only a session whose tasks all run in the driver's process may do without
    that setting; elsewhere executors would write to disks of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "ledgerloom-scratch")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
