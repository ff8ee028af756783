"""Tables stored in buckets of a text key, so that a lookup by id is joined where the rows lie."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import ci_key, col
from ledgerloom.session import scratch_path
from ledgerloom.sources import files

#: Column of the stored key: the id as text without case.
KEY = "bucket_key"


def id_key(column: Column | str) -> Column:
    return ci_key(col(column).cast("string"))


def store_bucketed(df: DataFrame, name: str, id_column: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store df in so many buckets of its id's key, one sorted file each, and read the table.

    One exchange, paid when the table is loaded. Rows without id, which match nothing, are spread over all buckets. An id
    that holds much of the table makes its bucket as large: ``processor_id_lookup`` on plain tables lets adaptive execution
    split such a key. Without a path the table lies in the shared folder and is removed when the process ends.
    """
    spark = df.sparkSession
    if path is None:
        path = scratch_path(spark, name)
        files.remove_at_exit(spark, path)
        name = f"{name}_{uuid.uuid4().hex}"
    # no key of an id begins with a line feed and is numbered so: these rows have a null id beside it
    spread = F.concat(F.lit("\n"), F.xxhash64(*df.columns).cast("string"))
    keyed = df.withColumn(KEY, F.coalesce(id_key(id_column), spread))
    writer = keyed.repartition(buckets, KEY).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(name)
    return spark.table(name)


def store_ids(report: DataFrame, name: str, id_column: str, buckets: int, path: str | None = None) -> DataFrame:
    """The ids of a report in buckets, one for each key: the largest spelling. Spellings are told apart by hash first."""
    ids = report.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("string").alias("id")).distinct()
    return store_bucketed(ids.groupBy(id_key("id").alias("k")).agg(F.max("id").alias("id")).drop("k"), name, "id", buckets, path)


def bucketed_id_lookup(ledger: DataFrame, ids: DataFrame, id_column: str, alias: str = "processor_txn_id") -> DataFrame:
    """The stored id for each row of a stored ledger, '' where there is none; tables of equal buckets are joined without an exchange."""
    found = ids.select(KEY, F.col("id").alias("__id"))
    value = F.when(F.col(id_column).isNotNull(), F.col("__id"))
    return ledger.join(found, KEY, "left").withColumn(alias, F.coalesce(value, F.lit(""))).drop("__id", KEY)
