"""Posting a stream into the books: each micro-batch is published together with the note that it was.

A micro-batch that is replayed after a failure finds its own number in the published state and changes nothing; one that broke off
before it was published left nothing behind. So the books hold each row once, whatever happened between.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.sources.snapshots import Snapshots, partition_folder

POSTED = "stream STRING, batch BIGINT"


def post_batch(
    books: Snapshots, stream: str, table: str, schema: str, partition_by: Sequence[str], lines: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> Callable[[DataFrame, int], None]:
    """What to do with a micro-batch: ``merge`` the old rows of the partitions its ``lines`` fall in with these, and publish both."""

    def post(batch: DataFrame, number: int) -> None:
        base = books.latest()
        posted = books.read("posted", POSTED, base)
        if not posted.filter((F.col("stream") == stream) & (F.col("batch") >= number)).isEmpty():
            return
        new = lines(batch).persist()
        try:
            touched = new.select(*partition_by).distinct().collect()  # the partitions of one micro-batch
            folders = [partition_folder(row.asDict()) for row in touched]
            rows = merge(books.read(table, schema, base, folders), new)
            note = batch.sparkSession.createDataFrame([(stream, number)], POSTED)
            others = posted.filter(F.col("stream") != stream)
            books.publish(base, [
                books.write(rows, table, schema, partition_by), books.write(others.unionByName(note), "posted", POSTED),
            ], {table: folders})
            books.clean()
        finally:
            new.unpersist()

    return post


def post_available(
    stream: DataFrame, post: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Post everything that has arrived so far, then stop."""
    return stream.writeStream.foreachBatch(post).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
