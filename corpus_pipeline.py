"""A corpus pipeline of five stages: quality, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. The
stages read their side tables (labels, benchmark) from sf_dir.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, n_words, shared_folder
from ledgerloom.llm.decontaminate import match_benchmark
from ledgerloom.llm.mixing import mix_sources
from ledgerloom.llm.quality import score_quality
from ledgerloom.llm.sharding import shard_by_bytes
from ledgerloom.llm.shingle_join import jaccard_join

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHARDS = 24


def _side(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality is at least 0.3; learnt from the labels of documents that are here."""
    labels = _side(spark, sf_dir, "labels").select("doc_id", "quality")
    return score_quality(docs.select(COLUMNS), labels).where("predicted = 1").select(COLUMNS)


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs with __key, a hash of id and text; and (__key, no_id, id, t1, t2), once for each id and 128-bit hash of text, no two with one key."""
    seed = 0
    while True:
        marks = [F.lit(seed), F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text")]
        keyed = docs.select(*COLUMNS, F.xxhash64(*marks).alias("__key"))
        text_hash = [F.xxhash64("text").alias("t1"), F.xxhash64(F.lit("again"), "text").alias("t2")]
        names = cut(keyed.select("__key", F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), *text_hash).distinct())
        if not names.groupBy("__key").count().where("count > 1").limit(1).count():
            return keyed, names
        seed += 1


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by similarity >= 0.8 of five-word shingles the row of smallest id and hash of text; one row of repeated rows.

    Rows of one id are as many documents as they have texts. Rows without id come after all others of their group.
    """
    keyed, names = _keyed(docs)
    groups = jaccard_join(keyed, doc_id="__key", k=5, percent=80).select(F.col("doc_id").alias("__key"), "component_id").distinct()
    least = F.min(F.struct("no_id", "id", "t1", "t2", "__key"))
    first = groups.join(names, "__key").groupBy("component_id").agg(least.alias("least")).select(F.col("least.__key").alias("__key"))
    staying = keyed.join(first, "__key", "left_semi").groupBy("__key").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return staying.select([F.col(f"row.{c}").alias(c) for c in COLUMNS])


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, nor one with other numbers, names and units."""
    items = _side(spark, sf_dir, "benchmark").select("item_id", "text")
    return match_benchmark(docs.select(COLUMNS), items).where(F.size("matches") == 0).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their weights: each document as many times as the mix takes it, which may be never."""
    sized = docs.select(COLUMNS).withColumns({"size": n_words(F.col("text")), "key": F.xxhash64("doc_id", "source", "text")})
    mixed = mix_sources(sized).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of nearly equal bytes, with the columns size, shard and slot."""
    return shard_by_bytes(docs.select(COLUMNS), SHARDS).select(*COLUMNS, "size", "shard", "slot")


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("mixing", mix),
    ("sharding", shard),
]

#: A trained classifier and random rounding are not expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder and read by the next, then removed."""
    shared_folder(spark)
    docs = _side(spark, sf_dir, "documents")
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    before = None
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = f"{folder}/{at}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                _remove(spark, before)
            before = path
    return docs


def _remove(spark: SparkSession, path: str) -> None:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)
