"""Quality rules whose thresholds follow the data: quantile sketches for each language and source, joined back to filter.

Rates are whole numbers in thousandths. A sketch counts values by their first seven binary digits, so a quantile is at most a
sixty-fourth too small, sketches of parts merge by adding counts, and the result depends neither on order nor on partitions. A rate is
far out when it lies beyond a quartile by more than a multiple of the distance between the quartiles. Groups of few documents use the
merged sketch of their language, and languages of few documents that of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, mix, shingles, text_batches, word_hashes

LEAST_WORDS, REPEATED_PERCENT = 10, 20  # base rules
WINDOW = 5  # words of a repeated window
FENCE = 6  # how many times the distance between the quartiles a rate may lie beyond them
LEAST_DOCS = 100  # smaller groups use a merged sketch
DIGITS = 7  # binary digits a sketch keeps

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_POINT = np.ones(256, dtype=bool)
_POINT[0x80:0xC0] = False  # further bytes of a code point

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"


@dataclass(frozen=True)
class Rule:
    """A rate in thousandths, the least distance between quartiles it is judged by, and whether low values count as well."""

    name: str
    part: str
    whole: str
    spread: int
    both: bool = False

    def rate(self) -> Column:
        return F.expr(f"(1000 * {self.part}) div greatest({self.whole}, 1)")


RULES = (
    Rule("word_length", "word_chars", "n_words", 100, both=True),
    Rule("symbols", "n_symbols", "n_words", 50),
    Rule("dup_lines", "n_dup_lines", "n_lines", 75),
    Rule("repeats", "n_repeat_words", "n_words", 30),
)


def _between(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between consecutive offsets."""
    before = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(flags, dtype=np.int64)))
    return before[offsets[1:]] - before[offsets[:-1]]


def repeated_words(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, its words in windows that it holds twice or more; windows are compared by 64-bit hashes."""
    document = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    windows = shingles(hashes, WINDOW)
    first = np.flatnonzero(document[: len(windows)] == document[WINDOW - 1 :][: len(windows)]) if len(windows) else np.zeros(0, dtype=np.int64)
    key = windows[first] ^ mix(document[first].astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    np.add.at(edges, first[twice], 1)
    np.add.at(edges, first[twice] + WINDOW, -1)
    return _between(np.cumsum(edges)[:-1] > 0, offsets)


def _lines(data: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(lines), len(lines) - len(set(lines))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch["text"].to_pylist()]
        raw = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        offsets = np.concatenate(([0], np.cumsum([len(b) for b in raw]))).astype(np.int64)
        hashes, words = word_hashes(texts)
        lines = np.array([_lines(b) for b in raw], dtype=np.int64).reshape(-1, 2)
        columns = {
            "n_words": np.diff(words), "word_chars": _between(_POINT[data] & ~_BLANK[data], offsets),
            "n_symbols": _between(_SYMBOL[data], offsets), "n_dup_lines": lines[:, 1],
            "n_repeat_words": repeated_words(hashes, words), "n_lines": lines[:, 0],
        }
        rest = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, *[pa.array(c, pa.int64()) for c in columns.values()]], names=[*rest.schema.names, *columns]
        )


def text_counts(docs: DataFrame) -> DataFrame:
    """docs (doc_id, lang, source, text) with the counts of the whole texts in place of these."""
    text_batches(docs.sparkSession)
    docs = docs.select("doc_id", "lang", "source", "text")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.drop("text").schema)
    return docs.mapInArrow(_count, f"{kept}, {COUNTS}")


def sketch(rates: DataFrame, by: list[str], value: str = "rate") -> DataFrame:
    """(by, bucket, n): how many values begin with the same binary digits. Of a sketch, the sum of n by fewer columns is the merged one."""
    digits = F.greatest(F.length(F.bin(value)) - DIGITS, F.lit(0))
    width = F.call_function("shiftleft", F.lit(1).cast("long"), digits)
    return rates.withColumn("bucket", F.col(value) - F.col(value) % width).groupBy(*by, "bucket").agg(F.count("*").alias("n"))


def quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(by, size, low, high): size and quartiles of each sketch, which has at most a few thousand buckets."""
    group = Window.partitionBy(*by)
    seen = sketches.withColumns({"below": F.sum("n").over(group.orderBy("bucket")), "size": F.sum("n").over(group)})
    first = lambda quarters: F.min(F.when(4 * F.col("below") >= quarters * F.col("size"), F.col("bucket")))
    return seen.groupBy(*by).agg(F.max("size").alias("size"), first(1).alias("low"), first(3).alias("high"))


def thresholds(counted: DataFrame, fence: int = FENCE, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, and for each rule the least and largest rate that is not far out), from documents the base rules keep."""
    stacked = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), r.rate().alias("rate")) for r in RULES])).alias("at")
    rates = counted.where("not base_failed").select("lang", "source", stacked).select("lang", "source", "at.*")
    own = cut(sketch(rates, ["lang", "source", "rule"]))
    merged = lambda by: quartiles(own.groupBy(*by, "bucket").agg(F.sum("n").alias("n")), by)
    of_source, of_lang, of_all = merged(["lang", "source", "rule"]), merged(["lang", "rule"]), merged(["rule"])
    named = lambda q, tag: q.withColumn(tag, F.struct("size", "low", "high")).drop("size", "low", "high")
    of_lang = named(of_lang, "l").withColumnsRenamed({"lang": "l_lang", "rule": "l_rule"})
    of_all = named(of_all, "a").withColumnRenamed("rule", "a_rule")
    all_three = named(of_source, "s").join(of_lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("rule") == F.col("l_rule")))
    all_three = all_three.join(of_all, F.col("rule") == F.col("a_rule"))
    used = F.when(F.col("s.size") >= least_docs, F.col("s")).when(F.col("l.size") >= least_docs, F.col("l")).otherwise(F.col("a"))
    least = F.lit(None).cast("long")
    for rule in RULES:
        least = F.when(F.col("rule") == rule.name, rule.spread).otherwise(least)
    far = fence * F.greatest(F.col("q.high") - F.col("q.low"), least)
    limits = all_three.withColumn("q", used).select("lang", "source", "rule", (F.col("q.low") - far).alias("low"), (F.col("q.high") + far).alias("high"))
    of = lambda rule, side: F.max(F.when(F.col("rule") == rule.name, F.col(side))).alias(f"{rule.name}_{side}")
    return limits.groupBy("lang", "source").agg(*[of(r, side) for r in RULES for side in ("low", "high")])


def apply_rules(docs: DataFrame, fence: int = FENCE, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed_rules) of every row of docs.

    docs has doc_id, lang, source and text; other columns are ignored. Null texts count as ''. Empty and very short texts fail the base
    rules. Null languages and sources are groups like others. Repeated rows are judged alike and each counts in the sketches, a rate
    equal to a threshold is kept, and an empty table gives an empty result. failed_rules lists the rules broken, `base` first.
    """
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    counted = cut(text_counts(docs).withColumn("base_failed", base))
    limits = thresholds(counted, fence, least_docs).withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    met = counted.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    broken = [F.when(F.col("base_failed"), F.lit("base"))]
    for rule in RULES:
        out = rule.rate() > F.col(f"{rule.name}_high")
        if rule.both:
            out |= rule.rate() < F.col(f"{rule.name}_low")
        broken.append(F.when(~F.col("base_failed") & out, F.lit(rule.name)))
    failed = F.array_compact(F.array(*broken))
    return met.withColumn("failed_rules", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (F.size("failed_rules") == 0).alias("kept"), "failed_rules",
    )
