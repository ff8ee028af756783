"""Source divergence audit: how far the sources of a language are apart in their terms, and which terms set a source apart.

Terms are found by a token-start pointer sort. A task gathers a shard of texts, ordered by language and source, in Arrow buffers;
every term start is a pointer into the bytes, and a multikey quicksort with eight bytes as one character orders the pointers:
a slice of pointers that agree so far is sorted by their next eight bytes, until it is a single pointer or its terms end. Runs of
equal terms then give occurrences by source and document frequency. Only these counts leave the task; they meet by language and term.

Shares are whole numbers: p = 1 + floor(10^9 * (count + 5) / (N + 5 * V)), with N the occurrences of kept terms in the group (or the
whole language) and V the number of kept terms of the language. All sums are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, text_batches

SHARD_BYTES = 16 << 20  # text a task sorts at once; one longer text is a shard of its own
DEEP = 64  # bytes after which the few slices left are compared as whole terms
ROWS_PER_TASK = 20_000  # counts of one task of the pair sums
CELLS = 1 << 21  # cells of the dense block of terms by sources that a task holds
SOURCES_PER_TASK = 500  # rows of the matrix of pair sums that a task holds

_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[0x41:0x5B] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True  # every byte of a character beyond ASCII belongs to a term
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_KEEP = np.array([(2**64 - 1) ^ (2 ** (64 - 8 * k) - 1) for k in range(9)], dtype=np.uint64)  # the first k of eight bytes

COUNTS = "lang string, source string, term string, n long, docs long"
PARTS = "lang string, source string, item string, value long"


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array without nulls, and the offsets of its texts."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def term_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every term; no term goes over the edge of a text."""
    inside = _INSIDE[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1 - start


def sort_pointers(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of pointers: their order by term, bytes ascending, and where in it a new term begins.

    A slice, the pointers that agree in the bytes so far, is split by the next eight bytes as one unsigned number; shorter terms are
    filled up with zero bytes, which no term holds. All slices of a depth are split together.
    """
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    eight = np.ndarray(len(data) + 1, dtype=">u8", buffer=padded, strides=(1,))

    def character(at: np.ndarray, depth: int) -> np.ndarray:
        left = np.clip(length[at] - depth, 0, 8)
        return eight[np.minimum(start[at] + depth, len(data))].astype(np.uint64) & _KEEP[left]

    char = character(slice(None), 0)
    order = np.argsort(char, kind="quicksort")
    char = char[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = char[1:] != char[:-1]
    at = np.arange(len(order))
    depth = 8
    while len(at):
        # of the places looked at, those in slices of several pointers whose terms go on
        slice_of = np.cumsum(new[at]) - 1
        at_open = (char & np.uint64(255) != 0) & (np.bincount(slice_of)[slice_of] > 1)
        at, slice_of = at[at_open], slice_of[at_open]
        if not len(at):
            break
        if depth >= DEEP:
            _settle(data, start, length, order, new, at, slice_of)
            break
        char = character(order[at], depth)
        within = np.lexsort((char, slice_of))
        order[at] = order[at][within]
        char = char[within]
        new[at[1:]] |= char[1:] != char[:-1]
        depth += 8
    return order, new


def _settle(data, start, length, order, new, at, slice_of) -> None:
    """Order the slices that are left by their whole terms."""
    edges = np.flatnonzero(np.concatenate(([True], slice_of[1:] != slice_of[:-1], [True])))
    for a, b in zip(edges, edges[1:]):
        pointers = order[at[a:b]]
        terms = [data[start[p] : start[p] + length[p]].tobytes() for p in pointers]
        by_term = sorted(range(len(terms)), key=terms.__getitem__)
        order[at[a:b]] = pointers[by_term]
        for k in range(1, len(by_term)):
            new[at[a + k]] = terms[by_term[k]] != terms[by_term[k - 1]]


def _shard_counts(rows: pa.Table) -> pa.RecordBatch | None:
    """Occurrences and documents of each term in each language and source of a shard."""
    groups = pd.MultiIndex.from_arrays([rows["lang"].to_pandas(), rows["source"].to_pandas()])
    group_of, names = pd.factorize(groups)
    by_group = np.argsort(group_of, kind="stable")
    group_of = group_of[by_group]
    data, offsets = _bytes(rows["text"].take(pa.array(by_group)).combine_chunks())
    data = _LOWER[data]
    start, length = term_pointers(data, offsets)
    if not len(start):
        return None
    order, new = sort_pointers(data, start, length)
    first = order[new]
    document = np.searchsorted(offsets, start, side="right") - 1
    # equal runs: places of one term in one document, then of one term in one source
    n_docs = np.int64(len(rows))
    runs = (np.cumsum(new) - 1) * n_docs + document[order]
    runs.sort()
    edge = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
    times = np.diff(np.append(edge, len(runs)))
    term, group = runs[edge] // n_docs, group_of[runs[edge] % n_docs]
    edge = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (group[1:] != group[:-1]))))
    n, docs = np.add.reduceat(times, edge), np.diff(np.append(edge, len(term)))
    term, group = term[edge], group[edge]
    size = length[first]
    ends = np.concatenate(([0], np.cumsum(size)))
    flat = np.repeat(start[first] - ends[:-1], size) + np.arange(ends[-1])
    terms = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[flat])])
    lang, source = (pa.array(names.get_level_values(k), pa.string()).take(pa.array(group)) for k in (0, 1))
    return pa.RecordBatch.from_arrays(
        [lang, source, terms.take(pa.array(term)).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
        names=["lang", "source", "term", "n", "docs"],
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(shard):
        out = _shard_counts(pa.Table.from_batches(shard))
        if out is not None:
            yield from (out.slice(i, 100_000) for i in range(0, len(out), 100_000))

    shard, size = [], 0
    for batch in batches:
        for row in range(0, len(batch), 64):
            part = batch.slice(row, 64)
            if shard and size + part.nbytes > SHARD_BYTES:
                yield from counted(shard)
                shard, size = [], 0
            shard.append(part)
            size += part.nbytes
    if shard:
        yield from counted(shard)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) from every shard: a term of a source has as many rows as shards hold it."""
    text_batches(docs.sparkSession)
    return docs.select("lang", "source", "text").mapInArrow(_count, COUNTS)


def share(n: str, total: str) -> Column:
    """1 + floor(10^9 * (n + 5) / total) of two columns or numbers, exact."""
    return F.expr(f"1 + (cast(1000000000 as decimal(10,0)) * cast({n} + 5 as decimal(20,0))) div cast({total} as decimal(20,0))")


def _pair_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over the terms of a task, for a block of sources against all of their language.

    The rows without a term name the sources and their share of a term they do not hold.
    """
    named = rows[rows["term"].isna()].sort_values("source_no")
    held = rows[rows["term"].notna()]
    rare, sources = named["p"].to_numpy(), named["source"].to_numpy()
    lang, block = named["lang"].iloc[0], int(named["block"].iloc[0])
    own = np.arange(block * SOURCES_PER_TASK, min(len(sources), (block + 1) * SOURCES_PER_TASK))
    term, known = pd.factorize(held["term"])
    by_term = np.argsort(term, kind="stable")
    term, at, p = term[by_term], held["source_no"].to_numpy()[by_term], held["p"].to_numpy()[by_term]
    sums = np.zeros((len(own), len(sources)), dtype=np.int64)
    step = max(1, CELLS // len(sources))
    for low in range(0, len(known), step):
        a, b = np.searchsorted(term, [low, low + step])
        shares = np.tile(rare, (min(step, len(known) - low), 1))
        shares[term[a:b] - low, at[a:b]] = p[a:b]
        for k, i in enumerate(own):
            sums[k] += np.abs(shares - shares[:, i : i + 1]).sum(axis=0)
    i, j = np.nonzero(own[:, None] != np.arange(len(sources))[None, :])
    return pd.DataFrame({"lang": lang, "source": sources[own[i]], "item": sources[j], "value": sums[i, j]})


def audit_sources(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` ranks the other sources of a language by distance, part `term` the terms
    a source uses beyond its language, to rank `top`.

    docs has lang, source and text; other columns are ignored. Null text, lang and source count as ''. Every row is a document, so
    repeated rows count each; terms in fewer than least_docs documents of a language are not kept. A language without kept terms has
    its pairs at 0, a source alone in its language no pair, an empty table no rows. Ties rank by item, bytes ascending.
    """
    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    of_term = Window.partitionBy("lang", "term")
    met = term_counts(filled).repartition("lang", "term").withColumns(
        {"df": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term), "lead": F.min("source").over(of_term)}
    )
    kept = met.where(F.col("df") >= least_docs).groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.max("lang_n").alias("lang_n"), (F.max("lead") == F.col("source")).alias("lead")
    )
    kept = cut(kept)

    # a row for each language and source: as many as the square root of the result's pairs
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("N"), F.sum(F.col("lead").cast("long")).alias("leads"), F.count("*").alias("rows"))
    by_group = filled.select("lang", "source").distinct().join(by_group, ["lang", "source"], "left").fillna(0, ["N", "leads", "rows"])
    by_lang = by_group.groupBy("lang").agg(
        F.sum("N").alias("lang_N"), F.sum("leads").alias("V"), F.sum("rows").alias("lang_rows"), F.count("*").alias("sources")
    )
    groups = by_group.join(by_lang, "lang").select(
        "lang", "source", (F.col("N") + 5 * F.col("V")).alias("total"), (F.col("lang_N") + 5 * F.col("V")).alias("lang_total"),
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("source_no"),
        F.ceil((F.col("lang_rows") + 1) / ROWS_PER_TASK).cast("int").alias("buckets"),
        F.ceil(F.col("sources") / SOURCES_PER_TASK).cast("int").alias("blocks"),
    )
    groups = cut(groups)

    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share("n", "total"))
    return _pairs(shares, groups).unionByName(_terms(shares, top))


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """The other sources of a language by summed distance. Terms are dealt by hash, so a language of any size is many tasks."""
    absent = F.when(F.col("total") > 0, share("0", "total")).otherwise(0)
    blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    named = groups.select(
        "lang", "source", "source_no", F.lit(None).cast("string").alias("term"), absent.alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"), "blocks",
    )
    held = shares.select("lang", "source", "source_no", "term", "p", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket"), "blocks")
    dealt = named.unionByName(held).withColumn("block", blocks).drop("blocks")
    sums = dealt.groupBy("lang", "bucket", "block").applyInPandas(_pair_sums, PARTS)
    total = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return total.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _terms(shares: DataFrame, top: int) -> DataFrame:
    """The terms a source uses beyond its language, the first of each group; groups are cut to these before they meet."""
    more = shares.select("lang", "source", F.col("term").alias("item"), (F.col("p") - share("lang_n", "lang_total")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = more.where("value > 0").withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
