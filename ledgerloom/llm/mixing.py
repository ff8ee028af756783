"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source is taken target / source size times on average: a whole number of copies that all documents of
the source get, and a fraction that is rounded to 0 or 1 dependently. Two documents with fractions p, q and sizes s, t
move words between each other: the sum p s + q t stays, one of both fractions becomes 0 or 1, and which way it goes is
drawn so that expectations stay. A leaf of documents leaves at most one with a fraction; those meet in the next level
of a reduction tree. What the last unit of a source leaves is moved into short ones, so that each source misses its target by less
than a few of its shortest documents.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut, mix

#: A table of sources up to so many rows is broadcast; a longer one is joined by shuffle.
BROADCAST_SOURCES = 20_000
#: Units of each order of size and decision of a source that may take up what the last rounding leaves.
SWAPS = 64
_ROUNDED = "source_no int, bucket long, key long, size long, words double, extra int"


def targets(sizes: dict[str | None, int], weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Words to take from each source: share x all words by weight, none above most x its own, the excess spread by weight again.

    Sources in code point order, null last, take the weights in turn.
    """
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out = dict.fromkeys(order, 0.0)
    free, left = list(order), share * sum(sizes.values())
    while free and left > 0:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if weight[s] * unit >= most * sizes[s]]
        if not full:
            return out | {s: weight[s] * unit for s in free}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        free = [s for s in free if s not in set(full)]
    return out


def pivot(key: np.ndarray, size: np.ndarray, words: np.ndarray, level: int, seed: int, last: bool) -> tuple[list[int], list[float]]:
    """Decisions (1, 0, or -1: none yet, for one unit at most) for units in order, and their words afterwards.

    words is fraction x size, 0 < words < size. With last, the unit left over is drawn by its own fraction.
    """
    salt = np.uint64((seed * 1_000_003 + level) & (2**64 - 1))
    draws = ((mix(mix(key.view(np.uint64)) + salt) >> np.uint64(11)).astype(float) / 2.0**53).tolist()
    size, words = size.tolist(), words.tolist()
    extra = [-1] * len(size)
    a = -1
    for b, draw in enumerate(draws):
        if a < 0:
            a = b
            continue
        room_a, have_a, room_b, have_b = size[a] - words[a], words[a], size[b] - words[b], words[b]
        up, down = min(room_a, have_b), min(have_a, room_b)  # words that may go from b to a, or from a to b
        if draw * (up + down) < down:
            words[a], words[b] = have_a + up, have_b - up
            extra[a], extra[b] = 1 if room_a <= up else -1, 0 if have_b <= up else -1
        else:
            words[a], words[b] = have_a - down, have_b + down
            extra[a], extra[b] = 0 if have_a <= down else -1, 1 if room_b <= down else -1
        a = a if extra[a] < 0 else b if extra[b] < 0 else -1
    if a >= 0 and last:
        extra[a] = int(draws[a] * size[a] < words[a])
    return extra, words


def _rounder(level: int, seed: int, last: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["key", "size"], kind="stable")
        extra, words = pivot(frame["key"].to_numpy(), frame["size"].to_numpy(), frame["words"].to_numpy(), level, seed, last)
        return frame.assign(extra=extra, words=words)

    return run


def mix_sources(
    docs: DataFrame,
    size: str = "size",
    key: str = "key",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 9,
    leaf_rows: int = 2_000,
    fan_in: int = 256,
) -> DataFrame:
    """All columns of docs with source_size, target (its source's), copies and taken (copies x size).

    key: a hash of the row, best of id and text; rows of a source with one key are one unit and get the same copies, so
    repeated rows and colliding hashes are safe. Copies are at most `most`, rounded up. Reruns agree: order and draws depend
    on keys only. Null source is a source of its own; null size counts 0; rows of size 0 get no rounding and
    the whole copies only. An empty table gives an empty result. Columns of docs with the new names are replaced.

    The driver holds one row per source. Leaves are buckets of about leaf_rows units of one source, so a
    source of any share spreads over as many tasks as it has rows.
    """
    spark = docs.sparkSession
    own = docs.drop("source_size", "target", "copies", "taken").withColumn("__size", F.coalesce(F.col(size), F.lit(0)).cast("long"))
    units = cut(own.groupBy(F.col(source).cast("string").alias("source"), F.col(key).alias("key")).agg(F.sum("__size").alias("size")))
    sums = units.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("units")).collect()
    total = {r["source"]: r["size"] for r in sums}
    wanted = targets(total, weights, share, most)
    rates, buckets = [], 1
    for no, r in enumerate(sorted(sums, key=lambda r: (r["source"] is None, r["source"]))):
        rate = wanted[r["source"]] / r["size"] if r["size"] else 0.0
        n = max(1, -(-r["units"] // leaf_rows))
        buckets = max(buckets, n)
        rates.append((no, r["source"], r["size"], wanted[r["source"]], int(rate), rate - int(rate), n))
    table = spark.createDataFrame(rates, "__no int, __of string, source_size long, target double, __whole int, __part double, __leaves int")
    table = F.broadcast(table) if len(rates) <= BROADCAST_SOURCES else table
    state = (
        units.join(table, F.col("source").eqNullSafe(F.col("__of")))
        .where("size > 0 and __part > 0")
        .select(
            F.col("__no").alias("source_no"), F.pmod(F.xxhash64("key"), F.col("__leaves")).cast("long").alias("bucket"), "key", "size",
            (F.col("size") * F.col("__part")).alias("words"), F.lit(-1).alias("extra"),
        )
    )
    rounded, level = None, 0
    while True:
        last = buckets == 1
        done = cut(state.groupBy("source_no", "bucket").applyInPandas(_rounder(level, seed, last), _ROUNDED))
        ready = done.where("extra >= 0").select("source_no", "key", "size", "extra")
        rounded = ready if rounded is None else rounded.union(ready)
        if last:
            break
        level, buckets = level + 1, -(-buckets // fan_in)
        state = done.where("extra < 0").withColumn("bucket", F.floor(F.col("bucket") / fan_in).cast("long"))
    placed = own.join(table, F.col(source).cast("string").eqNullSafe(F.col("__of")))
    rounded = _settled(rounded, table).select(F.col("source_no").alias("__rounded_no"), F.col("key").alias("__key"), F.col("extra").alias("__extra"))
    out = placed.join(rounded, (F.col("__no") == F.col("__rounded_no")) & F.col(key).eqNullSafe(F.col("__key")), "left")
    copies: Column = F.col("__whole") + F.coalesce("__extra", F.lit(0))
    return out.withColumns({"copies": copies, "taken": copies * F.col("__size")}).drop(
        "__no", "__of", "__whole", "__part", "__leaves", "__rounded_no", "__key", "__extra", "__size"
    )


def _settled(rounded: DataFrame, table: DataFrame) -> DataFrame:
    """The decisions with what a source still misses its target by moved into its small units.

    The last unit of a source to be rounded may be a long document. The words it adds or lacks are made up by turning the decisions of
    other units, a few of each order of size, in one task for each source.
    """
    got = rounded.groupBy("source_no").agg(F.sum(F.col("extra") * F.col("size")).alias("got"))
    gap = table.join(got, F.col("__no") == F.col("source_no")).select(
        F.col("source_no").alias("gap_no"), (F.col("source_size") * F.col("__part") - F.col("got")).alias("gap")
    )
    open_ = rounded.join(gap, F.col("source_no") == F.col("gap_no")).where("abs(gap) >= 1")
    order = Window.partitionBy("source_no", "extra", F.length(F.bin("size"))).orderBy("size", "key")
    few = open_.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SWAPS)
    few = few.select("source_no", "key", "size", "extra", "gap")
    turned = few.groupBy("source_no").applyInPandas(_turned, "turned_no int, turned_key long")
    same = (F.col("source_no") == F.col("turned_no")) & F.col("key").eqNullSafe(F.col("turned_key"))
    return rounded.join(turned, same, "left").withColumn("extra", F.when(F.col("turned_no").isNotNull(), 1 - F.col("extra")).otherwise(F.col("extra")))


def turns(size: list[int], extra: list[int], gap: float) -> list[int]:
    """Which decisions to turn, so that the words taken grow by about gap; each at most once.

    The longest unit that fits goes first. Where none fits, the shortest that goes beyond the gap may be turned if units of the other kind
    can bring the sum back. What came nearest to the gap counts.
    """
    free = [sorted((i for i in range(len(size)) if extra[i] == e), key=lambda i: (size[i], i)) for e in (0, 1)]
    turned: list[int] = []
    best, best_at = abs(gap), 0
    while abs(gap) >= 1:
        side = 0 if gap > 0 else 1
        fits = [i for i in free[side] if size[i] <= abs(gap)]
        if fits:
            pick = fits[-1]
        else:
            beyond = next((i for i in free[side] if size[i] > abs(gap)), None)
            if beyond is None:
                break
            over = size[beyond] - abs(gap)
            if sum(size[i] for i in free[1 - side] if size[i] <= over) < over - best:
                break
            pick = beyond
        free[side].remove(pick)
        turned.append(pick)
        gap += -size[pick] if side == 0 else size[pick]
        if abs(gap) < best:
            best, best_at = abs(gap), len(turned)
    return turned[:best_at]


def _turned(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values(["size", "key", "extra"], kind="stable")
    picked = frame.iloc[turns(frame["size"].tolist(), frame["extra"].tolist(), float(frame["gap"].iloc[0]))]
    return pd.DataFrame({"turned_no": picked["source_no"], "turned_key": picked["key"]})
