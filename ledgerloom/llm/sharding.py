"""Sharding by histogram sort, with DataFrame operations only.

Rows are ordered by a 128-bit key: a hash of the text, then a hash of the id. Splitters are found by counting exact
bytes below probes: a histogram over the next 12 key bits, first of all rows and then only of the intervals that hold a
splitter, until an edge lies within the tolerance of its target. At most `shards` x 4096 counts reach the driver in a
round, whatever the input. Then each row compares itself with the splitters and is exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.llm.common import cut

_BITS = 12
_SIGN = -(1 << 63)
#: (which half of the key, bits to the left of the digit, bits of the digit)
_DIGITS = [(half, at, min(_BITS, 64 - at)) for half in ("__hi", "__lo") for at in range(0, 64, _BITS)]


@dataclass
class _Open:
    """A splitter still looked for inside the interval of keys that start with `prefix`."""

    target: float
    prefix: tuple[int, ...]
    below: int


def _digit(half: str, at: int, bits: int) -> Column:
    return F.shiftrightunsigned(F.shiftleft(F.col(half), at), 64 - bits)


def _bound(prefix: tuple[int, ...], after: bool) -> int:
    """The 128-bit key at the left edge of a prefix, or just after it."""
    key, used = 0, 0
    for (_, _, bits), digit in zip(_DIGITS, prefix):
        key, used = (key << bits) | digit, used + bits
    return (key + after) << (128 - used)


def _as_signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def find_splitters(keys: DataFrame, shards: int, tolerance: float) -> tuple[list[int], int]:
    """Keys (as 128-bit numbers) at which shards 1.. begin, and the number of rows.

    keys: columns __hi, __lo and __size. A splitter is the first edge found within tolerance x (bytes of a mean shard) of its target;
    if the whole key is used up, the nearest edge.
    """
    total = rows = 0
    waiting: list[_Open] = []
    found: list[int] = []
    for level, digit in enumerate(_DIGITS):
        prefixes = sorted({o.prefix for o in waiting})
        part, frame = F.lit(0), keys
        if level:
            if not prefixes:
                break
            here = [
                F.lit(True) if not p else _all([_digit(*d) == v for d, v in zip(_DIGITS, p)]) for p in prefixes
            ]
            part = F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(here)])
            frame = keys.where(part.isNotNull())
        counted = (
            frame.groupBy(part.alias("part"), _digit(*digit).alias("digit"))
            .agg(F.sum("__size").alias("bytes"), F.count("*").alias("rows"))
            .collect()
        )
        histogram: dict[int, list[tuple[int, int]]] = {}
        for r in sorted(counted, key=lambda r: (r.part, r.digit)):
            histogram.setdefault(r.part, []).append((r.digit, r.bytes))
        if not level:
            total, rows = sum(r.bytes for r in counted), sum(r.rows for r in counted)
            if not rows:
                return [0] * (shards - 1), 0
            waiting = [_Open(total * i / shards, (), 0) for i in range(1, shards)]
            prefixes = [()]
        slack = tolerance * total / shards
        still: list[_Open] = []
        for o in waiting:
            below = o.below
            for value, size in histogram[prefixes.index(o.prefix)]:
                if below + size >= o.target:
                    break
                below += size
            left, right = o.target - below, below + size - o.target
            prefix = (*o.prefix, value)
            if min(left, right) <= slack or level == len(_DIGITS) - 1:
                found.append(_bound(prefix, after=right < left))
            else:
                still.append(_Open(o.target, prefix, below))
        waiting = still
    return sorted(found), rows


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _at_or_after(key: int) -> Column:
    if key >= 1 << 128:
        return F.lit(False)
    hi, lo = (F.lit(_as_signed((key >> shift) & (2**64 - 1)) ^ _SIGN) for shift in (64, 0))
    own_hi, own_lo = (F.col(c).bitwiseXOR(F.lit(_SIGN)) for c in ("__hi", "__lo"))
    return (own_hi > hi) | ((own_hi == hi) & (own_lo >= lo))


def shard_by_bytes(
    docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text", tolerance: float = 0.02, rows_per_run: int = 10_000
) -> DataFrame:
    """All columns of docs with size (UTF-8 bytes of the text plus 8), shard and slot (0, 1, .. without gaps in a shard).

    Shards have nearly equal bytes: each splitter lies within tolerance x a mean shard of its place, or half a row where
    no edge is so near. Equal texts are neighbours and stay in one shard unless a splitter finds no edge between groups
    within the tolerance, as inside a group larger than that; only then the group is cut, between ids. Null text counts 8 bytes; null
    ids sort together; rows equal in text and id share a key and stay together. An empty table gives an empty result.
    Columns of docs named size, shard or slot are replaced; names that begin with __ are reserved.

    Slots need no task that sees a whole shard: rows of a shard fall by hash into runs of about rows_per_run rows, each
    numbered by itself, from the count of the runs before it.
    """
    keyed = docs.withColumns(
        {
            "size": F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + F.lit(8),
            "__hi": F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull()),
            "__lo": F.xxhash64(F.col(doc_id)),
        }
    )
    keys = cut(keyed.select("__hi", "__lo", F.col("size").alias("__size")))
    splitters, rows = find_splitters(keys, shards, tolerance)
    shard = F.lit(0)
    for key in splitters:
        shard = shard + _at_or_after(key).cast("int")
    runs = max(1, -(-rows // (shards * rows_per_run)))
    place = {"shard": shard, "__run": F.pmod(F.xxhash64("__hi", "__lo"), F.lit(runs))}
    before = Window.partitionBy("shard").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keys.withColumns(place)
        .groupBy("shard", "__run")
        .count()
        .select("shard", "__run", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"))
    )
    in_run = Window.partitionBy("shard", "__run").orderBy("__hi", "__lo", F.col(doc_id))
    return (
        keyed.withColumns(place)
        .withColumn("__at", F.row_number().over(in_run))
        .join(offsets, ["shard", "__run"])
        .withColumn("slot", (F.col("__offset") + F.col("__at") - 1).cast("long"))
        .drop("__hi", "__lo", "__run", "__at", "__offset")
    )
