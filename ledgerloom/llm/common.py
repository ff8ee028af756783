"""Helpers the operators share: words, hashes of words, cut lineage, components."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of bytes other than blank, \t, \n, \v, \f and \r: what bytes.split() gives.
WORD = r"[^\x20\x09-\x0D]+"

_CHUNK = 1 << 18  # bytes hashed at once
_LONG = 512  # longer words get xxHash64, as a polynomial modulo 2**64 is weak on very long ones
_BASE = 0x9E3779B97F4A7C15 | 5
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def words(text: str | None) -> list[bytes]:
    """The words of a text in order; none for null."""
    return text.encode().split() if text else []


def n_words(text: Column) -> Column:
    """The same count inside a Spark plan."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_CHUNK, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[size] = tuple(
            np.cumprod(np.concatenate((np.ones(1, dtype=np.uint64), np.full(size, base, dtype=np.uint64))), dtype=np.uint64)
            for base in (_BASE, inverse)
        )
    return _POWERS[size]


def _hash_block(block: bytes, starts_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of one block, and the piece each word lies in."""
    data = np.frombuffer(block, dtype=np.uint8)
    inside = ~_BLANK[data]
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    power, inverse = _powers(len(data))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE_VALUES[data] * power[: len(data)])))
    hashes = mix((sums[end] - sums[start]) * inverse[start])
    for i in np.flatnonzero(end - start > _LONG):
        hashes[i] = xxhash.xxh64_intdigest(block[start[i] : end[i]])
    return hashes, np.searchsorted(starts_of, start, side="right") - 1


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ranges of a block of bytes, equal for equal ranges of any block."""
    power, inverse = _powers(len(data))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE_VALUES[data] * power[: len(data)])))
    hashes = mix((sums[end] - sums[start]) * inverse[start])
    for i in np.flatnonzero(end - start > _LONG):
        hashes[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]].tobytes())
    return hashes


def pieces_of(texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of whole words, of about a quarter of a megabyte or one longer word: bytes, the same in lower case, the text of each piece
    of a block, and where the pieces begin. Lower case must not change the number of bytes of any character."""
    block: list[tuple[int, bytes, bytes]] = []
    size = 0

    def joined():
        data, low = (np.frombuffer(b" ".join(x), dtype=np.uint8) for x in ([b for _, b, _ in block], [c for _, _, c in block]))
        starts = np.concatenate(([0], np.cumsum([len(b) + 1 for _, b, _ in block])[:-1])).astype(np.int64)
        return data, low, np.array([n for n, _, _ in block], dtype=np.int64), starts

    for n, text in enumerate(texts):
        data, low = text.encode(), text.lower().encode()
        at = 0
        while at < len(data):
            end = len(data)
            if end - at > _CHUNK:
                window = data[at : at + _CHUNK]
                cuts = [window.rfind(b) for b in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")]
                if max(cuts) > 0:
                    end = at + max(cuts)
                else:  # a word longer than a block
                    found = [x for b in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f") if (x := data.find(b, at + 1)) >= 0]
                    end = min(found, default=len(data))
            block.append((n, data[at:end], low[at:end]))
            size += end - at + 1
            at = end
            if size >= _CHUNK:
                yield joined()
                block, size = [], 0
    if block:
        yield joined()


def word_hashes(texts: Iterable[str | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of some texts, and offsets: text i has words offsets[i]:offsets[i + 1].

    lower: A-Z are lower-cased first. Texts of any length are hashed in blocks of about a quarter of a megabyte.
    """
    pieces: list[tuple[int, bytes]] = []
    n = 0
    for n, text in enumerate(texts, 1):
        data = (text or "").encode()
        data = data.lower() if lower else data
        while len(data) > _CHUNK:
            head = data[:_CHUNK].rsplit(None, 1)[0] if len(data[:_CHUNK].split(None, 1)) > 1 else data.split(None, 1)[0]
            cut = data.find(head) + len(head)
            pieces.append((n - 1, data[:cut]))
            data = data[cut:]
        pieces.append((n - 1, data))
    hashes, owners = [], []
    block: list[bytes] = []
    of: list[int] = []
    size = 0
    for i, (owner, data) in enumerate(pieces):
        block.append(data)
        of.append(owner)
        size += len(data) + 1
        if size >= _CHUNK or i == len(pieces) - 1:
            lengths = np.array([len(b) + 1 for b in block], dtype=np.int64)
            h, piece = _hash_block(b" ".join(block), np.concatenate(([0], np.cumsum(lengths)[:-1])))
            hashes.append(h)
            owners.append(np.asarray(of, dtype=np.int64)[piece])
            block, of, size = [], [], 0
    owner = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))).astype(np.int64)
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)), offsets


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += hashes[j : n + j]
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def batches(frames: Iterator, rows: int) -> Iterator:
    """Cut incoming pandas frames to at most so many rows, to bound what a task holds."""
    for frame in frames:
        for i in range(0, len(frame), rows):
            yield frame.iloc[i : i + rows]


def sorted_groups(frames: Iterator, keys: list[str]) -> Iterator:
    """Whole groups, as frames, from a partition sorted by the keys; groups may span incoming frames."""
    rest = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        new = (frame[keys].iloc[1:].to_numpy() != frame[keys].iloc[:-1].to_numpy()).any(axis=1)
        edges = [0, *(np.flatnonzero(new) + 1)]
        for a, b in zip(edges, edges[1:]):
            yield frame.iloc[a:b]
        rest = frame.iloc[edges[-1] :]
    if rest is not None and len(rest):
        yield rest


def whole_groups(frames: Iterator, keys: list[str]) -> Iterator:
    """Frames of many whole groups each, from a partition sorted by the keys."""
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        last = (frame[keys] == frame[keys].iloc[-1]).all(axis=1).to_numpy()
        first = len(frame) - int(last[::-1].argmin()) if not last.all() else 0
        if first:
            yield frame.iloc[:first]
        rest = frame.iloc[first:]
    if rest is not None and len(rest):
        yield rest


def block_tasks(rows: DataFrame, group: list[str], row: str, block_rows: int) -> DataFrame:
    """Deal the rows of each group to tasks (i, j), i <= j, of two blocks of about block_rows rows at most; block tells a row's own.

    All pairs of rows of a group meet in a task: those of one block in (i, i), others in (i, j). A group of one block has one task.
    Groups of a single row get none.
    """
    sizes = rows.groupBy(*group).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1").drop("n")
    placed = rows.join(sizes, group).withColumn("block", F.pmod(F.xxhash64(row), F.col("blocks")).cast("int"))
    with_all = F.expr("transform(sequence(0, blocks - 1), j -> struct(least(block, j) as i, greatest(block, j) as j))")
    return placed.withColumn("at", F.explode(with_all)).withColumns({"i": F.col("at.i"), "j": F.col("at.j")}).drop("at", "blocks")


class Roots:
    """Components of ids met in a partition: each known id points to a smaller one, or to itself."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up, root = self.up, x
        while (above := up.get(root, root)) != root:
            root = above
        while x != root:
            up[x], x = root, up[x]
        return root

    def unite(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def stars(self) -> pd.DataFrame:
        """One edge from each id to the smallest of its component."""
        src = list(self.up)
        return pd.DataFrame({"src": np.array(src, dtype=np.int64), "dst": np.array([self.find(x) for x in src], dtype=np.int64)})


class Union:
    """Components among the rows of a task: smallest index per component, hooked in batches."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, a: np.ndarray, b: np.ndarray, at_once: bool = False) -> None:
        apart = self.label[a] != self.label[b]
        if apart.any():
            self.waiting.append((a[apart], b[apart]))
            self.size += int(apart.sum())
        if self.size > 500_000 or (at_once and self.size):
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        a, b = (np.concatenate(x) for x in zip(*self.waiting))
        while True:
            la, lb = self.label[a], self.label[b]
            if (la == lb).all():
                break
            low = np.minimum(la, lb)
            np.minimum.at(self.label, la, low)
            np.minimum.at(self.label, lb, low)
            while not np.array_equal(self.label, self.label[self.label]):
                self.label = self.label[self.label]
        self.waiting, self.size = [], 0


def text_batches(spark: SparkSession, rows: int = 500) -> None:
    """Send texts to Python tasks in batches of so many rows at most: Spark's 10,000 whole texts at once fill a worker's memory.

    The setting has to last until the lazy plan runs, so it stays in the session.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def shared_folder(spark: SparkSession) -> None:
    """Make sure that checkpoints have a folder: spark.checkpoint.dir, or a local one where a local session sets none."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerloom-checkpoints-")
    context.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Compute a frame once and keep it in the shared folder, so that lost executors cost no recomputation of what led to it."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): the smallest node id reachable over undirected edges, for every node that has an edge.

    Alternates large-star and small-star rounds until no edge changes; the number of rounds grows with the logarithm of
    the longest chain. Rows meet by node only, with minima combined before the shuffle and skewed join sides split by
    Spark, and no neighbour list is ever collected. Nulls and self-links are ignored.
    """
    links = cut(
        edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    mark = None
    while True:
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).union(low.select("u", "low")).where("u <> v").distinct()
        )
        links = cut(small)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select("v", "v").distinct()
    )
