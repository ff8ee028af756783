"""Vector code compression: product codes of integer parts, learnt and assigned by lexicographic tries.

A vector is cut into equal parts, and each part gets the number of the nearest entry in its position's codebook. A task sorts the
distinct parts of its rows, position by position, which is the order of a trie whose levels are the dimensions. The trie is walked
depth first in subtrees of bounded size: a prefix carries its distances to all entries, accumulated once for everything below it, and
at the leaves stand the nearest entry and the sums for the next codebook, weighted by how many rows share the part. Only the sums, as
many as the codebooks have entries and tasks, leave a task. All arithmetic is on whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
LARGEST = 1 << 20  # components of this size or more are not coded: squared distances would leave 64 bits
ROWS_AT_ONCE = 1 << 16  # rows whose parts share a trie
SUBTREE = 1 << 12  # leaves of a subtree that is walked at once


@dataclass(frozen=True)
class Codebooks:
    """entries[position, entry, component]: a fixed number of whole numbers."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Over the decimal components by position, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def whole_vectors(vectors: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors can be coded, and their components as floor(256 * x).

    A vector can be coded if it is there, has dims components (any number where dims is None, as long as all agree with the first),
    a whole number in each part, none null, not finite or as large as 2^20.
    """
    vectors = vectors.cast(pa.large_list(pa.float64()))
    offsets = np.asarray(vectors.offsets.to_numpy(zero_copy_only=False), dtype=np.int64)
    there = np.ones(len(vectors), dtype=bool) if vectors.null_count == 0 else vectors.is_valid().to_numpy(zero_copy_only=False)
    values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)  # null components become NaN
    size = np.diff(offsets)
    if dims is None:
        dims = int(size[there][0]) if there.any() else 0
    good = there & (size == dims) & (dims > 0) & (dims % PARTS == 0)
    rows = np.flatnonzero(good)
    matrix = values[offsets[rows][:, None] + np.arange(dims)] if len(rows) else np.zeros((0, dims))
    with np.errstate(invalid="ignore"):
        fits = (np.abs(matrix) < LARGEST).all(axis=1)  # false for NaN and infinities
    good[rows[~fits]] = False
    return good, np.floor(matrix[fits] * SCALE).astype(np.int64)


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of a matrix in lexicographic order, and which of them each row is."""
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    new = np.ones(len(parts), dtype=bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    leaf = np.empty(len(parts), dtype=np.int64)
    leaf[order] = np.cumsum(new) - 1
    return ordered[new], leaf


def walk(leaves: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry, the first of equally near ones, and its squared distance for every leaf of a sorted trie.

    Subtrees are taken in depth-first order. Within one, a level adds its dimension's squares to the distances of the prefixes above.
    """
    nearest, error = np.empty(len(leaves), dtype=np.int64), np.empty(len(leaves), dtype=np.int64)
    for low in range(0, len(leaves), SUBTREE):
        block = leaves[low : low + SUBTREE]
        opens = np.zeros(len(block), dtype=bool)  # where a new prefix begins
        opens[0] = True
        prefix = np.zeros(len(block), dtype=np.int64)
        distance = np.zeros((1, len(entries)), dtype=np.int64)
        for level in range(leaves.shape[1]):
            opens[1:] |= block[1:, level] != block[:-1, level]
            at = np.flatnonzero(opens)
            gap = block[at, level][:, None] - entries[:, level][None, :]
            distance = distance[prefix[at]] + gap * gap
            prefix = np.cumsum(opens) - 1
        best = distance.argmin(axis=1)
        nearest[low : low + SUBTREE] = best[prefix]
        error[low : low + SUBTREE] = distance[np.arange(len(best)), best][prefix]
    return nearest, error


def _collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Incoming batches, joined to blocks of about ROWS_AT_ONCE rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= ROWS_AT_ONCE:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _vectors(block: pa.Table, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    return whole_vectors(block["embedding"].combine_chunks(), books.entries.shape[0] * books.entries.shape[2])


def _sums_by(books: Codebooks):
    positions, entries, width = books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((positions, entries), dtype=np.int64)
        total = np.zeros((positions, entries, width), dtype=np.int64)
        for block in _collected(batches):
            _, vectors = _vectors(block, books)
            for position in range(positions):
                leaves, leaf = distinct_parts(vectors[:, position * width : (position + 1) * width])
                weight = np.bincount(leaf, minlength=len(leaves))
                nearest, _ = walk(leaves, books.entries[position])
                np.add.at(count[position], nearest, weight)
                np.add.at(total[position], nearest, leaves * weight[:, None])
        position, entry = np.nonzero(count)
        if len(position):
            yield pa.RecordBatch.from_arrays(
                [pa.array(position, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[position, entry]),
                 pa.array(list(total[position, entry]), pa.list_(pa.int64()))],
                names=["position", "entry", "n", "total"],
            )

    return sums


def _codes_by(books: Codebooks):
    positions, _, width = books.entries.shape

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _collected(batches):
            good, vectors = _vectors(block, books)
            code = np.empty((len(vectors), positions), dtype=np.uint8)
            error = np.zeros(len(vectors), dtype=np.int64)
            for position in range(positions):
                leaves, leaf = distinct_parts(vectors[:, position * width : (position + 1) * width])
                nearest, far = walk(leaves, books.entries[position])
                code[:, position] = nearest[leaf]
                error += far[leaf]
            kept = block.select(["vec_id", "label"]).filter(pa.array(good)).combine_chunks()
            made = kept.append_column("code", pa.array([row.tobytes().hex() for row in code], pa.string()))
            yield from made.append_column("error", pa.array(error, pa.int64())).to_batches(max_chunksize=10_000)

    return codes


def next_entries(books: Codebooks, sums: list) -> Codebooks:
    """Each entry that was used becomes the floor of the mean of its parts; the others stay."""
    entries = books.entries.copy()
    for row in sums:
        entries[row["position"], row["entry"]] = [int(t) // int(row["n"]) for t in row["total"]]
    return Codebooks(entries)


def first_entries(vectors: DataFrame, entries: int = ENTRIES) -> Codebooks | None:
    """The parts of the vectors of the smallest ids; None where nothing can be coded. Reads at most `entries` rows to the driver.

    The first vector by id that could be coded on its own sets the number of components. Null ids come last, equal ids by vector.
    """
    usable = F.size("embedding") > 0
    usable &= F.size("embedding") % PARTS == 0
    usable &= F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < LARGEST))  # false for NaN, as it is the largest
    by_id = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    lowest = vectors.where(usable).select("vec_id", "embedding")
    first = lowest.orderBy(*by_id).limit(1).collect()
    if not first:
        return None
    dims = len(first[0]["embedding"])
    chosen = lowest.where(F.size("embedding") == dims).orderBy(*by_id).limit(entries).collect()
    _, whole = whole_vectors(pa.array([r["embedding"] for r in chosen], pa.list_(pa.float64())), dims)
    return Codebooks(np.ascontiguousarray(whole.reshape(len(whole), PARTS, dims // PARTS).transpose(1, 0, 2)))


def learn(vectors: DataFrame, books: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """Rounds of assigning all parts and moving the entries. The driver gets one row per position and entry."""
    for _ in range(rounds):
        width = books.entries.shape[2]
        sums = vectors.select("embedding").mapInArrow(_sums_by(books), "position int, entry int, n long, total array<long>")
        exact = [F.sum(F.col("total")[k].cast("decimal(38,0)")).alias(f"t{k}") for k in range(width)]
        merged = sums.groupBy("position", "entry").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), *exact)
        books = next_entries(books, merged.select("position", "entry", "n", F.array(*[f"t{k}" for k in range(width)]).alias("total")).collect())
    return books


def compress_vectors(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every vector that can be coded.

    vectors has vec_id, embedding and label; other columns are ignored. Null vectors, those with null or non-finite components, of
    another length than the one of the smallest id, of a length that sixteen does not divide, or with a component of 2^20 or more have
    no row; where none is left, the result is empty. Repeated rows have a row each; rows without id or label are coded like others,
    and null labels sum their errors together. Among equally near entries the first counts. With fewer vectors than entries the
    codebooks have that many.
    """
    vectors = vectors.select("vec_id", "embedding", "label")
    coded_type = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, label {vectors.schema['label'].dataType.simpleString()}, code string, error long"
    books = first_entries(vectors)
    if books is None:
        coded, sha = vectors.limit(0).selectExpr("vec_id", "label", "'' as code", "0L as error"), ""
    else:
        books = learn(vectors, books, rounds)
        coded, sha = cut(vectors.mapInArrow(_codes_by(books), coded_type)), books.sha256()
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    by_label = by_label.select(F.col("label").alias("of_label"), "label_error")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
