"""N-gram Jaccard join with count-vector R-trees.

A document is its set of hashed n-grams of words. Grams fall into groups by hash; the counts per group are a point, and
the sum of coordinate minima of two points bounds the overlap of the sets from above. Points are packed into R-trees whose
nodes keep coordinate maxima and the smallest set size, so that a pair of nodes is dropped when even the maxima can't reach the
overlap that the threshold asks for.

To spread this over tasks without loss: sets with Jaccard similarity >= t share a gram among the first
n - ceil(t n) + 1 of each, in any order of grams that holds for all; the order here is by hash, after grams that a
bounded sample shows to be frequent (which is about speed only). In each bucket of a gram that several sets share an R-tree
join finds the pairs that pass the bound and emits their local components, never the pairs. Sets so connected form a
family. In a family the join is repeated with as many groups as the set sizes need for a sharp bound, which splits it, and
then once more with the whole texts, where survivors are verified exactly; again only local components come out.
Large buckets and families are cut into blocks, all pairs of which meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    Roots, Union, batches, block_tasks, components, cut, mix, shingles, signed, sorted_groups, text_batches, whole_groups, word_hashes,
)

#: Documents whose grams are counted to find frequent ones, and how many of those are kept: bounds of what is broadcast.
SAMPLE, FREQUENT = 5_000, 20_000
#: Bits of the filter that keeps texts without family out of a shuffle: a megabyte, whatever the input.
FILTER_BITS = 1 << 23
GROUPS, FINE_GROUPS, _LEAF, _FAN = 64, 256, 32, 16


def gram_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct k-grams of a text's word hashes, sorted; the whole sequence as one gram where it is shorter."""
    return np.unique(shingles(hashes, min(k, len(hashes)))) if len(hashes) else hashes


def count_vector(grams: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount((mix(grams) % np.uint64(groups)).astype(np.int64), minlength=groups)


def fine_groups(n: int) -> int:
    """Groups for a set of n grams: a power of two, about one group for eight grams, and no fewer than the coarse ones."""
    return GROUPS << max(0, (n - 1) // 512).bit_length()


def fold(vector: np.ndarray, groups: int) -> np.ndarray:
    """The count vector over fewer groups, a divisor of what it has."""
    return vector.reshape(-1, groups).sum(axis=0)


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap with 100 x overlap >= percent x union, for set sizes a and b."""
    return -(-percent * (a + b) // (100 + percent))


def _bounds(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.minimum(x[:, None, :], y[None, :, :]).sum(axis=2, dtype=np.int64)


class RTree:
    """Points packed in order of set size and of the group with most of the set, bottom up; nodes are runs of that order."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rows: np.ndarray):
        order = np.lexsort((points[rows].argmax(axis=1), sizes[rows]))
        self.rows = rows[order]
        at = np.arange(0, len(rows), _LEAF)
        tops, least = np.maximum.reduceat(points[self.rows], at, axis=0), np.minimum.reduceat(sizes[self.rows], at)
        most = np.maximum.reduceat(sizes[self.rows], at)
        self.levels = [(tops, least, most)]
        while len(tops) > 1:
            at = np.arange(0, len(tops), _FAN)
            tops, least, most = np.maximum.reduceat(tops, at, axis=0), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.append((tops, least, most))

    def leaf(self, i: int) -> np.ndarray:
        return self.rows[i * _LEAF : (i + 1) * _LEAF]

    def children(self, level: int, i: int) -> range:
        return range(i * _FAN, min((i + 1) * _FAN, len(self.levels[level - 1][1])))


def _may_match(x: tuple, i: np.ndarray, y: tuple, j: np.ndarray, percent: int) -> np.ndarray:
    bound = _bounds(x[0][i], y[0][j])
    needed = _needed(x[1][i][:, None], y[1][j][None, :], percent)
    near = (100 * x[2][i][:, None] >= percent * y[1][j][None, :]) & (100 * y[2][j][None, :] >= percent * x[1][i][:, None])
    return (bound >= needed) & near


def tree_join(points: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray | None, percent: int, union: Union, accept=None, finer=None) -> None:
    """Unite rows whose count vectors allow a link: pairs of left x right, or inside left where right is None.

    finer, if given, is a sharper test of all pairs of two leaves, accept one of a single pair. Pairs already in one
    component are passed over: they can't change the result. Few rows are one leaf.
    """
    def leaves(x: np.ndarray, y: np.ndarray, same: bool) -> None:
        apart = union.label[x][:, None] != union.label[y][None, :]
        if same:
            apart &= ~np.tri(len(x), dtype=bool)
        if not apart.any():
            return
        whole = (points, sizes, sizes)
        hit = _may_match(whole, x, whole, y, percent) & apart
        if finer is not None and hit.any():
            hit &= finer(x, y)
        for p, q in zip(*np.nonzero(hit)):
            u, v = x[p], y[q]
            if union.label[u] != union.label[v] and (accept is None or accept(u, v)):
                union.add(np.array([u]), np.array([v]), at_once=True)

    if right is None and len(left) <= _LEAF:
        leaves(left, left, True)
        return
    a = RTree(points, sizes, left)
    b = a if right is None else RTree(points, sizes, right)
    stack = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        if la or lb:
            deeper_a = la >= lb
            own = np.array(a.children(la, i)) if deeper_a else np.array([i])
            other = np.array([j]) if deeper_a else np.array(b.children(lb, j))
            na, nb = (la - 1, lb) if deeper_a else (la, lb - 1)
            for p, q in zip(*np.nonzero(_may_match(a.levels[na], own, b.levels[nb], other, percent))):
                if right is not None or _first_row(na, own[p]) <= _last_row(nb, other[q]):
                    stack.append((na, int(own[p]), nb, int(other[q])))
            continue
        leaves(a.leaf(i), b.leaf(j), right is None and i == j)


def _first_row(level: int, node: int) -> int:
    return node * _LEAF * _FAN**level


def _last_row(level: int, node: int) -> int:
    return (node + 1) * _LEAF * _FAN**level - 1


def _described(k: int, percent: int, frequent):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        late = frequent.value
        for frame in batches(frames, 256):
            hashes, offsets = word_hashes(frame["text"], lower=True)
            out = []
            for i in range(len(frame)):
                grams = gram_set(hashes[offsets[i] : offsets[i + 1]], k)
                n = len(grams)
                take = n - -(-percent * n // 100) + 1
                if n and len(late):
                    common = late[np.minimum(np.searchsorted(late, grams), len(late) - 1)] == grams
                    first = np.concatenate([grams[~common], grams[common]])[:take]
                else:
                    first = grams[:take]
                out.append(
                    (n, int(signed(mix(grams).sum(keepdims=True))[0]) if n else 0, int(signed(np.bitwise_xor.reduce(mix(grams ^ np.uint64(77)), keepdims=True))[0]) if n else 0,
                     count_vector(grams, GROUPS).astype("<u4").tobytes(), count_vector(grams, fine_groups(n)).astype("<u2").tobytes() if n else b"",
                     signed(first) if n else np.zeros(0, dtype=np.int64))
                )
            yield pd.DataFrame(out, columns=["n_shingles", "h1", "h2", "point", "fine", "first"]).assign(doc_id=frame["doc_id"].to_numpy())

    return run


def _points(column: pd.Series, groups: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<u4").reshape(-1, groups).astype(np.int32)


def _halves(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray | None]:
    i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
    block = frame["block"].to_numpy()
    return np.flatnonzero(block == i), None if i == j else np.flatnonzero(block == j)


def _star(rep: np.ndarray, union: Union) -> pd.DataFrame:
    """One edge from each row to the smallest id of its component; none for rows alone."""
    union.settle()
    low = np.full(len(rep), np.iinfo(np.int64).max)
    np.minimum.at(low, union.label, rep)
    low = low[union.label]
    return pd.DataFrame({"src": rep[rep != low], "dst": low[rep != low]})


def _in_buckets(percent: int):
    """Components of each partition's buckets: one leaf for small ones, all of a frame at once, and R-trees for others."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roots = Roots()
        for frame in whole_groups(frames, ["gram", "i", "j"]):
            rep, sizes = frame["rep"].to_numpy(), frame["n_shingles"].to_numpy()
            points = _points(frame["point"], GROUPS)
            key = frame[["gram", "i", "j"]].to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1), [True])))
            bucket = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
            small = (np.diff(edges) <= _LEAF) & (frame["i"].to_numpy() == frame["j"].to_numpy())[edges[:-1]]
            root = np.array([roots.find(r) for r in rep.tolist()])
            rows = np.flatnonzero(small[bucket])
            for shift in range(1, _LEAF):
                a, b = rows[:-shift], rows[shift:]
                a, b = (x[(bucket[a] == bucket[b])] for x in (a, b))
                if not len(a):
                    break
                near = (root[a] != root[b]) & (100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b]))
                a, b = a[near], b[near]
                for at in range(0, len(a), 20_000):
                    x, y = a[at : at + 20_000], b[at : at + 20_000]
                    hit = np.minimum(points[x], points[y]).sum(axis=1, dtype=np.int64) >= _needed(sizes[x], sizes[y], percent)
                    for u, v in zip(rep[x[hit]].tolist(), rep[y[hit]].tolist()):
                        roots.unite(u, v)
            for g in np.flatnonzero(~small):
                own = frame.iloc[edges[g] : edges[g + 1]]
                left, right = _halves(own)
                if not len(left) or (right is not None and not len(right)):
                    continue
                at = slice(edges[g], edges[g + 1])
                now = np.array([roots.find(r) for r in rep[at].tolist()])
                union = Union(len(own))
                union.label = np.unique(now, return_index=True)[1][np.unique(now, return_inverse=True)[1]]
                before = union.label.copy()
                tree_join(points[at], sizes[at], left, right, percent, union)
                union.settle()
                for k in np.flatnonzero(union.label != before):
                    roots.unite(int(rep[at][k]), int(rep[at][union.label[k]]))
        yield roots.stars()

    return run


class _Folded:
    """Fine vectors of a task's rows over any number of groups, folded when first asked for."""

    def __init__(self, column: pd.Series, sizes: np.ndarray, percent: int):
        self.vectors = [np.frombuffer(v, dtype="<u2").astype(np.int32) for v in column]
        self.groups = np.array([len(v) for v in self.vectors])
        self.sizes, self.percent = sizes, percent
        self.kept: dict[tuple[int, int], np.ndarray] = {}

    def over(self, row: int, groups: int) -> np.ndarray:
        if (row, groups) not in self.kept:
            self.kept[row, groups] = fold(self.vectors[row], groups)
        return self.kept[row, groups]

    def __call__(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        groups = int(min(self.groups[x].min(), self.groups[y].min()))
        a, b = (np.stack([self.over(int(r), groups) for r in rows]) for rows in (x, y))
        bound = np.stack([np.minimum(row, b).sum(axis=1) for row in a])
        return bound >= _needed(self.sizes[x][:, None], self.sizes[y][None, :], self.percent)


def _in_coarse_families(percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in sorted_groups(frames, ["family", "i", "j"]):
            left, right = _halves(frame)
            if not len(left) or (right is not None and not len(right)):
                continue
            sizes = frame["n_shingles"].to_numpy()
            finer = _Folded(frame["fine"], sizes, percent)
            points = np.stack([fold(v, GROUPS) for v in finer.vectors])
            union = Union(len(frame))
            tree_join(points, sizes, left, right, percent, union, finer=finer)
            out = _star(frame["rep"].to_numpy(), union)
            if len(out):
                yield out

    return run


def _member_filter(ids: DataFrame, column: str, bits: int = FILTER_BITS):
    """A test that is true for every id of a frame and false for most others, from a bitmap of fixed size.

    With very many ids it lets more pass and so saves less; it never keeps an id of the frame out.
    """
    at = F.pmod(F.xxhash64(column), F.lit(bits))
    words = ids.select(F.shiftright(at, 6).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64({column}), 64) as int))").alias("b"))
    bitmap = np.zeros(bits // 64, dtype=np.uint64)
    for r in words.groupBy("w").agg(F.bit_or("b").alias("b")).collect():
        bitmap[r["w"]] = np.int64(r["b"]).view(np.uint64)
    shared = ids.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def holds(hashes: pd.Series) -> pd.Series:
        h = hashes.to_numpy().astype(np.int64) % bits
        return pd.Series((shared.value[h >> 6] >> (h & 63).astype(np.uint64)) & np.uint64(1) == 1)

    return holds


def _in_families(k: int, percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in sorted_groups(frames, ["family", "i", "j"]):
            left, right = _halves(frame)
            if not len(left) or (right is not None and not len(right)):
                continue
            hashes, offsets = word_hashes(frame["text"], lower=True)
            sets = [gram_set(hashes[a:b], k) for a, b in zip(offsets, offsets[1:])]
            sizes = np.array([len(s) for s in sets])
            points = np.stack([count_vector(s, FINE_GROUPS) for s in sets])

            def linked(u: int, v: int) -> bool:
                both = len(np.intersect1d(sets[u], sets[v], assume_unique=True))
                return 100 * both >= percent * (sizes[u] + sizes[v] - both)

            union = Union(len(frame))
            tree_join(points, sizes, left, right, percent, union, linked)
            out = _star(frame["rep"].to_numpy(), union)
            if len(out):
                yield out

    return run


def _frequent_grams(docs: DataFrame, k: int, share: float = 0.0016) -> np.ndarray:
    """Grams in at least that share of a bounded sample of documents, the most frequent first and FREQUENT at most.

    They only come last in the order of grams: fewer or other ones change the speed, never the result.
    """
    total = docs.count()
    if total < SAMPLE // 2:
        return np.zeros(0, dtype=np.uint64)
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(total)) < SAMPLE)

    def grams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, 256):
            hashes, offsets = word_hashes(frame["text"], lower=True)
            sets = [gram_set(hashes[a:b], k) for a, b in zip(offsets, offsets[1:])]
            found, n = np.unique(np.concatenate(sets), return_counts=True)
            yield pd.DataFrame({"gram": signed(found), "n": n})

    counted = sample.select("doc_id", "text").mapInPandas(grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    top = counted.where(F.col("n") >= share * SAMPLE).orderBy(F.desc("n"), "gram").limit(FREQUENT).collect()
    return np.sort(np.array([r["gram"] for r in top], dtype=np.int64).view(np.uint64))


def jaccard_join(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, block_rows: int = 4096, text_rows: int = 512
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Words are runs between ASCII blanks, A-Z lower-cased; a set holds the distinct runs of k words, or the whole sequence
    where there are fewer. Two documents link when 100 x intersection >= percent x union; component_id is the smallest id
    reachable by links, the own one included. Documents without words (null, empty) have an empty set and link with
    nothing. Rows that share an id are one node; rows without id get the component of their copies, or null. Grams and words are
    compared by 64-bit hashes, whole sets by 128 bits. Extra columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    text_batches(spark)
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    frequent = spark.sparkContext.broadcast(_frequent_grams(own, k))
    schema = "n_shingles long, h1 long, h2 long, point binary, fine binary, first array<long>, doc_id long"
    sets = cut(own.mapInPandas(_described(k, percent, frequent), schema))
    reps = sets.where("n_shingles > 0").groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("rep")).where("rep is not null")
    reps = cut(reps)
    one = sets.join(reps.withColumnRenamed("rep", "doc_id"), ["doc_id", "h1", "h2", "n_shingles"], "left_semi")
    postings = one.select(F.col("doc_id").alias("rep"), F.explode("first").alias("gram"))
    shared = block_tasks(postings, ["gram"], "rep", block_rows)
    points = one.select(F.col("doc_id").alias("rep"), "n_shingles", "point")
    tasks = shared.join(points, "rep").select("gram", "i", "j", "block", "rep", "n_shingles", "point")
    stars = tasks.repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j").mapInPandas(_in_buckets(percent), "src long, dst long")
    coarse = components(stars).select(F.col("node").alias("rep"), F.col("component").alias("family"))
    fine = sets.select(F.col("doc_id").alias("rep"), "n_shingles", "fine")
    split = (
        block_tasks(coarse, ["family"], "rep", block_rows).join(fine, "rep").select("family", "i", "j", "block", "rep", "n_shingles", "fine")
        .repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
        .mapInPandas(_in_coarse_families(percent), "src long, dst long")
    )
    families = components(split).select(F.col("node").alias("rep"), F.col("component").alias("family"))
    dealt = block_tasks(families, ["family"], "rep", text_rows)
    in_family = _member_filter(families, "rep")
    texts = own.where(in_family(F.xxhash64("doc_id"))).join(dealt, F.col("doc_id") == F.col("rep")).select("family", "i", "j", "block", "rep", "text")
    verified = (
        texts.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")
        .mapInPandas(_in_families(k, percent), "src long, dst long")
    )
    groups = components(verified)
    of_set = reps.join(groups, F.col("rep") == F.col("node"), "left").select(
        "h1", "h2", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    return sets.select("doc_id", "n_shingles", "h1", "h2").join(of_set, ["h1", "h2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
