"""Near-duplicate vectors: exact threshold pairs by dual traversal of cover trees.

Vectors become unit vectors; cosine >= c means a distance of at most r = sqrt(2 - 2c). Equal unit vectors of a label are one
vector with a multiplicity. A bounded sample of centres, the upper level of the cover, cuts large labels into cells; a
vector also visits the later cells that its distance to the centre and the cell's covering radius, or the plane between
both centres, do not rule out. Cells are cut into blocks, so that a task holds two blocks at most. In a task each block becomes
a cover tree, whose radii halve from level to level, and both are walked together: a pair of nodes is dropped when
their centres are further apart than both covering radii and r, and taken whole when all its pairs must link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import Union, components, cut

#: Centres over all labels, in expectation: a fixed bound of what is broadcast.
CENTRES = 1024
_LEAF, _PROBE, _ROWS, _SLACK = 256, 512, 512, 1e-6


@dataclass
class Node:
    """Points rows[...] of a block around one of them; radius is the distance of the furthest."""

    centre: int
    radius: float
    rows: np.ndarray
    children: list["Node"]


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y.T)))


def _net(points: np.ndarray, radius: float, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Centres, further than radius from each other, and for each point the first centre within radius. The first point is a centre."""
    centres = np.zeros(0, dtype=np.int64)
    owner = np.full(len(points), -1, dtype=np.int64)
    for at in range(0, len(points), step):
        chunk = np.arange(at, min(at + step, len(points)))
        if len(centres):
            near = _distance(points[chunk], points[centres]) <= radius
            hit = near.any(axis=1)
            owner[chunk[hit]] = near[hit].argmax(axis=1)
            chunk = chunk[~hit]
        if not len(chunk):
            continue
        own = _distance(points[chunk], points[chunk]) <= radius
        np.fill_diagonal(own, True)
        free = np.ones(len(chunk), dtype=bool)
        fresh = []
        for i in range(len(chunk)):
            if free[i]:
                taken = own[i] & free
                owner[chunk[taken]] = len(centres) + len(fresh)
                fresh.append(chunk[i])
                free &= ~taken
        centres = np.concatenate([centres, np.array(fresh, dtype=np.int64)])
    return centres, owner


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None, radius: float = 2.0, least: float = 1e-3) -> Node:
    """A tree over unit vectors; the children of a node of radius R form a net of radius R / 2, the node's centre among them.

    Radii halve again where a net has one centre only. Few points stay together, and so do points that a net does not
    gather (over half of the first ones would be centres): their pairs are compared by matrix products.
    """
    rows = np.arange(len(points)) if rows is None else rows
    root = Node(int(rows[0]), 0.0, rows, [])
    stack = [(root, radius)]
    while stack:
        node, reach = stack.pop()
        own = points[node.rows]
        node.radius = float(_distance(own, points[[node.centre]]).max())
        if len(node.rows) <= _LEAF or node.radius <= least:
            continue
        reach = min(reach, node.radius)
        while not node.children and reach > least:
            reach /= 2
            probe = own[:_PROBE]
            if 2 * len(_net(probe, reach)[0]) > len(probe):
                break
            centres, owner = _net(own, reach)
            if len(centres) > 1:
                order = np.argsort(owner, kind="stable")
                parts = np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)
                node.children = [Node(int(node.rows[centres[owner[p[0]]]]), 0.0, node.rows[p], []) for p in parts]
                stack += [(c, reach) for c in node.children]
    return root


def dual_links(
    points: np.ndarray, weight: np.ndarray, left: Node, right: Node | None, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links of each point (weighted by the partner's multiplicity) and local components, over all pairs of left x right.

    right None: the pairs inside left, each point not with itself.
    """
    r = float(np.sqrt(2 - 2 * cosine))
    links, union = np.zeros(len(points), dtype=np.int64), Union(len(points))
    weight = np.asarray(weight, dtype=np.int64)
    same = right is None
    stack = [(left, left if same else right)]
    while stack:
        a, b = stack.pop()
        own = same and a is b
        if a.radius + b.radius + (a.radius if own else float(_distance(points[[a.centre]], points[[b.centre]])[0, 0])) <= r - _SLACK:
            links[a.rows] += weight[b.rows].sum()
            union.add(a.rows, np.full(len(a.rows), b.rows[0]))
            union.add(b.rows, np.full(len(b.rows), a.rows[0]))
            if own:
                links[a.rows] -= weight[a.rows]
            else:
                links[b.rows] += weight[a.rows].sum()
            continue
        if not a.children and not b.children:
            for at in range(0, len(a.rows), _ROWS):
                rows = a.rows[at : at + _ROWS]
                hit = points[rows] @ points[b.rows].T >= cosine
                i, j = np.nonzero(hit)
                i, j = rows[i], b.rows[j]
                if own:
                    i, j = i[i != j], j[i != j]
                np.add.at(links, i, weight[j])
                if not own:
                    np.add.at(links, j, weight[i])
                union.add(i, j)
            continue
        if own:
            parts = a.children
            centres = points[[c.centre for c in parts]]
            radii = np.array([c.radius for c in parts])
            for at in range(0, len(parts), 256):
                near = _distance(centres[at : at + 256], centres) <= radii[at : at + 256, None] + radii[None, :] + r + _SLACK
                for i, j in zip(*np.nonzero(near)):
                    if at + i <= j:
                        stack.append((parts[at + i], parts[j]))
            continue
        split_a = bool(a.children) and (not b.children or a.radius >= b.radius)
        outer, inner = (a, b) if split_a else (b, a)
        centres = points[[c.centre for c in outer.children]]
        radii = np.array([c.radius for c in outer.children])
        near = _distance(centres, points[[inner.centre]])[:, 0] <= radii + inner.radius + r + _SLACK
        for i in np.flatnonzero(near):
            stack.append((outer.children[i], inner) if split_a else (inner, outer.children[i]))
    union.settle()
    return links, union.label


@F.pandas_udf(T.BinaryType())
def _unit(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Unit vectors as bytes of doubles; null where a vector can't link."""
    for batch in values:
        out = []
        for v in batch:
            x = None if v is None else np.asarray([np.nan if c is None else c for c in v], dtype=float)
            if x is None or not len(x) or not np.isfinite(x).all() or not x.any():
                out.append(None)
            else:
                x = x / np.abs(x).max()
                out.append((x / np.linalg.norm(x)).tobytes())
        yield pd.Series(out, dtype=object)


def _matrix(units: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(units), dtype=float).reshape(len(units), -1)


def _cells(centres: dict[tuple[str, int], tuple[list[int], np.ndarray]], radius: dict[int, float] | None, r: float) -> Callable:
    """Home cell (the nearest centre) with its distance, or with radii known the later cells a vector must visit."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            homes = np.zeros(len(frame), dtype="int64")
            away = np.zeros(len(frame))
            visits: list[list[int]] = [[] for _ in range(len(frame))]
            for kind, part in frame.groupby(["kind", "dim"]).indices.items():
                if kind not in centres:
                    continue
                names, places = centres[kind]
                names = np.array(names)
                for at in range(0, len(part), 1024):
                    rows = part[at : at + 1024]
                    d = _distance(_matrix(frame["unit"].iloc[rows]), places)
                    home = d.argmin(axis=1)
                    homes[rows], away[rows] = names[home], d[np.arange(len(rows)), home]
                    if radius is not None:
                        between = _distance(places, places)
                        reach = np.array([radius.get(int(c), -np.inf) for c in names])
                        ok = (d <= reach + r + _SLACK) & (d**2 - d[np.arange(len(rows)), home][:, None] ** 2 <= 2 * r * between[home] + _SLACK)
                        ok &= names[None, :] > names[home][:, None]
                        for i, c in zip(*np.nonzero(ok)):
                            visits[rows[i]].append(int(names[c]))
            yield frame.assign(cell=homes, away=away, visits=visits)

    return run


def link_near_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = 0.98, block_rows: int = 4096
) -> DataFrame:
    """One row per row of vectors: vec_id, n_links (other rows linked directly), component_id, kept.

    Rows link when their labels are equal and not null, both vectors have the same number of components, and their cosine in double
    precision reaches the threshold. Vectors that are null, empty, zero, or hold null or non-finite components link
    with nothing, nor do rows without id; their component is their own id. Rows that share an id count as rows in n_links and as one node of
    components. Extra columns are ignored; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    r = float(np.sqrt(2 - 2 * cosine))
    rows = cut(
        vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("string").alias("kind"), _unit(F.col(embedding)).alias("unit"))
        .withColumn("unit", F.expr("if(kind is null or vec_id is null, null, unit)"))
    )
    usable = rows.where("unit is not null")
    distinct = cut(
        usable.groupBy("kind", "unit").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("dim", (F.length("unit") / 8).cast("int"))
    )
    sizes = distinct.groupBy("kind", "dim").count().where(F.col("count") > block_rows)
    total = sizes.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    centres: dict[tuple[str, int], tuple[list[int], np.ndarray]] = {}
    if total:
        wanted = min(CENTRES, -(-total // block_rows))
        picked = (
            distinct.join(sizes.select("kind", "dim"), ["kind", "dim"])
            .where(F.pmod(F.xxhash64("unit", F.lit(6)), F.lit(total)) < wanted)
            .select("kind", "dim", "unit").collect()
        )
        for no, p in enumerate(sorted(picked), 1):
            names, places = centres.setdefault((p["kind"], p["dim"]), ([], []))
            names.append(no)
            places.append(np.frombuffer(p["unit"]))
        centres = {k: (n, np.vstack(p)) for k, (n, p) in centres.items()}
    schema = "kind string, unit binary, rep long, copies long, dim int, cell long, away double, visits array<long>"
    radius = {
        x["cell"]: x["radius"]
        for x in (distinct.mapInPandas(_cells(centres, None, r), schema).where("cell > 0").groupBy("cell").agg(F.max("away").alias("radius")).collect() if centres else [])
    }
    placed = cut(distinct.mapInPandas(_cells(centres, radius, r), schema))
    members = placed.select("kind", "dim", "cell", "rep", "copies", "unit", F.lit(0).alias("guest"))
    guests = placed.select("kind", "dim", F.explode("visits").alias("cell"), "rep", "copies", "unit", F.lit(1).alias("guest"))
    everyone = members.union(guests)
    blocks = everyone.groupBy("kind", "dim", "cell").agg(
        F.ceil(F.sum(1 - F.col("guest")) / block_rows).alias("m"), F.ceil(F.sum("guest") / block_rows).alias("g")
    )
    dealt = everyone.join(blocks, ["kind", "dim", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("rep", F.lit(1)), F.when(F.col("guest") == 0, F.col("m")).otherwise(F.col("g")))
    )
    # members meet members of their own block and later ones, and every block of guests; guests (blocks -1, -2, ..) meet members only
    first = F.expr(
        "if(guest = 0, concat(transform(sequence(0, m - 1), j -> struct(least(block, j) as i, greatest(block, j) as j)),"
        " if(g > 0, transform(sequence(1, g), j -> struct(-j as i, block as j)), array())),"
        " if(m > 0, transform(sequence(0, m - 1), j -> struct(-1 - block as i, j as j)), array()))"
    )
    tasks = dealt.select("kind", "dim", "cell", "rep", "copies", "unit", "block", "guest", F.explode(first).alias("at"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rep", kind="stable")
        points, weight = _matrix(frame["unit"]), frame["copies"].to_numpy()
        home = np.where(frame["guest"] == 1, -1 - frame["block"], frame["block"])
        i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        left, right = np.flatnonzero(home == i), np.flatnonzero(home == j)
        if not len(left) or not len(right):
            return pd.DataFrame({"rep": [], "links": [], "parent": []})
        tree = cover_tree(points, left)
        links, lowest = dual_links(points, weight, tree, None if i == j else cover_tree(points, right), cosine)
        rep = frame["rep"].to_numpy()
        some = links > 0
        return pd.DataFrame({"rep": rep[some], "links": links[some], "parent": rep[lowest[some]]})

    found = cut(
        tasks.select("kind", "dim", "cell", F.col("at.i").alias("i"), F.col("at.j").alias("j"), "rep", "copies", "unit", "block", "guest")
        .groupBy("kind", "dim", "cell", "i", "j")
        .applyInPandas(compare, "rep long, links long, parent long")
    )
    groups = components(found.select(F.col("rep").alias("src"), F.col("parent").alias("dst")))
    counted = found.groupBy("rep").agg(F.sum("links").alias("links"))
    of_unit = (
        distinct.join(counted, "rep", "left").join(groups, F.col("rep") == F.col("node"), "left")
        .select("kind", "unit", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    )
    return (
        rows.join(of_unit, ["kind", "unit"], "left")
        .select(
            "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").cast("long").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
