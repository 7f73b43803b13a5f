"""Exact cosine links by a dual traversal of cover trees.

A cover tree has nested levels whose radii halve: a node's centre is also the centre of its first child, every member lies
within the node's covering radius, and children are a net of half the radius. Two trees are walked together, and a pair of nodes
is left as soon as their centres are further apart than both radii and the threshold distance allow. Pairs of leaves are compared
exactly, so pruning saves work and never decides a link.

Spark deals the trees out. Vectors with one label and length are divided among cells by the nearest of at most ``PIVOTS`` pivots,
which are the top of the tree; a cell of more than ``CELL`` rows is cut into parts by a hash of the id, so that a label, or a
point, with a third of all rows is no single task. Pairs of cells whose covering radii keep them apart never meet; each
other pair of parts is one task of at most about ``2 * CELL`` rows.

A task returns, per vector with links, their number and the root of its links there: m close vectors give m rows, not m * m.

Defined cases: null labels, and vectors that are null, empty, zero or have null or non-finite components, link with nothing; so
do vectors of different lengths; rows that repeat an id count as one vector (see ``vectors``); rows without an id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urndraw.llm.common import connected_components, hashed_share, stored
from urndraw.llm.simhash import forest
from urndraw.llm.vectors import matrix, vectors

CELL, PIVOTS, LEAF = 2048, 1024, 16
#: Rounding of distances, far above that of double precision; it only widens what is compared exactly.
SLACK = 1e-7


def unit(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class CoverTree:
    """Nodes as arrays; a node's members are a range of ``order``, its children a range of nodes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.points, self.order = points, np.arange(len(points))
        self.start, self.stop, self.centre, self.radius = [0], [len(points)], [0], [0.0]
        self.first, self.last = [0], [0]
        todo = [(0, 2.0)]
        while todo:
            node, reach = todo.pop()
            a, b = self.start[node], self.stop[node]
            members = self.order[a:b].copy()
            far = self._distances(members, self.centre[node])
            self.radius[node] = float(far.max(initial=0.0))
            if b - a <= leaf or self.radius[node] == 0:
                continue
            while reach >= self.radius[node]:
                reach /= 2
            self.first[node] = len(self.start)
            at, rest, centre = a, members, self.centre[node]
            while len(rest):
                near = self._distances(rest, centre) <= reach
                near[rest == centre] = True
                inside = rest[near]
                self.order[at:at + len(inside)] = inside
                todo.append((len(self.start), reach))
                self._add(at, at + len(inside), centre)
                at, rest = at + len(inside), rest[~near]
                centre = rest[0] if len(rest) else 0
            self.last[node] = len(self.start)
        self.start, self.stop, self.first, self.last = (np.array(x, np.int64) for x in (self.start, self.stop, self.first, self.last))
        self.centres, self.radius = points[np.array(self.centre)] if len(points) else points, np.array(self.radius)

    def _add(self, start: int, stop: int, centre: int) -> None:
        for values, value in ((self.start, start), (self.stop, stop), (self.centre, centre), (self.radius, 0.0), (self.first, 0), (self.last, 0)):
            values.append(value)

    def _distances(self, members: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * (self.points[members] @ self.points[centre])))

    def members(self, nodes: np.ndarray) -> np.ndarray:
        return np.concatenate([self.order[a:b] for a, b in zip(self.start[nodes], self.stop[nodes])]) if len(nodes) else self.order[:0]


def linked(left: CoverTree, right: CoverTree, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (of left, of right) whose cosine is ``least`` or more."""
    reach = np.sqrt(max(0.0, 2 - 2 * least)) + SLACK
    todo = [(0, np.zeros(min(1, len(right.points)), np.int64))] if len(left.points) else []
    while todo:
        node, others = todo.pop()
        while True:
            apart = np.sqrt(np.maximum(0, 2 - 2 * (right.centres[others] @ left.centres[node])))
            others = others[apart <= reach + left.radius[node] + right.radius[others]]
            # descend on the right first where its nodes are the wider ones
            wide = (right.last[others] > 0) & ((right.radius[others] >= left.radius[node]) | (left.last[node] == 0))
            if not wide.any():
                break
            others = np.concatenate([others[~wide], *(np.arange(right.first[o], right.last[o]) for o in others[wide])])
        if not len(others):
            continue
        if left.last[node]:
            todo += [(child, others) for child in range(left.first[node], left.last[node])]
            continue
        mine, theirs = left.order[left.start[node]:left.stop[node]], right.members(others)
        i, j = np.nonzero(left.points[mine] @ right.points[theirs].T >= least)
        if len(i):
            yield mine[i], theirs[j]


def _counted(ids: np.ndarray, links: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    """Rows for the vectors with links; the root is the smallest id, as ``ids`` are sorted."""
    root = forest(len(ids), iter(pairs))
    has = links > 0
    return pa.table({"vec_id": ids[has], "links": links[has], "root": ids[root[has]]})


def close_in_task(table: pa.Table, least: float) -> pa.Table:
    """Links of one task: within a part (side 0 only), or between two parts."""
    table = table.sort_by([("side", "ascending"), ("vec_id", "ascending")])
    side = table.column("side").to_numpy()
    ids, points = table.column("vec_id").to_numpy(), unit(matrix(table.column("vector")))
    n = int((side == 0).sum())
    links = np.zeros(len(ids), np.int64)
    pairs = []
    a = CoverTree(points[:n])
    b = a if n == len(ids) else CoverTree(points[n:])
    for i, j in linked(a, b, least):
        if b is a:
            apart = i != j
            i, j = i[apart], j[apart]
            np.add.at(links, i, 1)
        else:
            j = j + n
            np.add.at(links, i, 1)
            np.add.at(links, j, 1)
        # a forest is kept as we go, so that what is held stays in proportion to the rows
        pairs.append((i, j))
        if sum(len(p[0]) for p in pairs) > 1 << 20:
            root = forest(len(ids), iter(pairs))
            pairs = [(np.arange(len(ids)), root)]
    order = np.argsort(ids, kind="stable")
    back = np.empty_like(order)
    back[order] = np.arange(len(ids))
    return _counted(ids[order], links[order], [(back[i], back[j]) for i, j in pairs])


def links(table: DataFrame, least: float = 0.93, cell: int = CELL, id_column: str = "vec_id", vector_column: str = "embedding",
          label_column: str = "label") -> tuple[DataFrame, DataFrame]:
    """(all vectors, (vec_id, links, root) in parts): what the tasks found; sum the links, and join the roots."""
    spark = table.sparkSession
    every = stored(vectors(table, id_column, vector_column, label_column), "covertree")
    nonzero = F.exists("vector", lambda x: x != 0)
    usable = every.where(F.col("usable") & F.col("label").isNotNull() & nonzero).select("vec_id", "label", F.size("vector").alias("dim"), "vector")
    largest = usable.groupBy("label", "dim").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    wanted = min(PIVOTS, max(1, -(-largest // cell)))
    # the vectors with the smallest hashes of their ids: a bounded sample, of each length
    few = usable.where(hashed_share(every.count(), 20 * wanted, "vec_id"))
    sample = few.orderBy(F.xxhash64("vec_id")).limit(wanted).select("dim", "vector").collect() if wanted > 1 else []
    by: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in sample}:
        by[dim] = unit(np.array([r["vector"] for r in sample if r["dim"] == dim]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy(zero_copy_only=False)
            cells, far = np.zeros(len(dims), np.int32), np.full(len(dims), 2.0)
            for dim, pivots in by.items():
                rows = np.flatnonzero(dims == dim)
                if len(rows):
                    points = unit(matrix(pa.chunked_array([batch.column(3).take(pa.array(rows))])))
                    cosines = points @ pivots.T
                    cells[rows] = cosines.argmax(axis=1)
                    far[rows] = np.sqrt(np.maximum(0, 2 - 2 * cosines.max(axis=1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells), pa.array(far)], ["vec_id", "label", "dim", "vector", "cell", "far"])

    placed = stored(usable.mapInArrow(place, "vec_id long, label string, dim int, vector array<double>, cell int, far double"), "covertree")
    cells = placed.groupBy("label", "dim", "cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).withColumn(
        "parts", F.ceil(F.col("n") / cell).cast("int"))
    cells = stored(cells, "covertree")
    between = [(dim, i, j, float(np.sqrt(max(0.0, 2 - 2 * p[i] @ p[j])))) for dim, p in by.items() for i in range(len(p)) for j in range(i, len(p))]
    distances = spark.createDataFrame(between or [(-1, 0, 0, 0.0)], "dim int, cell int, cell2 int, apart double")
    other = cells.select("label", "dim", F.col("cell").alias("cell2"), F.col("radius").alias("radius2"), F.col("parts").alias("parts2"))
    reach = float(np.sqrt(max(0.0, 2 - 2 * least)) + SLACK)
    pairs = (
        cells.join(other, ["label", "dim"]).where("cell <= cell2").join(distances, ["dim", "cell", "cell2"], "left")
        .where(F.coalesce("apart", F.lit(0.0)) <= F.col("radius") + F.col("radius2") + reach)
        .select("label", "dim", "cell", "cell2", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "parts2")
        .select("label", "dim", "cell", "cell2", "part", F.explode(F.sequence(F.lit(0), F.col("parts2") - 1)).alias("part2"))
        .where("cell < cell2 or part <= part2")
    )
    tasks = stored(pairs.withColumn("task", F.xxhash64("label", "dim", "cell", "part", "cell2", "part2")), "covertree")
    parts = cells.select("label", "dim", "cell", "parts")
    dealt = placed.join(parts, ["label", "dim", "cell"]).select(
        "vec_id", "label", "dim", "cell", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), "vector")
    mine = dealt.join(tasks.select("label", "dim", "cell", "part", "task"), ["label", "dim", "cell", "part"]).select(
        "task", F.lit(0).alias("side"), "vec_id", "vector")
    apart = tasks.where("cell < cell2 or part < part2").select(
        "label", "dim", F.col("cell2").alias("cell"), F.col("part2").alias("part"), "task")
    theirs = dealt.join(apart, ["label", "dim", "cell", "part"]).select("task", F.lit(1).alias("side"), "vec_id", "vector")

    def close(group: pa.Table) -> pa.Table:
        return close_in_task(group, least)

    found = mine.unionAll(theirs).groupBy("task").applyInArrow(close, "vec_id long, links long, root long")
    return every, stored(found, "covertree")


def near_duplicates(table: DataFrame, least: float = 0.93, cell: int = CELL, id_column: str = "vec_id", vector_column: str = "embedding",
                    label_column: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per id."""
    every, found = links(table, least, cell, id_column, vector_column, label_column)
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    parts = connected_components(found, "vec_id", "root", "covertree").withColumnRenamed("node", "vec_id")
    component = F.coalesce("component", "vec_id").alias("component_id")
    out = every.select("vec_id").join(counts, "vec_id", "left").join(parts, "vec_id", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component,
                      (F.col("vec_id") == component).alias("kept"))
