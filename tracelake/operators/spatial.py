"""Greedy clusters of positions, and what is reported of them.

Only the labelling depends on the order of points and runs in a grouped pandas function,
on the distinct points (four decimals) of one patch of an entity's zone. Spark cuts the
points into patches first: a strip wider than the threshold that holds no point separates
clusters for good, since a centroid never leaves the box of its points. Counting,
reducing and filtering clusters are aggregations.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import half_up

EPSILON = 1e-9


class _Grid:
    """Clusters by the cell of their centroid; cells are as wide as the threshold."""

    def __init__(self, threshold: float):
        self.most, self.width, self.cells = threshold + EPSILON, max(threshold, 1e-6) * (1 + 1e-6), {}

    def cell(self, x: float, y: float) -> tuple[int, int]:
        return math.floor(x / self.width), math.floor(y / self.width)

    def put(self, c: int, x: float, y: float) -> None:
        self.cells.setdefault(self.cell(x, y), set()).add(c)

    def take(self, c: int, x: float, y: float) -> None:
        self.cells[self.cell(x, y)].discard(c)

    def near(self, x: float, y: float, centre) -> list[tuple[float, int]]:
        """(distance, cluster) of all not further than the threshold."""
        i, j = self.cell(x, y)
        out = []
        for c in (c for a in (-1, 0, 1) for b in (-1, 0, 1) for c in self.cells.get((i + a, j + b), ())):
            u, v = centre(c)
            d = math.sqrt((u - x) * (u - x) + (v - y) * (v - y))
            if d <= self.most:
                out.append((d, c))
        return out


def labels(points: np.ndarray, threshold: float) -> np.ndarray:
    """A cluster number for each point (sorted by x, y).

    A point joins the nearest centroid not further than ``threshold``, else begins a
    cluster. Then the first pair of clusters as near as that is merged, again and again.
    """
    grid, sums, counts, own = _Grid(threshold), [], [], []
    centre = lambda c: (sums[c][0] / counts[c], sums[c][1] / counts[c])
    for x, y in points.tolist():
        near = grid.near(x, y, centre)
        if near:
            c = min(near)[1]
            grid.take(c, *centre(c))
            sums[c] = (sums[c][0] + x, sums[c][1] + y)
            counts[c] += 1
        else:
            c = len(counts)
            sums.append((x, y))
            counts.append(1)
        grid.put(c, *centre(c))
        own.append(c)
    # pairs that are near, the first on top; those whose clusters changed since are passed over
    version, into = [0] * len(counts), list(range(len(counts)))
    pairs: list[tuple[int, int, int, int]] = []

    def push(c: int, later_only: bool) -> None:
        for _, d in grid.near(*centre(c), centre):
            if d > c or d < c and not later_only:
                a, b = min(c, d), max(c, d)
                heapq.heappush(pairs, (a, b, version[a], version[b]))

    for c in range(len(counts)):
        push(c, True)
    while pairs:
        a, b, va, vb = heapq.heappop(pairs)
        if into[a] != a or into[b] != b or (version[a], version[b]) != (va, vb):
            continue
        grid.take(a, *centre(a)), grid.take(b, *centre(b))
        sums[a] = (sums[a][0] + sums[b][0], sums[a][1] + sums[b][1])
        counts[a] += counts[b]
        into[b] = a
        version[a] += 1
        grid.put(a, *centre(a))
        push(a, False)
    alive = [c for c in range(len(into)) if into[c] == c]

    def root(c: int) -> int:
        while into[c] != c:
            c = into[c]
        return c

    return np.searchsorted(alive, [root(c) for c in own]) if own else np.zeros(0, np.int64)


def _patches(points: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """``points`` with ``_patch``: numbers of the pieces that empty strips of more than the threshold cut a group into."""
    width = F.col("_threshold") + 1e-6
    rows = points.withColumn("_cx", F.floor(F.col(x) / width)).withColumn("_cy", F.floor(F.col(y) / width))
    # occupied cells, not points, are put in order
    cells = rows.select(*by, "_cx", "_cy").distinct().withColumn("_patch", F.lit("0"))
    for cell in ("_cx", "_cy", "_cx", "_cy"):
        strips = cells.select(*by, "_patch", cell).distinct()
        w = Window.partitionBy(*by, "_patch").orderBy(cell)
        # an empty cell in between is wider than the threshold
        cut = F.coalesce((F.col(cell) - F.lag(cell).over(w) > 1).cast("int"), F.lit(0))
        strips = strips.withColumn("_cut", cut).withColumn("_next", F.concat_ws(".", "_patch", F.sum("_cut").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("string"))).drop("_cut")
        same = [F.col(f"c.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*by, "_patch", cell)]
        cells = cells.alias("c").join(strips.alias("s"), same).select(*[F.col(f"c.{c}") for c in (*by, "_cx", "_cy")], F.col("s._next").alias("_patch"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*by, "_cx", "_cy")]
    return rows.alias("p").join(cells.alias("c"), same).select(*[F.col(f"p.{c}") for c in points.columns], F.col("c._patch").alias("_patch"))


def clustered(rows: DataFrame, by: Sequence[str], x: str, y: str, threshold: Column | float) -> DataFrame:
    """(``by``, x, y, cluster) of every distinct point; ``cluster`` (patch, number) is of its own within a group."""
    points = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, half_up(F.col(x).cast("double"), 4).alias(x), half_up(F.col(y).cast("double"), 4).alias(y), (threshold if isinstance(threshold, Column) else F.lit(float(threshold))).alias("_threshold")).distinct()

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([x, y], kind="stable")
        number = labels(frame[[x, y]].to_numpy(float), float(frame["_threshold"].iloc[0]))
        return frame.drop(columns=["_threshold", "_patch"]).assign(cluster=frame["_patch"] + "#" + pd.Series(number, index=frame.index).astype(str))

    schema = ", ".join(f"`{c}` {points.schema[c].dataType.simpleString()}" for c in (*by, x, y)) + ", cluster string"
    return _patches(points, by, x, y).groupBy(*by, "_patch").applyInPandas(run, schema)


def spawns(rows: DataFrame, entity: str, zone: str, x: str, y: str, session: str, threshold: Column | float = 0.5, reducer: str = "median", least: int = 2, share: float = 0.05, single: bool = False, compact: float | None = None) -> DataFrame:
    """(entity, zone, x, y, sessions, n) of the clusters of each entity.

    ``median`` (or ``mean``) of the distinct points, two decimals. Clusters need ``least``
    sessions or ``share`` of the entity's strongest cluster. ``single``: of a zone only the
    cluster with most rows, the first of equals. ``compact``: clusters of a zone that all
    lie within it become one mean.
    """
    point = [half_up(F.col(c).cast("double"), 4).alias(c) for c in (x, y)]
    placed = rows.select(entity, zone, *point, session).join(clustered(rows, [entity, zone], x, y, threshold), [entity, zone, x, y])
    support = placed.groupBy(entity, zone, "cluster").agg(F.count_distinct(session).alias("sessions"), F.count(F.lit(1)).alias("n"))
    reduce = F.median if reducer == "median" else F.mean
    # clusters count by their first point
    places = placed.select(entity, zone, "cluster", x, y).distinct().groupBy(entity, zone, "cluster").agg(reduce(x).alias("_x"), reduce(y).alias("_y"), F.min(F.struct(x, y)).alias("_first"))
    out = places.join(support, [entity, zone, "cluster"])
    strongest = F.max("sessions").over(Window.partitionBy(entity))
    out = out.withColumn("_top", strongest).where((F.col("sessions") >= least) | (F.col("sessions") >= F.col("_top") * share)).drop("_top")
    if single:
        out = out.withColumn("_place", F.row_number().over(Window.partitionBy(entity, zone).orderBy(F.desc("n"), F.asc("_first")))).where("_place = 1").drop("_place")
    if compact is not None:
        box = Window.partitionBy(entity, zone)
        wide = F.greatest(*[F.max(c).over(box) - F.min(c).over(box) for c in ("_x", "_y")])
        out = out.withColumn("_small", wide <= compact)
        # centroids lie further apart than the threshold, so few of them fit into such a box
        zones = out.where("_small").groupBy(entity, zone).agg(F.collect_list(F.struct("_x", "_y")).alias("_all"))
        apart = lambda a, b: F.sqrt(F.pow(a["_x"] - b["_x"], 2) + F.pow(a["_y"] - b["_y"], 2)) <= compact
        zones = zones.select(entity, zone, F.forall("_all", lambda a: F.forall("_all", lambda b: apart(a, b))).alias("_near"))
        out = out.drop("_small").join(zones, [entity, zone], "left").withColumn("_small", F.coalesce("_near", F.lit(False)))
        one = out.where("_small").groupBy(entity, zone).agg(F.mean("_x").alias("_x"), F.mean("_y").alias("_y"), F.max("sessions").alias("sessions"), F.sum("n").alias("n"))
        out = out.where("not _small").select(entity, zone, "_x", "_y", "sessions", "n").unionByName(one)
    return out.select(entity, zone, half_up(F.col("_x"), 2).alias(x), half_up(F.col("_y"), 2).alias(y), "sessions", "n")
