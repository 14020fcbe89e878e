"""Exact nearest neighbours by pivot cells.

Equal points are one point with their least ids. A bounded number of pivots, drawn by hash and so
dense where the points are, cuts the points into cells, and long cells into rings around their pivot.
Round one compares the points of each ring and gives every point a bound: the distance that its
k-th best has so far. Round two sends a point only to rings that may hold something nearer, which
the triangle inequality and the plane between two pivots decide. One plan for every size; no row
is broadcast or collected but the pivots, whose number has a fixed bound.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.session import staged

POINTS_PER_CELL = 512
MOST_PIVOTS = 4096
# Cells longer than this are cut into rings of about this many points, MOST_RINGS at most.
RING_POINTS = 16_384
MOST_RINGS = 1_024
# Points sent to one ring beyond this many are dealt to several tasks.
QUERIES_PER_TASK = 65_536
# Bounds are compared with this relative slack, so that rounding never loses a neighbour.
SLACK = 1e-9
BLOCK = 256

BEST = "pid bigint, neighbour bigint, distance_sq double"


def squared(points, others):
    """Squared distances, summed over the columns in their order."""
    gaps = np.zeros((len(points), len(others)))
    for j in range(points.shape[1]):
        gaps += (points[:, j : j + 1] - others[:, j]) ** 2
    return gaps


def matrix(column):
    """Rows of an Arrow list column of doubles as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


class Cells:
    """Pivots and the rings around them."""

    def __init__(self, pivots):
        self.pivots = pivots
        # Per pivot: least and greatest distance of each of its rings, and the first ring's number.
        self.low = self.high = self.owner = self.cuts = self.first = None

    def nearest(self, points):
        """The nearest pivot of each point and the distance to it."""
        gaps = squared(points, self.pivots)
        cell = gaps.argmin(axis=1)
        return cell, np.sqrt(gaps[np.arange(len(points)), cell])

    def set_rings(self, cuts, radius):
        """`cuts`: inner borders of the rings of each cell; `radius`: its greatest distance, -1 if empty."""
        self.cuts = cuts
        self.first = np.concatenate(([0], np.cumsum([len(c) + 1 for c in cuts])))
        self.owner = np.repeat(np.arange(len(cuts)), np.diff(self.first))
        self.low = np.concatenate([np.concatenate(([0.0], c)) for c in cuts])
        self.high = np.concatenate([np.concatenate((c, [r])) for c, r in zip(cuts, radius)])
        self.radius = np.array(radius)

    def ring_of(self, cell, distance):
        """Ring number; a border belongs to the ring outside it."""
        return self.first[cell] + np.array(
            [np.searchsorted(self.cuts[c], d, side="right") for c, d in zip(cell.tolist(), distance.tolist())], np.int64
        ).reshape(len(cell))

    def reachable(self, points, own_cell, own_ring, bound):
        """(place of point, ring) of all other rings that may hold a point within the bound."""
        far = np.sqrt(squared(points, self.pivots))
        slack = SLACK * (far + np.abs(points).max(axis=1, initial=0.0)[:, None]) + 1e-300
        own = far[np.arange(len(points)), own_cell][:, None]
        limit = bound[:, None] + slack
        near = (far - self.radius <= limit) & ((far - own) / 2 <= limit) & (self.radius >= 0)
        at, cell = np.nonzero(near)
        count = np.diff(self.first)[cell]
        at, cell = np.repeat(at, count), np.repeat(cell, count)
        ring = self.first[cell] + np.arange(len(cell)) - np.repeat(np.cumsum(count) - count, count)
        gap = np.maximum(far[at, cell] - self.high[ring], self.low[ring] - far[at, cell])
        keep = (gap <= limit[at, cell]) & (ring != own_ring[at])
        return at[keep], ring[keep]


def best_of(points, pids, others, other_ids, k, bound=None):
    """The k best (point, id of a row, squared distance) of each point among the rows of other points.

    `other_ids` holds the least ids of the rows of each point. With a bound, only rows within it.
    """
    out_pid, out_id, out_gap = [], [], []
    sizes = np.array([len(i) for i in other_ids])
    for start in range(0, len(points), BLOCK):
        gaps = squared(points[start : start + BLOCK], others)
        keep = min(k, len(others))
        edge = np.partition(gaps, keep - 1, axis=1)[:, keep - 1]
        if bound is not None:
            edge = np.minimum(edge, bound[start : start + BLOCK])
        row, near = np.nonzero(gaps <= edge[:, None])
        gap, row = np.repeat(gaps[row, near], sizes[near]), np.repeat(row, sizes[near])
        ids = np.concatenate([other_ids[i] for i in near.tolist()]) if len(near) else np.zeros(0, np.int64)
        order = np.lexsort((ids, gap, row))
        row, ids, gap = row[order], ids[order], gap[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        first = rank < k
        out_pid.append(pids[start + row[first]])
        out_id.append(ids[first])
        out_gap.append(gap[first])
    return [np.concatenate(v) if v else np.zeros(0) for v in (out_pid, out_id, out_gap)]


def assigned(batches, shared):
    for batch in batches:
        cell, distance = shared.value.nearest(matrix(batch.column("x")))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(distance)], [*batch.schema.names, "cell", "ring_at"]
        )


def ringed(batches, shared):
    for batch in batches:
        ring = shared.value.ring_of(batch.column("cell").to_numpy(), batch.column("ring_at").to_numpy())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ring.astype(np.int32))], [*batch.schema.names, "ring"])


def routed(batches, shared):
    """Points with their bound to the rings they still have to see."""
    for batch in batches:
        x = matrix(batch.column("x"))
        for start in range(0, len(x), BLOCK):
            part = batch.slice(start, BLOCK)
            at, ring = shared.value.reachable(
                x[start : start + BLOCK], part.column("cell").to_numpy(), part.column("ring").to_numpy(),
                np.sqrt(part.column("bound").to_numpy()),
            )
            taken = part.select(["pid", "x", "bound"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(ring.astype(np.int32))], ["pid", "x", "bound", "ring"])


def within_rings(k, with_bound):
    """mapInArrow function over rows sorted by ring, its own points (which have ids) first: the best of the rows
    without ids, or in round one of the points themselves. One ring is held at a time; the others pass by."""

    def run(batches):
        ring, salt, points, ids, pids = None, None, [], [], []

        def answers(batch, rows):
            asked = batch.take(pa.array(rows))
            bound = asked.column("bound").to_numpy() if with_bound else None
            found = best_of(matrix(asked.column("x")), asked.column("pid").to_numpy(), np.concatenate(points), ids, k, bound)
            return pa.RecordBatch.from_arrays([pa.array(v) for v in found], ["pid", "neighbour", "distance_sq"])

        def whole():
            x = np.concatenate(points)
            found = best_of(x, np.concatenate(pids), x, ids, k)
            return pa.RecordBatch.from_arrays([pa.array(v) for v in found], ["pid", "neighbour", "distance_sq"])

        for batch in batches:
            keys = np.stack([batch.column("ring").to_numpy(), batch.column("salt").to_numpy()], axis=1)
            cut = np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1
            for start, end in zip([0, *cut.tolist()], [*cut.tolist(), len(keys)]):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                if (ring, salt) != tuple(keys[start].tolist()):
                    if not with_bound and points:
                        yield whole()
                    (ring, salt), points, ids, pids = keys[start].tolist(), [], [], []
                own = part.column("ids").is_valid().to_numpy(zero_copy_only=False)
                mine = part.filter(pa.array(own))
                if len(mine):
                    points.append(matrix(mine.column("x")))
                    ids.extend(np.array(v, np.int64) for v in mine.column("ids").to_pylist())
                    pids.append(mine.column("pid").to_numpy())
                asking = np.flatnonzero(~own)
                if len(asking) and points:
                    yield answers(part, asking)
        if not with_bound and points:
            yield whole()

    return run


def distinct_points(rows, names, k, id_col):
    """pid (least id), x, ids (the k + 1 least) of each distinct point; null and NaN cells make no point."""
    cells = [F.col(f"`{n}`").cast("double") + F.lit(0.0) for n in names]
    whole = ~F.exists(F.col("x"), lambda v: v.isNull() | F.isnan(v))
    points = rows.select(F.col(id_col).cast("bigint").alias("id"), F.array(*cells).alias("x")).filter(whole)
    order = Window.partitionBy("x").orderBy("id")
    few = points.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1)
    made = few.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return points, staged(made.select(F.col("ids")[0].alias("pid"), "x", "ids"), "distinct-points")


def build_cells(points, n, ring_points):
    """(cells, points with cell and ring). Pivots: a hash sample of a bounded size."""
    spark = points.sparkSession
    wanted = min(MOST_PIVOTS, max(1, -(-n // POINTS_PER_CELL)))
    limit = F.lit(math.ceil(C.MIX_DOMAIN * min(1.0, wanted / n)))
    drawn = [r["x"] for r in points.filter(C.mix("pid", 11) < limit).select("x").limit(2 * MOST_PIVOTS).collect()]
    drawn = drawn or [points.select("x").first()["x"]]
    cells = Cells(np.array(sorted(drawn), float))
    shared = spark.sparkContext.broadcast(cells)
    schema = "pid bigint, x array<double>, ids array<bigint>, cell int, ring_at double"
    placed = staged(points.select("pid", "x", "ids").mapInArrow(lambda b: assigned(b, shared), schema), "cells")
    shares = [i / MOST_RINGS for i in range(1, MOST_RINGS)]
    found = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("ring_at").alias("radius"))
    radius, cuts = [-1.0] * len(drawn), [np.zeros(0)] * len(drawn)
    long = []
    for r in found.collect():
        radius[r["cell"]] = r["radius"]
        if r["n"] > ring_points:
            long.append(r["cell"])
    if long:
        some = placed.filter(F.col("cell").isin(long)).groupBy("cell")
        for r in some.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("ring_at", shares, 4 * MOST_RINGS).alias("q")).collect():
            step = max(1, MOST_RINGS * ring_points // r["n"])
            cuts[r["cell"]] = np.unique(r["q"][step - 1 :: step])
    cells.set_rings(cuts, radius)
    known = spark.sparkContext.broadcast(cells)
    return known, placed.mapInArrow(lambda b: ringed(b, known), schema + ", ring int")


def least_rows(found, k):
    best = Window.partitionBy("pid").orderBy("distance_sq", "neighbour")
    return found.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k).drop("_n")


def nearest_neighbours(rows, names, k=5, id_col="id", ring_points=RING_POINTS):
    """The k nearest rows of each row, exactly, as (id, neighbour, distance_sq, rank).

    Ties of the distance go to the smaller id; a row is not its own neighbour, rows equal to it are. Rows with a null or
    NaN cell have no neighbours and are none. Ids must be whole numbers and unique. Fewer than k other rows: all of them.
    """
    raw, points = distinct_points(rows, names, k, id_col)
    n = points.count()
    empty = rows.sparkSession.createDataFrame([], "id bigint, neighbour bigint, distance_sq double, rank int")
    if n == 0:
        return empty
    known, ringed_points = build_cells(points, n, ring_points)
    placed = staged(ringed_points.drop("ring_at"), "rings")
    # Round one: the points of a ring among themselves. One more than k, as a row does not count itself.
    order = ["ring", "salt", F.col("ids").isNull(), "pid"]
    alone = placed.withColumn("salt", F.lit(0)).repartition("ring").sortWithinPartitions(*order)
    first = staged(alone.select("pid", "x", "ids", "ring", "salt").mapInArrow(within_rings(k + 1, False), BEST), "first-round")
    bounds = first.groupBy("pid").agg(
        F.when(F.count(F.lit(1)) > k, F.max("distance_sq")).otherwise(F.lit(float("inf"))).alias("bound")
    )
    asking = placed.select("pid", "x", "cell", "ring").join(bounds, "pid").select("pid", "x", "cell", "ring", "bound")
    sent = staged(
        asking.mapInArrow(lambda b: routed(b, known), "pid bigint, x array<double>, bound double, ring int"), "second-round"
    )
    # Round two: rings that many points ask are dealt to several tasks, with a copy of the ring each.
    tasks = sent.groupBy("ring").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_TASK).cast("int").alias("tasks"))
    held = placed.join(tasks, "ring").select(
        "pid", "x", "ids", F.lit(None).cast("double").alias("bound"), "ring",
        F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("salt"),
    )
    queries = sent.join(tasks, "ring").select(
        "pid", "x", F.lit(None).cast("array<bigint>").alias("ids"), "bound", "ring",
        F.pmod(F.xxhash64("pid"), F.col("tasks")).cast("int").alias("salt"),
    )
    met = held.unionByName(queries).repartition("ring", "salt").sortWithinPartitions(*order)
    second = met.mapInArrow(within_rings(k + 1, True), BEST)
    best = least_rows(first.unionByName(second), k + 1)
    lists = best.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("distance_sq", "neighbour"))).alias("near"))
    # Back from points to rows: each takes the list of its point without itself.
    listed = points.select("pid", "x").join(lists, "pid").select("x", "near")
    others = F.slice(F.filter("near", lambda v: v["neighbour"] != F.col("id")), 1, k)
    return (
        raw.join(listed, "x")
        .select("id", F.posexplode(others).alias("rank", "v"))
        .select("id", "v.neighbour", "v.distance_sq", (F.col("rank") + 1).alias("rank"))
    )
