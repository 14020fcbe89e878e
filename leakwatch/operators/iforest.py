"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Sampling is one pass, trees grow in parallel groups of at most `sample_size`
rows, and scoring is a vectorised pass over the table. The model is a table of
nodes whose size depends on the forest, not on the data.
"""

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leakwatch.functions import columns as C
from leakwatch.functions import fixed
from leakwatch.operators import spread

NODE = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("cut", T.DoubleType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("depth", T.DoubleType()),
    ]
)


def expected_depth(n):
    """Mean path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def mixed(values):
    """Scatter 64-bit values evenly."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chances(keys, number, seed):
    """Uniform in (0, 1) from row keys and numbers, and nothing else."""
    with np.errstate(over="ignore"):
        salted = mixed(keys) + mixed(number.astype(np.uint64) * np.uint64(2) + np.uint64(1)) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed(salted) >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def candidate_pairs(keys, trees, share, seed):
    """(place, tree) of all candidates: each row is one of each tree's with the given chance.

    The trees between two that take a row follow a geometric law, so a row costs one draw
    for each tree that takes it and one more.
    """
    places, taken = [], []
    alive, at = np.arange(len(keys)), np.full(len(keys), -1)
    step = 0
    while len(alive):
        if share < 1.0:
            skip = np.log(chances(keys[alive], np.full(len(alive), step), seed)) / math.log1p(-share)
            at = at + 1 + np.minimum(skip, trees).astype(np.int64)
        else:
            at = at + 1
        inside = at < trees
        alive, at = alive[inside], at[inside]
        places.append(alive)
        taken.append(at)
        step += 1
    return np.concatenate([*places, np.zeros(0, np.int64)]), np.concatenate([*taken, np.zeros(0, np.int64)])


def draw_samples(rows, names, trees, sample_size, id_col, seed):
    """Rows of each tree's sample, drawn without replacement within a tree.

    Every tree takes the rows with its least draws, a bottom-k sample. A first threshold, which leaves
    k and a margin of nine standard deviations, is applied where the rows lie; about
    trees * sample_size pairs leave the tasks, and each tree cuts its own. One scheme for every size.
    """
    size = rows.count()
    if size == 0:
        raise ValueError("no rows to train on")
    take = min(sample_size, size)
    share = min(1.0, (take + 9.0 * math.sqrt(take) + 9.0) / size)
    x = F.array(*[C.finite(F.col(f"`{n}`")) for n in names])
    points = rows.select(F.col(id_col).alias("id"), x.alias("x"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("key"))

    def draw(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            places, tree = candidate_pairs(keys, trees, share, seed)
            kept = batch.select(["id", "x"]).take(pa.array(places))
            number = chances(keys[places], tree, seed + 1)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(tree.astype(np.int32)), pa.array(number)], ["id", "x", "tree", "draw"])

    kinds = points.schema["id"].dataType.simpleString()
    pairs = points.mapInArrow(draw, f"id {kinds}, x array<double>, tree int, draw double")
    order = Window.partitionBy("tree").orderBy("draw", "id")
    ranked = pairs.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= take)
    return ranked.select("tree", "id", "x"), take


def _grow(x, rng, height_limit):
    """Nodes of one tree, parents before children."""
    nodes = [None]
    stack = [(0, np.arange(len(x)), 0)]
    while stack:
        at, members, depth = stack.pop()
        part = x[members]
        low, high = (part.min(axis=0), part.max(axis=0)) if len(members) else (None, None)
        splittable = np.flatnonzero(high > low) if len(members) > 1 and depth < height_limit else []
        if len(splittable) == 0:
            nodes[at] = (-1, 0.0, -1, -1, depth + expected_depth(len(members)))
            continue
        feature = int(rng.choice(splittable))
        cut = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] < cut
        left, right = len(nodes), len(nodes) + 1
        nodes += [None, None]
        nodes[at] = (feature, cut, left, right, 0.0)
        stack.append((left, members[goes_left], depth + 1))
        stack.append((right, members[~goes_left], depth + 1))
    return nodes


def fit(rows, names, id_col="id", trees=fixed.ISOLATION_TREES,
        sample_size=fixed.ISOLATION_SAMPLE, seed=fixed.SEED):
    """Node table of the forest, and the sample size the scores are scaled by."""
    samples, take = draw_samples(rows, names, trees, sample_size, id_col, seed)
    limit = max(1, math.ceil(math.log2(max(take, 2))))

    def grow(group):
        group = group.sort_values("id")
        tree = int(group["tree"].iloc[0])
        nodes = _grow(np.array(group["x"].tolist()), np.random.default_rng([seed, tree]), limit)
        out = pd.DataFrame(nodes, columns=["feature", "cut", "left", "right", "depth"])
        out.insert(0, "node", range(len(nodes)))
        out.insert(0, "tree", tree)
        return out

    # The sample is small in bytes, so name the task count: trees grow side by side.
    spread_out = samples.repartition(trees, "tree")
    return spread_out.groupBy("tree").applyInPandas(grow, NODE), take


class Layout:
    """All trees end to end, ready to advance together: the children of a node are neighbours, and a
    leaf leads to itself."""

    def __init__(self, nodes):
        held = nodes.toPandas().sort_values(["tree", "node"]).reset_index(drop=True)
        starts = held.groupby("tree").size().cumsum().shift(fill_value=0)
        own = np.arange(len(held))
        leaf = held["feature"].to_numpy() < 0
        self.feature = np.where(leaf, 0, held["feature"].to_numpy()).astype(np.intp)
        self.cut = np.where(leaf, np.inf, held["cut"].to_numpy())
        self.left = np.where(leaf, own, held["left"].to_numpy() + held["tree"].map(starts).to_numpy()).astype(np.intp)
        self.depth = np.where(leaf, held["depth"].to_numpy(), 0.0)
        self.roots = starts.to_numpy().astype(np.intp)
        self.levels = self._levels(leaf)

    def _levels(self, leaf):
        """Steps until every path has reached a leaf."""
        level, front = 0, self.roots
        while len(front := front[~leaf[front]]):
            front = np.concatenate([self.left[front], self.left[front] + 1])
            level += 1
        return level


def _scores(x, layout, scale, block=1024, group=32):
    """Scores of the rows of a matrix. A block of rows goes down a group of trees one level at a time,
    in sizes that stay in the processor's caches."""
    lengths = np.zeros(len(x))
    width = x.shape[1]
    base = np.arange(block, dtype=np.intp)[:, None] * width
    for start in range(0, len(x), block):
        flat = np.ascontiguousarray(x[start : start + block]).reshape(-1)
        own = base[: len(flat) // width]
        for first in range(0, len(layout.roots), group):
            roots = layout.roots[first : first + group]
            at = np.repeat(roots[None, :], len(own), axis=0)
            place, value, cut = np.empty_like(at), np.empty(at.shape), np.empty(at.shape)
            for _ in range(layout.levels):
                # Places are in range; "wrap" spares the check and the copy that go with it.
                layout.feature.take(at, out=place, mode="wrap")
                flat.take(np.add(place, own, out=place), out=value, mode="wrap")
                layout.cut.take(at, out=cut, mode="wrap")
                layout.left.take(at, out=place, mode="wrap")
                # Values are finite and a leaf's cut is not, so nothing leaves a leaf.
                np.add(place, value >= cut, out=at)
            lengths[start : start + block] += layout.depth.take(at).sum(axis=1)
    return np.power(2.0, -(lengths / len(layout.roots)) / scale)


def score(rows, nodes, names, take, name="anomaly_score"):
    """Anomaly score of each row in 0..1, higher for stranger rows.

    The node table is bounded by trees * (2 * sample_size - 1) rows and goes to
    the tasks as arrays.
    """
    shared = rows.sparkSession.sparkContext.broadcast(Layout(nodes))
    scale = max(expected_depth(take), 1e-12)

    width = len(names)

    def scored(batches):
        for batch in batches:
            x = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(_scores(x, shared.value, scale))], [*batch.schema.names[:-1], name]
            )

    kept = [c for c in rows.columns if c != name]
    cells = F.array(*[C.finite(F.col(f"`{n}`")) for n in names]).alias("_cells")
    source = rows.select(*[F.col(f"`{c}`") for c in kept], cells)
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField(name, T.DoubleType())])
    return source.mapInArrow(scored, schema)


def decision(anomaly="anomaly_score", offset=0.5):
    """Higher is more normal; the sign flip makes higher mean stranger again."""
    return F.lit(offset) - F.col(anomaly)


def contamination_cutoff(scored, share=fixed.CONTAMINATION, name="anomaly_score", by=()):
    """Score above which the given share of the rows lies."""
    return spread.exact_quantiles(scored, by, name, {"cutoff": 1.0 - share})


def save(nodes, take, names, path):
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    nodes.sparkSession.createDataFrame(
        [(list(names), int(take))], "feature_names array<string>, sample_size int"
    ).write.mode("overwrite").json(f"{path}/metadata")


def load(spark, path):
    meta = spark.read.schema("feature_names array<string>, sample_size int").json(f"{path}/metadata").first()
    return spark.read.schema(NODE).parquet(f"{path}/nodes"), meta["sample_size"], meta["feature_names"]
