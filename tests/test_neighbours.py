import numpy as np
import pytest
from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.operators import neighbours, oversample


def brute(points, k, ids=None):
    out = []
    ids = np.arange(len(points)) if ids is None else ids
    for i, p in enumerate(points):
        gaps = np.zeros(len(points))
        for j in range(points.shape[1]):
            gaps += (p[j] - points[:, j]) ** 2
        order = [n for n in np.lexsort((ids, gaps)) if n != i][:k]
        out += [(int(ids[i]), int(ids[n]), float(gaps[n]), rank) for rank, n in enumerate(order, 1)]
    return sorted(out)


def frame(spark, points, ids=None):
    ids = range(len(points)) if ids is None else ids
    names = [f"c{j}" for j in range(points.shape[1])]
    rows = [(int(i), *map(float, p), "clash", 7) for i, p in zip(ids, points)]
    return spark.createDataFrame(rows, f"id bigint, {', '.join(n + ' double' for n in names)}, x string, pid int"), names


def clouds():
    rng = np.random.default_rng(4)
    return {
        "lattice": rng.integers(0, 5, (300, 2)).astype(float),
        "tails": np.exp(rng.normal(size=(500, 3)) * 4),
        "hot point": np.concatenate([np.zeros((250, 2)), rng.normal(size=(120, 2)), np.zeros((40, 2))]),
        "line": np.repeat(np.arange(200.0)[:, None], 2, axis=1),
        "clusters": np.concatenate([rng.normal(size=(150, 2)) * 0.01 + 1e6, rng.normal(size=(150, 2))]),
        "few": rng.normal(size=(3, 2)),
    }


@pytest.mark.parametrize("name", clouds())
@pytest.mark.parametrize("ring_points", [10**6, 8])
def test_neighbours_equal_brute_force(spark, monkeypatch, name, ring_points):
    monkeypatch.setattr(neighbours, "POINTS_PER_CELL", 20)
    monkeypatch.setattr(neighbours, "QUERIES_PER_TASK", 50)
    points = clouds()[name]
    rows, names = frame(spark, points)
    assert sorted(map(tuple, neighbours.nearest_neighbours(rows, names, 5, ring_points=ring_points).collect())) == brute(points, 5)


def test_wide_ids_missing_cells_and_empty_input(spark):
    points = clouds()["tails"][:40]
    ids = np.arange(40) * 2**57 - 2**61
    rows, names = frame(spark, points, ids)
    odd = rows.unionByName(rows.limit(3).withColumns({"id": F.col("id") + 1, "c0": F.lit(None).cast("double")}))
    odd = odd.unionByName(rows.limit(3).withColumns({"id": F.col("id") + 2, "c1": F.lit(float("nan"))}))
    assert sorted(map(tuple, neighbours.nearest_neighbours(odd, names, 3).collect())) == brute(points, 3, ids)
    assert neighbours.nearest_neighbours(rows.limit(0), names).count() == 0


def test_second_round_goes_to_few_rings(spark, monkeypatch):
    """Points that are spread evenly meet a bounded number of rings, however many there are."""
    points = np.random.default_rng(1).random((4000, 2))
    rows, names = frame(spark, points)
    monkeypatch.setattr(neighbours, "POINTS_PER_CELL", 100)
    sizes = {}
    real = neighbours.staged

    def watch(df, name):
        out = real(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(neighbours, "staged", watch)
    neighbours.nearest_neighbours(rows, names, 5).count()
    assert sizes["second-round"] < 6 * 4000


def test_copies_of_one_row_are_made_by_many_tasks(spark):
    one = spark.createDataFrame([(2**61 + 5, 10.0, -3.0)], "id bigint, a double, b double")
    made = oversample.even_copies(one, "id", 1, 1_000_000, 42).withColumn("at", F.spark_partition_id())
    shares = [r["count"] for r in made.groupBy("at").count().collect()]
    assert sum(shares) == 1_000_000 and len(shares) > 3 and max(shares) < 500_000
    assert made.agg(F.min("copy"), F.max("copy"), F.countDistinct("copy")).first()[:] == (1, 1_000_000, 1_000_000)


def test_no_draw_is_repeated(spark):
    pairs = spark.range(1_000_000).select((F.col("id") % 1000).alias("id"), (F.floor(F.col("id") / 1000) + 1).alias("copy"))
    far = spark.range(1000).select((F.col("id") + C.MIX_DOMAIN).alias("id"), F.lit(1).cast("bigint").alias("copy"))
    both = pairs.unionByName(far)
    keys = C.draw_keys("id", "copy")
    draws = both.select(C.unit_of(keys, 42).alias("u"), C.unit_of(keys, 43).alias("v"), C.normal_of(keys, 7).alias("z"))
    stats = draws.agg(F.countDistinct("u"), F.avg("u"), F.avg("z"), F.stddev_pop("z"), F.corr("u", "v"), F.min("u"), F.max("u")).first()
    assert stats[0] == 1_001_000 and abs(stats[1] - 0.5) < 0.002 and abs(stats[2]) < 0.005
    assert abs(stats[3] - 1) < 0.005 and abs(stats[4]) < 0.005 and 0 < stats[5] and stats[6] < 1
