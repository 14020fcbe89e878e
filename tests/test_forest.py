import numpy as np
import pytest
from pyspark.sql import functions as F

from leakwatch.operators import explore, iforest


def cloud(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=(n, 3)), rng.normal(size=(8, 3)) + 9])
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id bigint, a double, b double, c double")


@pytest.mark.parametrize("n", [5, 200, 6000])
def test_samples_are_exact_and_repeatable(spark, n):
    rows = cloud(spark, n)
    drawn, take = iforest.draw_samples(rows, ["a", "b"], 40, 64, "id", 1)
    sizes = drawn.groupBy("tree").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("d")).collect()
    assert take == min(64, n + 8) and len(sizes) == 40 and all(r["n"] == r["d"] == take for r in sizes)
    again, _ = iforest.draw_samples(rows.repartition(7, "a"), ["a", "b"], 40, 64, "id", 1)
    assert sorted(map(tuple, drawn.select("tree", "id").collect())) == sorted(map(tuple, again.select("tree", "id").collect()))


def test_candidates_are_spread_evenly():
    keys = np.arange(20_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    places, trees = iforest.candidate_pairs(keys, 50, 0.03, 9)
    by_tree = np.bincount(trees, minlength=50)
    assert len(set(zip(places.tolist(), trees.tolist()))) == len(places)
    assert abs(by_tree.mean() - 600) < 20 and abs(by_tree - 600).max() < 130
    whole, all_trees = iforest.candidate_pairs(keys[:10], 7, 1.0, 9)
    assert len(whole) == 70 and len(set(zip(whole.tolist(), all_trees.tolist()))) == 70


def test_level_walk_equals_a_walk_of_each_tree(spark):
    rows = cloud(spark, 700)
    nodes, take = iforest.fit(rows, ["a", "b", "c"], trees=30, sample_size=64)
    nodes = nodes.cache()
    held = {(r["tree"], r["node"]): r for r in nodes.collect()}
    scale = iforest.expected_depth(take)
    for row in iforest.score(rows, nodes, ["a", "b", "c"], take).collect():
        x, depth = (row["a"], row["b"], row["c"]), []
        for tree in range(30):
            node = held[tree, 0]
            while node["feature"] >= 0:
                node = held[tree, node["left"] if x[node["feature"]] < node["cut"] else node["right"]]
            depth.append(node["depth"])
        assert row["anomaly_score"] == pytest.approx(2.0 ** (-np.mean(depth) / scale), abs=1e-12)


def test_far_points_score_highest(spark):
    rows = cloud(spark, 3000)
    nodes, take = iforest.fit(rows.filter("id < 3000"), ["a", "b", "c"], trees=100)
    scored = iforest.score(rows, nodes, ["a", "b", "c"], take)
    top = {r["id"] for r in scored.orderBy(F.desc("anomaly_score")).limit(8).collect()}
    assert top == set(range(3000, 3008))


def test_correlations_with_large_means_constants_and_odd_cells(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 3))
    x[:, 1] += x[:, 0]
    frame = spark.createDataFrame([(1e9 + float(r[0]), 1e9 + float(r[1]), float(r[2]), 0.1) for r in x], "a double, b double, c double, k double")
    got = {(r["feature_a"], r["feature_b"]): r["r"] for r in explore.correlation_matrix(frame.repartition(9), ["a", "b", "c", "k"]).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef(x[:, 0], x[:, 1])[0, 1], abs=1e-6)
    assert got["a", "c"] == pytest.approx(np.corrcoef(x[:, 0], x[:, 2])[0, 1], abs=1e-6)
    assert got["a", "k"] is None and got["c", "k"] is None and len(got) == 6
    odd = frame.limit(2).select("a", F.lit(None).cast("double").alias("b"))
    assert explore.correlation_matrix(odd, ["a", "b"]).first()["r"] is None
