import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from leakwatch.functions import columns as C
from leakwatch.operators import prep, spread


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else "cold", i, rng.randrange(2), rng.randrange(300) / 300) for i in range(3000)]
    return spark.createDataFrame(rows, "model string, id bigint, label int, score double").cache()


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals(scores, descending):
    values = {"n": F.count(F.lit(1)), "pos": F.sum("label")}
    got = spread.running_totals(scores, ["model"], "score", values, descending).collect()
    for model, part in scores.toPandas().groupby("model"):
        sums = part.groupby("score")["label"].agg(["count", "sum"]).sort_index(ascending=not descending)
        mine = {r["score"]: r for r in got if r["model"] == model}
        assert len(mine) == len(sums) and {r["total_n"] for r in mine.values()} == {len(part)}
        for score, n, pos in zip(sums.index, sums["count"].cumsum(), sums["sum"].cumsum()):
            assert (mine[score]["cum_n"], mine[score]["cum_pos"]) == (n, pos)


def test_exact_quantiles(scores):
    out = {r["model"]: r for r in spread.exact_quantiles(scores, ["model"], "score", {"med": 0.5, "high": 0.95}).collect()}
    held = scores.toPandas()
    for model, part in held.groupby("model"):
        assert out[model]["med"] == pytest.approx(np.quantile(part["score"], 0.5))
        assert out[model]["high"] == pytest.approx(np.quantile(part["score"], 0.95))


def test_quantiles_of_a_whole_table(scores):
    got = spread.exact_quantiles(scores, [], "score", {"med": 0.5}).first()["med"]
    assert got == pytest.approx(np.quantile(scores.toPandas()["score"], 0.5))


def test_global_rank_is_a_permutation(scores):
    ranked = spread.global_rank(scores, ["model"], C.mix("id", 1), C.MIX_DOMAIN, "id").collect()
    for model, size in Counter(r["model"] for r in ranked).items():
        mine = [r for r in ranked if r["model"] == model]
        assert sorted(r["_rank"] for r in mine) == list(range(1, size + 1))
        assert {r["_rank_of"] for r in mine} == {size}


def test_cuts_lie_at_their_ranks(scores):
    ranks = {"tenth": lambda n: F.floor(n / 10), "all": lambda n: n + 5, "none": lambda n: F.lit(0)}
    cuts = spread.hash_cuts(scores, ["model"], C.mix("id", 1), C.MIX_DOMAIN, "id", ranks)
    rows = scores.withColumn("h", C.mix("id", 1)).collect()
    for (model,), at in cuts.items():
        order = sorted((r["h"], r["id"]) for r in rows if r["model"] == model)
        assert at == {"tenth": order[len(order) // 10 - 1], "all": order[-1], "none": None}
    assert spread.hash_cuts(scores.limit(0), ["model"], C.mix("id", 1), C.MIX_DOMAIN, "id", ranks) == {}


def test_subsample_needs_no_shuffle(scores):
    plan = prep.uniform_subsample(scores, 100)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_split_shares_and_repeatability(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
    out = prep.stratified_split(rows).groupBy("split", "label").count().collect()
    assert {(r["split"], r["label"]): r["count"] for r in out} == {
        ("train", 0): 630, ("test", 0): 135, ("val", 0): 135, ("train", 1): 70, ("test", 1): 15, ("val", 1): 15,
    }
    again = prep.stratified_split(rows.repartition(5))
    assert rows_of(again, "id") == rows_of(prep.stratified_split(rows), "id")


def test_subsample_is_exact(spark):
    rows = spark.range(500).withColumn("label", (F.col("id") < 20).cast("int"))
    assert prep.uniform_subsample(rows, 77).count() == 77
    sizes = {r["label"]: r["count"] for r in prep.subsample_realistic(rows, 100).groupBy("label").count().collect()}
    assert sizes == {1: 2, 0: 98}


def test_constant_column_scales_by_one(spark):
    rows = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id bigint, v double")
    out = prep.standardize(rows, ["v"], prep.fit_scaler(rows, ["v"])).collect()
    assert [r["v"] for r in out] == [0.0, 0.0]


def test_hashed_draws_look_uniform_and_normal(spark):
    keys = C.draw_keys("id", "id")
    row = spark.range(20_000).select(C.unit_of(keys, 3).alias("u"), C.normal_of(keys, 3).alias("z")).agg(
        F.avg("u"), F.stddev("u"), F.avg("z"), F.stddev("z")).first()
    assert row[0] == pytest.approx(0.5, abs=0.02) and row[1] == pytest.approx(0.2887, abs=0.02)
    assert row[2] == pytest.approx(0.0, abs=0.04) and row[3] == pytest.approx(1.0, abs=0.04)


def test_exact_rounding_follows_the_binary_value(spark):
    values = [0.5255, 0.125, 0.375, 412.2805, 2.675, 1.005, -0.125, 1e9 + 0.5, 0.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (0, 1, 2, 3):
        got = [r[0] for r in rows.select(C.fixed_text(F.col("v"), digits)).collect()]
        assert [float(g) for g in got] == [float(f"{v:.{digits}f}") for v in values]


def test_safe_division(spark):
    rows = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (1e308, 1e-10), (6.0, 3.0), (float("nan"), 1.0)], "a double, b double")
    assert [r[0] for r in rows.select(C.safe_div("a", "b", -1.0)).collect()] == [-1.0, -1.0, -1.0, -1.0, 2.0, -1.0]
