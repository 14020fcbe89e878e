import pytest
from pyspark.sql import functions as F

import cases
from leakwatch.llm import langid as L


def test_held_out_languages_are_found(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = out.where("held_out").agg(F.count(F.lit(1)), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert held[0] > 20 and held[1] / held[0] >= 0.95
    assert out.where("score < 0 or score > 1 or score is null").count() == 0


def test_odd_rows(spark):
    rows = {r.doc_id: r for r in L.identify(cases.frame(spark)).collect()}
    for i in (100, 101, 102):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    assert rows[106].lang_pred in {"en", "de", "fr"} and L.identify(cases.frame(spark)).count() == len(cases.rows())
    assert not rows[None].held_out


def test_only_letters_count():
    assert L.letter_words("Ab1c ² ½ 12_x") == ["ab", "c", "²", "½", "x"]
    assert L.letter_words("²½ 12 __") == [] and L.letter_words(None) == []


def test_unknown_words_fall_back_to_shorter_grams():
    rows = [("a", 0, "known", 5), ("b", 2, "xy", 9), ("a", 1, "q", 3)]
    model = L.Model(rows, {("a", 0): 5, ("a", 1): 3, ("a", 2): 1, ("b", 0): 1, ("b", 1): 1, ("b", 2): 9})
    assert model.word("known")[0] > model.word("known")[1]
    assert model.word("xy")[1] > model.word("xy")[0]  # by its pair
    assert model.word("qqq")[0] > model.word("qqq")[1]  # by its letters
    assert model.word("zzz").tolist() == [0.0, 0.0]


def test_full_store_gives_the_same_scores(monkeypatch):
    model = L.Model([("a", 0, "x", 2), ("b", 0, "y", 2)], {("a", 0): 2, ("b", 0): 2})
    store = L._Store(model)
    first = L.judge(store, "x x y")
    monkeypatch.setattr(L, "STORE_WORDS", 0)
    assert L.judge(store, "x x y") == pytest.approx(first) and first[0] == "a"


def test_nothing_to_learn(spark):
    frame = cases.frame(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in L.identify(frame).collect()} == {("und", 0.0)}
    assert L.identify(cases.frame(spark, [])).count() == 0
