import random

import numpy as np
import pytest

import cases
from leakwatch.llm import toxicity as X


def brute_segments(scores):
    """Maximal segments by their definition: take the best, then both sides of it."""
    if not any(s > 0 for s in scores):
        return []
    best = None
    for a in range(len(scores)):
        total = 0.0
        for b in range(a, len(scores)):
            total += scores[b]
            if best is None or total > best[2] + 1e-9:
                best = (a, b + 1, total)
    a, b, total = best
    return brute_segments(scores[:a]) + [best] + [(x + b, y + b, t) for x, y, t in brute_segments(scores[b:])]


def test_segments_equal_their_definition():
    rng = random.Random(6)
    for _ in range(300):
        scores = [rng.randint(-40, 30) + rng.random() for _ in range(rng.randrange(14))]
        got = sorted(X.segments(np.array(scores)))
        want = sorted(brute_segments(scores))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [t for *_, t in got] == pytest.approx([t for *_, t in want])


def test_rare_keys_say_nothing():
    assert X.log_odds(0, 1, 10**6, 10**5) == 0.0
    assert X.log_odds(0, 400, 10**6, 10**5) > 3
    assert X.log_odds(4000, 400, 10**6, 10**5) == pytest.approx(0.0, abs=0.2)


def test_surprise_falls_with_length_and_rises_with_score():
    def of(*best, n):
        return X.surprise([list(best) + [0.0] * (X.TOGETHER - len(best))], n, 1.0, 0.1)[0]

    assert of(5, n=100) > of(5, n=1000) > of(3, n=1000)
    assert of(12, 12, 12, n=100) > of(12, 12, n=100) > of(12, n=100)
    assert of(12, 1, n=100) == of(12, n=100)
    assert of(n=1) == of(n=10**6) == 0


def test_one_segment_follows_the_extreme_value_law():
    for best, n in [(0.5, 10), (4.0, 50), (9.0, 5000)]:
        chance = 1 - np.exp(-0.2 * n * np.exp(-0.9 * best))
        assert X.surprise([[best] + [0.0] * (X.TOGETHER - 1)], n, 0.9, 0.2)[0] == pytest.approx(-np.log(chance))


def test_odds_are_those_of_smoothed_shares():
    a = 10.0 * 40 / 1100
    plain = np.log((30 + a) / (110 - 30 - a)) - np.log((10 + a) / (1010 - 10 - a))
    assert X.log_odds(10, 30, 1000, 100, 10.0, 0.0) == pytest.approx(plain)
    assert 0 < X.log_odds(10, 30, 1000, 100, 10.0, 1.0) < plain


def test_counts_of_folds_equal_a_plain_count(spark):
    texts = ["Ugly words here", "words words", "", None, "here ugly"]
    rows = [(i % 2, i % X.FOLDS, t) for i, t in enumerate(texts)]
    want = {}
    for toxic, fold, text in rows:
        for key in {k for w in X.tokens(text) for k in X._keys(w)}:
            want.setdefault(key, ([0] * X.FOLDS, [0] * X.FOLDS))[toxic][fold] += 1
    got = X._counts(spark.createDataFrame(rows, "toxic int, fold int, text string"))
    assert {r.key: (list(r.n0), list(r.n1)) for r in got.collect()} == want


def test_held_out_texts(spark, sf):
    sf = sf.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    known = docs.select("doc_id", "lang").join(labels.groupBy("doc_id").agg({"toxic": "max"}), "doc_id")
    out = X.judge(docs, labels).join(known, "doc_id").where("held_out").withColumnRenamed("max(toxic)", "toxic")
    found = {}
    for r in out.groupBy("lang", "toxic", "predicted").count().collect():
        found[r.lang, r.toxic, r.predicted] = r["count"]
    for lang in ("en", "fr", "de", "es"):
        hit, missed = (found.get((lang, 1, p), 0) for p in (1, 0))
        assert hit / (hit + missed) >= 0.85, (lang, hit, missed)
    wrong, right = (sum(n for (_, t, p), n in found.items() if (t, p) == (0, q)) for q in (1, 0))
    assert wrong / (wrong + right) <= 0.03


def test_copies_of_a_text_teach_once(spark):
    texts = [(f"plain words number {i} of ordinary prose", 0) for i in range(60)]
    texts += [(f"filthy insult number {i} in bad prose", 1) for i in range(30)]
    once = X.fit(spark.createDataFrame(texts, "text string, toxic int"))
    often = X.fit(spark.createDataFrame(texts + texts[-1:] * 500, "text string, toxic int"))
    assert once.scores == often.scores and (once.slope, once.base) == pytest.approx((often.slope, often.base))
    assert once.scores["filthy"] > 0 > once.scores["plain"]


def test_odd_rows(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(24)] + [(3, 0), (None, 1), (5, None)], "doc_id bigint, toxic int")
    out = X.judge(cases.frame(spark), labels).collect()
    assert len(out) == len(cases.rows()) and all(0 <= r.score <= 1 for r in out)
    empty = X.judge(cases.frame(spark), labels.limit(0)).collect()
    assert {r.predicted for r in empty} == {0}
    assert X.judge(cases.frame(spark, []), labels).count() == 0
    assert all(r.predicted == int(r.score >= 0.3) for r in out)
