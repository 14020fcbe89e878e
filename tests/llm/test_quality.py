import re

import pytest

import cases
from leakwatch.llm import quality


def brute(text):
    ws = cases.words(text)
    text = text or ""
    grams = {}
    for i in range(len(ws) - 2):
        grams.setdefault(tuple(ws[i : i + 3]), []).append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if cases.words(x)]
    n, chars, symbols = len(ws), sum(map(len, ws)), len(re.findall(quality.SYMBOLS, text))
    dup = len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(covered) > 50 * n
    letters = sum(c.isalpha() for c in text)
    out = symbols * 10 > n or dup * 2 > len(lines) or not 2 * n <= chars <= 14 * n or letters * 10 < chars * 3
    return n, chars, symbols, dup, len(covered), failed, not failed and not out


def test_counts_and_verdicts_equal_brute_force(spark):
    got = quality.measure(cases.frame(spark)).collect()
    want = [(r[0], *brute(r[1])) for r in cases.rows()]
    assert sorted(map(tuple, got), key=cases.key) == sorted(want, key=cases.key)


def test_the_whole_cascade_keeps_the_same_rows(spark):
    kept = quality.keep_good(cases.frame(spark))
    assert kept.columns == cases.frame(spark).columns
    want = [r for r in cases.rows() if brute(r[1])[-1]]
    assert sorted(map(tuple, kept.collect()), key=cases.key) == sorted(want, key=cases.key)


def test_rules_run_by_rejections_per_cost():
    stats = {"slow": (0.5, 1.0), "fast": (0.4, 0.01), "idle": (0.0, 0.001)}
    assert sorted(stats, key=lambda n: -stats[n][0] / stats[n][1]) == ["fast", "slow", "idle"]


def test_any_order_gives_the_same_verdict(spark):
    docs = quality.with_words(cases.frame(spark).select("doc_id", "text"))
    found = set()
    for order in (list(quality.RULES), list(reversed(quality.RULES))):
        passed = docs.where(quality.first_rejection(order).isNull()).select("doc_id").collect()
        found.add(tuple(sorted(str(r[0]) for r in passed)))
    assert len(found) == 1


def test_empty_table(spark):
    empty = cases.frame(spark, [])
    assert quality.measure(empty).count() == 0 and quality.keep_good(empty).count() == 0


def test_stats_see_what_a_rule_rejects(spark):
    sample = quality.with_words(spark.createDataFrame([("a",), ("b " * 60,)], "text string"))
    stats = {n: share for n, share, _ in quality.rule_stats(sample, {"few_words": quality.RULES["few_words"]})}
    assert stats == {"few_words": pytest.approx(0.5)}
