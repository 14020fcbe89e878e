import hashlib
from fractions import Fraction

import pytest

import cases
from leakwatch.llm import mixing


def brute_targets(sizes, share=Fraction(3, 2), cap=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, full = set(sizes), set()
    total = sum(sizes.values()) * share
    while True:
        open_ = left - full
        rest = total - sum(cap * sizes[s] for s in full)
        rate = rest / sum(weight[s] for s in open_) if open_ else 0
        above = {s for s in open_ if rate * weight[s] > cap * sizes[s]}
        if not above:
            return {s: float(cap * sizes[s]) if s in full else float(rate * weight[s]) for s in sizes}
        full |= above


def brute(data):
    size = lambda r: len(cases.words(r[1]))
    sizes = {}
    for r in data:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r)
    targets, out = brute_targets(sizes), []
    for s, t in targets.items():
        place = lambda r: int(hashlib.md5(f"{'' if r[0] is None else r[0]}:mix".encode()).hexdigest()[:15], 16)
        mine = sorted((r for r in data if r[3] == s), key=lambda r: (place(r), r[0] or -1, size(r)))
        turns = int(t // sizes[s]) if sizes[s] else 0
        rest = int(t) - turns * sizes[s]
        for r in mine:
            cut = min(max(rest, 0), size(r))
            rest -= cut
            out.append((r[0], size(r), sizes[s], t, turns * size(r) + cut))
    return out


def test_plan_equals_brute_force(spark):
    got = [tuple(r) for r in mixing.mix_plan(cases.frame(spark)).collect()]
    want = brute(cases.rows())
    strip = lambda rows: sorted(((*r[:3], round(r[3], 6), r[4]) for r in rows), key=cases.key)
    assert strip(got) == strip(want)


def test_words_taken_meet_the_targets(spark):
    rows = mixing.mix_plan(cases.frame(spark)).collect()
    taken, target = {}, {}
    for r in rows:
        k = (r.source_size, r.target)
        taken[k] = taken.get(k, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    for (size, t), n in taken.items():
        assert n % max(int(t), 1) == 0 or abs(n - t) < 1 or size == 0


def test_mixed_rows_hold_the_words_taken(spark):
    docs = cases.frame(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    plan = mixing.mix_plan(docs).collect()
    assert sum(len(cases.words(r.text)) for r in mixed.collect()) == sum(r.taken for r in plan)
    texts = {r[1] for r in cases.rows() if r[1]}
    assert all(any(t.startswith(r.text) for t in texts) for r in mixed.collect())


def test_row_order_does_not_matter(spark):
    docs = cases.frame(spark)
    once = sorted(map(tuple, mixing.mix_plan(docs).collect()), key=cases.key)
    again = sorted(map(tuple, mixing.mix_plan(docs.orderBy("n_chars").repartition(5)).collect()), key=cases.key)
    assert once == again


def test_empty_table(spark):
    assert mixing.mix_plan(cases.frame(spark, [])).count() == 0 and mixing.mix(cases.frame(spark, [])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 4, 9])
def test_first_words_keeps_gaps(spark, n):
    from pyspark.sql import functions as F

    text = "  a\tbb \n c  d "
    got = spark.range(1).select(mixing.first_words(F.lit(text), F.lit(n)).alias("t")).first().t
    assert text.startswith(got) and len(got.split()) == min(n, 4)


def test_equal_rows_on_the_cut_are_whole_until_the_budget_is_used(spark):
    copy = cases.prose(100, 1)
    rows = [(7, copy, "en", "s", 1, 5, "c", 0.1, "n")] * 400 + [(8, cases.prose(100, 2), "en", None, 1, 5, "c", 0.1, "n")] * 3
    docs = cases.frame(spark, rows).repartition(6)
    share = (1, 100)  # 403 words: 287 of the one source, 115 of the other
    plan = mixing.mix_plan(docs, share=share).collect()
    sizes = sorted(len(cases.words(r.text)) for r in mixing.mix(docs, share=share).collect())
    assert sizes == sorted(r.taken for r in plan if r.taken) and sizes.count(100) == 3


def test_more_sources_than_are_broadcast_give_the_same_mix(spark, monkeypatch):
    docs = cases.frame(spark)
    few = sorted(map(tuple, mixing.mix(docs).collect()), key=cases.key)
    monkeypatch.setattr(mixing, "MOST_SOURCES", 3)
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=cases.key) == few
