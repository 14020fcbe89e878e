import hashlib
import random
import zlib

import numpy as np
import pytest

from leakwatch.llm import periods
from tests.llm import cases


def brute_runs(x):
    """(start, length, period) by start, then period, straight from the definition."""
    found = {}
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted([(s, n, q) for (s, n), q in found.items()], key=lambda r: (r[0], r[2]))


def planted_words(doc_id, text):
    w = cases.words(text)
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


@pytest.mark.parametrize("alphabet", [1, 2, 3, 12])
def test_runs_equal_brute_force(alphabet):
    rng = random.Random(alphabet)
    long = 0
    for _ in range(120):
        x = [rng.randrange(alphabet) for _ in range(rng.randint(0, 500))]
        for _ in range(rng.randint(0, 4)):
            if len(x) > 8:
                p, s = rng.randint(1, len(x) // 5 + 1), rng.randrange(len(x))
                for i in range(s + p, min(len(x), s + p * rng.randint(3, 7) + rng.randrange(p + 1))):
                    x[i] = x[i - p]
        want = brute_runs(x)
        long += sum(q > periods.LAGS for _, _, q in want)
        assert [tuple(r) for r in periods.find_runs(np.array(x, np.int64)).tolist()] == want
    assert alphabet < 3 or long > 20  # the scales are put to use


def test_runs_in_runs():
    inner = [1] * 9 + [2]
    x = ([0] * 7 + inner * 5 + [3]) * 6
    assert [tuple(r) for r in periods.find_runs(np.array(x, np.int64)).tolist()] == brute_runs(x)


def test_long_text_of_one_word_and_long_period():
    one = periods.find_runs(np.zeros(200_000, np.int64))
    assert one.tolist() == [[0, 200_000, 1]]
    part = list(range(30_000))
    assert periods.find_runs(np.array(part * 4 + [7], np.int64)).tolist() == [[0, 120_000, 30_000]]


def test_equal_fingerprints_are_compared_word_by_word(monkeypatch):
    monkeypatch.setattr(periods, "mixed", lambda v: np.zeros(len(v), np.uint64))  # all collide
    x = list(range(20)) * 5 + [99, 98] + [1, 2, 3] * 6
    got = periods.find_runs(np.array(x, np.int64)).tolist()
    assert all(tuple(r) in brute_runs(x) for r in got)


def test_query_on_odd_rows(spark):
    docs = cases.frame(spark)
    got = periods.run_digests(periods.periodic_runs(periods.with_planted_runs(docs))).collect()
    want = []
    for doc_id, text, *_ in cases.rows():
        w = planted_words(doc_id, text)
        runs = brute_runs(w)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        head = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((doc_id, len(runs), *head, *(hashlib.sha256(t.encode()).hexdigest() for t in (lines, kept))))
    assert sorted(map(tuple, got), key=cases.key) == sorted(want, key=cases.key)


def test_spans_and_text_of_the_operator(spark):
    docs = spark.createDataFrame([(1, "x  a b\na b a\tb a b z", "clash")], "doc_id bigint, text string, runs string")
    row = periods.periodic_runs(docs).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 8, 2)]
    assert row["collapsed"] == "x a b z" and row["n_words"] == 10


def test_empty_table(spark):
    assert periods.run_digests(periods.periodic_runs(cases.frame(spark, []))).count() == 0
