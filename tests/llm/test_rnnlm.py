import math
import time
import zlib
from collections import Counter

import numpy as np
import pytest

import cases
from leakwatch.llm import rnnlm as R


def test_gradients_equal_differences():
    net = R.Network(np.arange(40, 0, -1), units=6, count=5)
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    rng = np.random.default_rng(1)
    ids, fresh = rng.integers(0, 40, (7, 3)), np.zeros((7, 3), bool)
    ids[5:, 1] = -1
    fresh[0] = fresh[3, 2] = True
    texts = [ids[:, 0], ids[:5, 1], ids[:3, 2], ids[3:, 2]]
    d, _, n = net.window_gradient(ids, np.zeros((3, 6)), fresh)
    assert n == 19
    for k, v in net.p.items():
        for _ in range(4):
            i = tuple(rng.integers(0, s) for s in v.shape)
            v[i] += 1e-4
            up = -net.score(texts).sum()
            v[i] -= 2e-4
            down = -net.score(texts).sum()
            v[i] += 1e-4
            assert d[k][i] == pytest.approx((up - down) / 2e-4, abs=1e-6)


def test_probabilities_add_up_to_one_and_windows_carry_the_state():
    net = R.Network(np.arange(30, 0, -1), units=5, count=4)
    before = np.array([3, 7, 1])
    base = net.score([before])[0]
    total = sum(math.exp(net.score([np.append(before, w)])[0] - base) for w in range(30))
    assert total == pytest.approx(1.0, abs=1e-5)
    texts = [np.arange(29, -1, -1) % 30 for _ in range(3)] + [np.array([4])]
    assert net.score(texts, window=7) == pytest.approx(net.score(texts, window=100, block=2), rel=1e-5)


def test_training_lowers_the_loss():
    rng = np.random.default_rng(3)
    texts = [np.tile(rng.permutation(6), 20) for _ in range(40)]
    net = R.Network(np.ones(6) * 100, units=8, count=2)
    before = net.score(texts).sum()
    assert net.train(texts, epochs=40).score(texts).sum() > before * 0.9


def test_base_scores_equal_brute_force(spark):
    data = cases.rows()
    mod = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 10
    counts = Counter()
    toks = lambda t: [w.encode("utf-8") for w in cases.words(cases.lower(t))] + [R.END]
    for r in data:
        if mod(r[0]) not in (None, 0):
            counts.update(toks(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for r in data:
        t = toks(r[1])
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in t)
        want.append((r[0], mod(r[0]) == 0, len(t), sum(w in counts for w in t), total, round(base, 6)))
    rows = R.language_scores(cases.frame(spark)).collect()
    got = [(*r[:5], round(r.base_score, 6)) for r in rows]
    assert sorted(got, key=cases.key) == sorted(want, key=cases.key)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


def test_rare_words_give_the_same_sums(spark, monkeypatch):
    every = {(r.doc_id, r.n_known): round(r.base_score, 6) for r in R.language_scores(cases.frame(spark)).collect()}
    monkeypatch.setattr(R, "FREQUENT", 50)
    few = {(r.doc_id, r.n_known): round(r.base_score, 6) for r in R.language_scores(cases.frame(spark)).collect()}
    assert few == every


def test_the_network_beats_plain_counts(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    row = R.language_scores(docs).where("held_out").selectExpr("sum(score) as s", "sum(base_score) as b").first()
    assert row.s > row.b


def test_empty_table(spark):
    assert R.language_scores(cases.frame(spark, [])).count() == 0


def test_every_text_trains_the_network(spark):
    # Over 1,500 rows: a bounded sample would leave some of them out.
    rows = [(i, cases.prose(5 + i % 40, i), "en", "s", 1, 5, "c", 0.1, "n") for i in range(2000)]
    docs = cases.frame(spark, rows).repartition(5)
    counts = R.token_counts(docs)
    want = sum(len(cases.words(r[1])) + 1 for r in rows)
    model = R.fit(docs, counts, epochs=0)
    nets = R.T.staged(R.train_round(docs, model, 0, 1, block_tokens=3000), "test-nets")
    sizes = [r.tokens for r in nets.select("tokens").collect()]
    assert sum(sizes) == want and len(sizes) == 5 and min(sizes) > want / 8
    sums, total = R.average(nets)
    assert total == want
    plain = {}
    for r in nets.orderBy("part").collect():
        plain = R._plus(plain, bytes(r.net))
    for k, v in plain.items():
        assert sums[k] == pytest.approx(v) and not np.allclose(v / total, model.network.p[k])


def test_moments_carry_over_blocks():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 6, 40) for _ in range(20)]
    net, moments = R.Network(np.ones(6) * 100, units=8, count=2), {}
    for k in range(4):
        net.train(texts[5 * k : 5 * k + 5], 1, moments=moments)
    assert moments["turn"] == 8


def plain_score(net, texts, window=32):
    """The same scores, one array after the other and a softmax per class."""
    p, u = net.p, net.units
    texts, size = np.stack(texts), len(texts[0])
    h, total = np.zeros((len(texts), u), np.float32), np.zeros(len(texts))
    for t0 in range(0, size, window):
        states, words = [], []
        for t in range(t0, min(t0 + window, size)):
            states.append(h)
            words.append(texts[:, t])
            e = p["e"][texts[:, t]]
            gates = 1 / (1 + np.exp(-(e[:, : 2 * u] + h @ p["g"])))
            c = np.tanh(e[:, 2 * u :] + (gates[:, u:] * h) @ p["c"])
            h = h + gates[:, :u] * (c - h)
        states, words = np.concatenate(states), np.concatenate(words)

        def log_soft(logits, at):
            top = logits.max(axis=1)
            return logits[np.arange(len(at)), at] - top - np.log(np.exp(logits - top[:, None]).sum(axis=1))

        cls = net.cls[words]
        found = log_soft(states @ p["wc"] + p["bc"], cls)
        for k in np.unique(cls):
            rows, a, b = np.flatnonzero(cls == k), net.start[k], net.start[k + 1]
            found[rows] += log_soft(states[rows] @ p["wo"][:, a:b] + p["bo"][a:b], words[rows] - a)
        total += found.reshape(-1, len(texts)).sum(axis=0)
    return total


def test_scores_equal_plain_ones():
    rng = np.random.default_rng(4)
    net = R.Network(1e6 / np.arange(1, 1025))
    texts = [np.minimum(rng.zipf(1.2, 128) - 1, 1023) for _ in range(100)]
    net.train(texts[:64], 2)
    assert net.score(texts) == pytest.approx(plain_score(net, texts), rel=1e-5)


def test_training_costs_a_few_plain_scores():
    # 1.4 of them; with arrays made anew in every step 2.7 to 3.1.
    rng = np.random.default_rng(4)
    net = R.Network(1e6 / np.arange(1, 1025))
    texts = [np.minimum(rng.zipf(1.2, 1024) - 1, 1023) for _ in range(64)]

    def seconds(run):
        begin = time.process_time()
        run()
        return time.process_time() - begin

    R._keep_memory()
    trained = min(seconds(lambda: net.train(texts, 1)) for _ in range(5))
    plain = min(seconds(lambda: plain_score(net, texts)) for _ in range(5))
    assert trained < 2 * plain


def test_logits_far_apart_stay_finite():
    net = R.Network(np.arange(30, 0, -1), units=5, count=4)
    net.p["bc"] *= 1000
    net.p["bo"] *= 1000
    texts = [np.arange(30), np.arange(29, -1, -1)]
    assert np.isfinite(net.score(texts)).all()
    assert net.score(texts) == pytest.approx(plain_score(net, texts), rel=1e-5)
    ids, fresh = np.stack(texts, axis=1), np.zeros((30, 2), bool)
    d, *_ = net.window_gradient(ids, np.zeros((2, 5), np.float32), fresh)
    assert all(np.isfinite(v).all() for v in d.values())


def test_words_of_arrow_columns_are_those_of_texts():
    rng = np.random.default_rng(6)
    marks = list("aZbÄ \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u2003\x00") + ["  ", "É"]
    texts = [None, "", " \n", *["".join(rng.choice(marks, rng.integers(0, 12))) for _ in range(500)]]
    column = R.pa.array(["left out", *texts], R.pa.string()).slice(1)
    parts = list(R.pieces(column, 40))
    assert [t for p in parts for t in p.to_pylist()] == texts and len(parts) > 20
    assert all(len(p) == 1 or R.pc.sum(R.pc.binary_length(p)).as_py() <= 40 for p in parts)
    words, size = R.flat_words(column)
    want = [R.tokens(t)[:-1] for t in texts]
    assert size.tolist() == [len(w) for w in want] and words.to_pylist() == [w for t in want for w in t]


def test_as_many_words_are_held_as_may_be(spark, monkeypatch):
    monkeypatch.setattr(R, "FREQUENT", 20)
    rows = [(b"a", 1000)] + [(b"b%d" % i, 5) for i in range(10)] + [(b"c%d" % i, 2) for i in range(15)]
    counts = spark.createDataFrame(rows, "word binary, c bigint")
    model = R.fit(cases.frame(spark, []), counts, epochs=0)
    # Only the first has one part in 20 of all; the fifteen rarest are too many together.
    assert model.least == 5 and len(model.frequent) == 11
    assert R._least_held(counts.limit(0), 0) == 0
    monkeypatch.setattr(R, "FREQUENT", 26)
    assert R._least_held(counts, 1080) == 2
