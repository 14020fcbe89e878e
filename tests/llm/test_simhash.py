import random

import numpy as np
import pytest
import xxhash

import cases
from leakwatch.llm import simhash as S


def fingerprint(text):
    w = [x.encode() for x in cases.words(cases.lower(text))]
    grams = [b" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, distance=2):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    order = sorted(root)
    for i, a in enumerate(order):
        for b in order[:i]:
            if bin(a ^ b).count("1") <= distance:
                root[find(a)] = find(b)
    return {v: find(v) for v in order}


def test_documents_equal_brute_force(spark):
    data = cases.rows()
    fps = [fingerprint(r[1]) for r in data]
    group = components(set(fps))
    least = {}
    for r, f in zip(data, fps):
        if r[0] is not None:
            least[group[f]] = min(r[0], least.get(group[f], r[0]))
    want = [(r[0], f"{f:016x}", least.get(group[f])) for r, f in zip(data, fps)]
    got = S.near_duplicates(cases.frame(spark)).collect()
    assert sorted(map(tuple, got), key=cases.key) == sorted(want, key=cases.key)


def _cloud(seed, n):
    """Fingerprints in chains and dense balls, so that buckets are crowded."""
    rng = random.Random(seed)
    centers = [rng.getrandbits(64) for _ in range(5)] + [0, (1 << 64) - 1]
    out = set()
    while len(out) < n:
        v = rng.choice(centers)
        for _ in range(rng.randint(0, 5)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
        if rng.random() < 0.2:
            out.add(rng.getrandbits(64))
    return out


@pytest.mark.parametrize("bucket_rows", [1, 8, 10**6])
def test_links_keep_every_connection(spark, bucket_rows):
    values = _cloud(3, 500)
    signed = {v: int(np.uint64(v).view(np.int64)) for v in values}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "_fp bigint")
    edges = S.links(frame, bucket_rows=bucket_rows).collect()
    back = {s: v for v, s in signed.items()}
    assert all(bin(back[e.a] ^ back[e.b]).count("1") <= 4 for e in edges)
    roots = {r.node: r.root for r in S.components(spark.createDataFrame(edges or [], "a bigint, b bigint")).collect()}
    want = components(values)
    for v in values:
        for u in values:
            same = roots.get(signed[v], signed[v]) == roots.get(signed[u], signed[u])
            assert same == (want[v] == want[u])


def test_thresholds_keep_the_pigeonhole_sum():
    rng = np.random.default_rng(1)
    sample = rng.integers(-(2**63), 2**63 - 1, 500, dtype=np.int64)
    for total in (10, 10**5, 10**10):
        plan = S.allocate(sample, total)
        assert sum(t + 1 for _, t in plan) == S.DISTANCE + 1
        bits = [b for group, _ in plan for b in group]
        assert len(bits) == len(set(bits))


def test_correlated_bits_share_a_group():
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, (400, 64))
    bits[:, 40] = bits[:, 3]
    values = np.array([sum(int(b) << i for i, b in enumerate(r)) for r in bits], np.uint64).view(np.int64)
    assert any({3, 40} <= set(g) for g in S.bit_groups(values, 3))


def test_one_row_of_each_component_stays(spark):
    docs = cases.frame(spark)
    left = S.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    ids = {r.component_id for r in S.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in left.collect()) == sorted(ids)


def test_long_chains_settle(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(1000, 999)], "a bigint, b bigint")
    assert {(r.node, r.root) for r in S.components(edges).collect()} == {(i, 0) for i in range(1, 201)} | {(1000, 999)}


def test_empty_table(spark):
    assert S.near_duplicates(cases.frame(spark, [])).count() == 0
    assert S.drop_near_duplicates(cases.frame(spark, [])).count() == 0
