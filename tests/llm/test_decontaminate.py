import hashlib
import re

import cases
from leakwatch.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ws(text):
    return WORD.findall(cases.lower(text))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w = ws(text)
        hit, names = set(), set()
        for item_id, item in items:
            v = ws(item)
            k = min(13, len(v))
            spots = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
            for i in range(len(w) - k + 1):
                if k and tuple(w[i : i + k]) in spots:
                    hit |= set(range(i, i + k))
                    names.add("" if item_id is None else str(item_id))
        sha = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def case():
    item = cases.prose(40, 500)
    docs = [(r[0], r[1]) for r in cases.rows()]
    docs += [
        (200, cases.prose(80, 600) + " " + " ".join(item.split()[5:30]) + " " + cases.prose(30, 601)),
        (201, item.upper()),
        (202, item + "\n" + item),
        (203, " ".join(item.split()[:12])),
        (204, "intro " + "Short, item; here!" + " outro " * 30),
        (205, "intro " + "short item" + " outro " * 30),
    ]
    items = [(1, item), (2, "short item here"), (3, item), (None, cases.prose(20, 501)), (10, None), (11, ""), (12, "Ünï日本 wörd"), (13, docs[4][1])]
    return docs, items


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


def test_equals_brute_force(spark):
    docs, items = case()
    want = sorted(brute(docs, items), key=cases.key)
    for block in (10**6, 10):
        got = D.contamination(*frames(spark, docs, items), block_words=block).drop("matches").collect()
        assert sorted(map(tuple, got), key=cases.key) == want


def test_longest_matches_and_places(spark):
    docs, items = case()
    rows = {r.doc_id: r for r in D.contamination(*frames(spark, docs, items)).collect()}
    cut = {(m.item_id, m.start, m.item_start, m.length) for m in rows[200].matches}
    n = len(ws(cases.prose(80, 600)))
    assert ("1", n, 5, 25) in cut and ("3", n, 5, 25) in cut
    assert {(m.start, m.length) for m in rows[202].matches} == {(0, 40), (40, 40)}


def test_shards_do_not_change_matches():
    docs, items = case()
    own = D.Items([i for i, _ in items], [t for _, t in items])
    texts = [t for _, t in docs]
    whole = D.search(texts, own)
    parts = D.search(texts, own, shard_words=50)
    assert whole[0].tolist() == parts[0].tolist()
    assert [sorted(m) for m in whole[1]] == [sorted(m) for m in parts[1]]


def test_affected_documents_go_and_others_stay_as_they_are(spark):
    docs, items = case()
    frame = cases.frame(spark, [(i, t, "en", "s", 1, 2, "c", 0.1, "n") for i, t in docs])
    left = D.drop_contaminated(frame, frames(spark, docs, items)[1])
    bad = [r[-1] for r in brute(docs, items)]
    want = [(i, t, "en", "s", 1, 2, "c", 0.1, "n") for (i, t), b in zip(docs, bad) if not b]
    assert left.columns == frame.columns
    assert sorted(map(tuple, left.collect()), key=cases.key) == sorted(want, key=cases.key)


def test_empty_tables(spark):
    docs, items = case()
    d, b = frames(spark, docs, items)
    assert D.contamination(d.limit(0), b).count() == 0
    assert D.contamination(d, b.limit(0)).where("contaminated or n_hit > 0").count() == 0
