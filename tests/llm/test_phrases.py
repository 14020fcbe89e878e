import random
import re
from collections import Counter

import numpy as np

from leakwatch.llm import phrases
from tests.llm import cases

SCHEMA = "doc_id bigint, text string, lang string, phrase string, n bigint, found string"


def brute(rows, least, top=2000):
    """Contract of the query from plain counts."""
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", cases.lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    f[lang, tuple(w[i : i + n])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, w), a in cand.items():
        inside = any(
            100 * b >= 80 * a and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
            for (other, v), b in cand.items() if other == lang and len(v) > len(w)
        )
        if not inside:
            cuts = []
            for k in range(1, len(w)):
                left, right = f[lang, w[:k]], f[lang, w[k:]]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(rows)


def sentences(seed, n, lang):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["é", "日本", "A", "a"]
    fixed = ["New York City Hall", "new york city", "as a matter of", "über den\tWolken"]
    rows = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randint(0, 30))]
        rows.append((None, rng.choice(["  ", " ", "\t"]).join(p + rng.choice(["", "", ".", ",", "\n", "\r\n;"]) for p in parts), lang, "x", 5, "y"))
    return rows


def collect(spark, rows, **settings):
    found = phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), **settings)
    return sorted(tuple(r)[:8] for r in found.collect())


def test_equals_brute_force(spark):
    rows = sentences(1, 60, "en") + sentences(2, 40, None) + sentences(3, 5, "und")
    rows += [(1, None, "en", None, None, None), (2, "", "fr", None, None, None), (3, " \t ", None, None, None, None)]
    rows += [rows[0]] * 7 + [(4, "same words here\n" * 3000, "de", None, None, None)]
    pairs = [(t, g) for _, t, g, *_ in rows]
    got = collect(spark, rows, least=3)
    assert got == brute(pairs, 3) and len(got) > 30
    assert collect(spark, rows, least=3, top=5) == brute(pairs, 3, 5)


def test_odd_documents(spark):
    data = cases.rows()
    got = sorted(tuple(r)[:8] for r in phrases.collocations(cases.frame(spark)).collect())
    assert got == brute([(t, g) for _, t, g, *_ in data], 30)


def test_phrases_that_share_a_fingerprint_are_told_apart(spark, monkeypatch):
    # Words of equal length collide, in each task as well as between tasks.
    monkeypatch.setattr(phrases, "BYTE_VALUES", np.ones(256, np.uint64))
    words = phrases.Words(np.frombuffer(b"ab cd ab cd ef", np.uint8), np.array([0]), ["en"])
    assert len(set(words.prints.tolist())) == 1
    numbers = words.exact_numbers()
    assert numbers[0] == numbers[2] != numbers[1]
    keys, whole = words.keys(2)
    first, found = phrases.same_phrases(words, numbers, np.array([0]), np.flatnonzero(whole), keys, 2)
    assert {words.phrase(p, 2): n for p, n in zip(first.tolist(), found.tolist())} == {b"ab cd": 2, b"cd ab": 1, b"cd ef": 1}
    assert words.phrases(first, 2).to_pylist() == [words.phrase(p, 2) for p in first.tolist()]
    assert words.phrases(first[:0], 2).to_pylist() == []


def test_small_chunks_and_held_limits(spark, monkeypatch):
    rows = sentences(4, 50, "en")
    batch = spark.createDataFrame(rows, SCHEMA).selectExpr("lang", "text", "1L AS k").toArrow().to_batches()[0]

    def total(size):
        monkeypatch.setattr(phrases, "CHUNK_BYTES", size)
        monkeypatch.setattr(phrases, "HELD_KEYS", size)
        counts = Counter()
        for part in phrases.counting((1, 2), None)([batch]):
            for row in part.to_pylist():
                counts[row["key"]] += row["found"]
        return counts

    assert total(64) == total(1_000_000)


def test_empty_table_and_no_frequent_phrase(spark):
    assert phrases.collocations(cases.frame(spark, [])).count() == 0
    assert collect(spark, [(1, "one two three", "en", None, None, None)]) == []
