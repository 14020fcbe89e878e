"""Small documents with everything that can go wrong, and plain Python twins."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row bigint, _words string, score double, n_words string"
GAP = re.compile(r"[^\x20\x09-\x0D]+")


def prose(n, seed, lang="en"):
    rng = random.Random(seed)
    heads = {"en": "th an re on ing er".split(), "de": "sch ein ung ich ver über".split(), "fr": "eau oi que é è ment".split()}[lang]
    words = ["".join(rng.choice(heads) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    for i in range(9, n, 10):
        words[i] += "."
    lines = [" ".join(words[i : i + 25]) for i in range(0, n, 25)]
    return "\n".join(lines)


def rows():
    base = [(i, prose(60 + 7 * i, i, "en de fr".split()[i % 3]), "en de fr".split()[i % 3], f"s{i % 4}") for i in range(24)]
    copy, near = base[3][1], base[5][1]
    edge = [
        (100, None, "en", "s0"),
        (101, "", None, None),
        (102, " \t\n\x0b\x0c\r ", "de", "s1"),
        (None, copy, "en", "s1"),
        (103, copy, "en", None),
        (103, copy, "en", None),
        (103, copy, "en", None),
        (104, near.replace(near.split()[7], "xyz", 1), "fr", "s2"),
        (105, prose(20_000, 77), "en", "s3"),
        (106, "one", "en", "S"),
        (107, "one two", "en", "é"),
        (108, "\x1cone\xa0two three ünïcode 日本語 ①² $$$ ***", "en", "z"),
        (109, "same line here again and again it says nothing new\n" * 30, "en", "s0"),
        (None, None, None, None),
    ]
    return [(i, t, g, s, -1, 5, "clash", 0.5, "x") for i, t, g, s in base + edge]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def words(text):
    return GAP.findall(text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def key(row):
    return tuple((v is None, str(v)) for v in row)
