"""Quality rules as a short-circuit cascade, in DataFrame functions only.

The rules are tried on a small sample first: how often each rejects, and how long it
takes. They then run in the order of rejections per second, and what one rule rejects is
not measured by the rest.
"""

import time

from pyspark.sql import functions as F

from leakwatch.llm import text as T

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
REPEAT_PERCENT = 50
SAMPLE_ROWS = 1000


def let(value, use):
    """use(value) with the value computed once, inside one expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def body():
    return F.coalesce(F.col("text"), F.lit(""))


def n_words():
    return F.size("_words").cast("long")


def word_chars():
    """Code points in words."""
    return F.length(F.array_join("_words", "")).cast("long")


def n_symbols():
    """Characters that are seldom in prose."""
    return (F.length(body()) - F.length(F.regexp_replace(body(), SYMBOLS, ""))).cast("long")


def n_letters():
    """Letters of any script."""
    return F.length(F.regexp_replace(body(), r"[^\p{L}]+", "")).cast("long")


def _lines():
    return F.filter(F.split(body(), "\n"), lambda x: x.rlike(T.WORD))


def n_dup_lines():
    """Lines with a word that equal an earlier line."""
    return let(_lines(), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def mostly_repeated_lines():
    return let(_lines(), lambda x: (F.size(x) - F.size(F.array_distinct(x))) * 2 > F.size(x))


def n_repeat_words():
    """Words inside 3-word windows that the text holds twice or more.

    Windows are sorted by a 64-bit hash of their words' hashes, so equal ones become
    neighbours: n log n for a text of n words, within its row, whatever it repeats.
    """

    def windows(ids):
        return F.transform(
            F.sequence(F.lit(1), F.size(ids) - 2),
            lambda i: F.struct(
                F.xxhash64(
                    F.element_at(ids, i), F.element_at(ids, i + F.lit(1)), F.element_at(ids, i + F.lit(2))
                ).alias("h"),
                i.alias("at"),
            ),
        )

    def repeated(sorted_windows):
        def twin(w, i):
            after = F.get(sorted_windows, i + F.lit(1))["h"].eqNullSafe(w["h"])
            return after | F.get(sorted_windows, i - F.lit(1))["h"].eqNullSafe(w["h"])

        return F.sort_array(F.transform(F.filter(sorted_windows, twin), lambda w: w["at"]))

    # A window covers three words, or fewer where the next one begins inside it.
    def covered(places):
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda a, at: F.struct((a["n"] + F.least(F.lit(3), at - a["last"])).alias("n"), at.alias("last")),
            lambda a: a["n"].cast("long"),
        )

    found = let(
        F.transform("_words", lambda w: F.xxhash64(w)),
        lambda ids: let(F.sort_array(windows(ids)), lambda w: covered(repeated(w))),
    )
    return F.when(F.size("_words") > 2, found).otherwise(F.lit(0).cast("long"))


# Name -> when it rejects, over `text` and `_words`. Each is one expression, so that a
# CASE evaluates it only if no rule before it has rejected. Thresholds are far from prose.
RULES = {
    "few_words": lambda: n_words() < MIN_WORDS,
    "repeated_words": lambda: n_repeat_words() * 100 > n_words() * REPEAT_PERCENT,
    "symbols": lambda: n_symbols() * 10 > n_words(),
    "repeated_lines": mostly_repeated_lines,
    "word_length": lambda: ~word_chars().between(n_words() * 2, n_words() * 14),
    "letters": lambda: n_letters() * 10 < word_chars() * 3,
}
BASE_RULES = ("few_words", "repeated_words")


def with_words(df):
    return df.withColumn("_words", T.word_array(F.col("text")))


def rule_stats(sample, rules=RULES):
    """[(name, share rejected, seconds)] of each rule on a sample with `text` and `_words`.

    The time is what the rule adds to reading the sample; the second of two runs counts,
    so that compiling does not.
    """

    def measured(hit):
        for _ in range(2):
            start = time.perf_counter()
            n, hits = sample.agg(F.count(F.lit(1)), F.count_if(hit)).first()
            took = time.perf_counter() - start
        return took, (hits / n if n else 0.0)

    base, _ = measured(F.size("_words") < 0)
    stats = []
    for name, rejects in rules.items():
        took, share = measured(rejects())
        stats.append((name, share, max(took - base, 1e-3)))
    return stats


def rule_order(docs, rules=RULES, sample_rows=SAMPLE_ROWS):
    """Rule names by rejections per second, highest first, as measured on about `sample_rows` rows."""
    sample = T.staged(with_words(T.few_rows(docs.select("text"), sample_rows)), "quality-sample")
    stats = rule_stats(sample, rules)
    return [name for name, share, took in sorted(stats, key=lambda s: (-s[1] / s[2], s[0]))]


def first_rejection(order, rules=RULES):
    """Name of the first rule in `order` that rejects the row, or null, as one CASE."""
    if not order:
        return F.lit(None).cast("string")
    case = F
    for name in order:
        case = case.when(rules[name](), F.lit(name))
    return case


def measure(docs, rules=RULES, sample_rows=SAMPLE_ROWS):
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    One row per input row. Base counts are taken for every text; `base_failed` is true for
    texts of under 50 words and for those with over half their words in repeated 3-word
    windows; what passes goes through the cascade of the other rules.

    Null and empty texts have zero counts and fail. Null ids and repeated rows are judged
    like any row. Lines are compared as written. Other columns are not read, so their
    names cannot clash. An empty table gives an empty result.

    Scale: one scan, no shuffle, no Python; a row is all the state there is. The order of
    rules changes the time, never the verdict.
    """
    others = {n: r for n, r in rules.items() if n not in BASE_RULES}
    order = rule_order(docs, others, sample_rows)
    counted = with_words(docs.select("doc_id", "text")).withColumns(
        {
            "n_words": n_words(),
            "word_chars": word_chars(),
            "n_symbols": n_symbols(),
            "n_dup_lines": n_dup_lines(),
            "n_repeat_words": n_repeat_words(),
        }
    )
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    judged = counted.withColumn("base_failed", base)
    passes = F.when(F.col("base_failed"), F.lit(False)).otherwise(first_rejection(order, others).isNull())
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", passes.alias("kept")
    )


def keep_good(docs, rules=RULES, sample_rows=SAMPLE_ROWS):
    """The rows of `docs`, columns as they are, that no rule rejects: the whole cascade."""
    order = rule_order(docs, rules, sample_rows)
    inner = docs.select("text", F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("_row"))
    return with_words(inner).where(first_rejection(order, rules).isNull()).select("_row.*")
