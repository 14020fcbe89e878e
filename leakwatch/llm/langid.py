"""Language identification by words first, then shorter and shorter character n-grams.

A word the model knows adds its log frequency in each language. An unknown word adds that
of its longest known character n-grams instead.
"""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from leakwatch.llm import text as T

FIT_ROWS = 20_000
MODEL_WORDS = 200_000
MODEL_GRAMS = 50_000
LONGEST_GRAM = 4
STORE_WORDS = 400_000
SMOOTH = 0.5

_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text):
    """Lower-cased runs of letters; empty if the text is null or has no letter at all."""
    words = _LETTERS.findall(text.lower()) if text else []
    return words if any(c.isalpha() for w in words for c in w) else []


def grams(word, n):
    """Character n-grams of a word between blanks; single characters without them."""
    marked = word if n == 1 else f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _counts(docs):
    """lang, kind (0 for words, else the n of n-grams), key, n: combined in tasks, then summed."""

    def run(batches):
        for batch in batches:
            words = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(letter_words(text))
            rows = []
            for lang, found in words.items():
                parts = Counter()
                for word, c in found.items():
                    rows.append((lang, 0, word, c))
                    for n in range(1, LONGEST_GRAM + 1):
                        for g in grams(word, n):
                            parts[n, g] += c
                rows += [(lang, n, g, c) for (n, g), c in parts.items()]
            columns = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.int64()))],
                ["lang", "kind", "key", "n"],
            )

    made = docs.select("lang", "text").mapInArrow(run, "lang string, kind int, key string, n bigint")
    return made.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


class Model:
    """Log frequencies per language of words (kind 0) and n-grams (kind n)."""

    def __init__(self, rows, totals):
        """rows: (lang, kind, key, n); totals: (lang, kind) -> n of all keys, kept or not."""
        self.langs = sorted({lang for lang, _ in totals})
        place = {lang: i for i, lang in enumerate(self.langs)}
        counts = {}
        for lang, kind, key, n in rows:
            counts.setdefault((kind, key), np.zeros(len(self.langs)))[place[lang]] = n
        sizes = Counter(kind for kind, _ in counts)
        self.known = [{} for _ in range(LONGEST_GRAM + 1)]
        for (kind, key), c in counts.items():
            every = np.array([totals.get((lang, kind), 0) for lang in self.langs], float)
            score = np.log((c + SMOOTH) / (every + SMOOTH * (sizes[kind] + 1)))
            self.known[kind][key] = score - score.mean()

    def word(self, word):
        """Score of a word per language, centred: by word, else by its longest known n-grams."""
        found = self.known[0].get(word)
        if found is not None:
            return found
        for n in range(LONGEST_GRAM, 0, -1):
            known = [s for s in map(self.known[n].get, grams(word, n)) if s is not None]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(len(self.langs))


def fit(docs, fit_rows=FIT_ROWS):
    """Model from `text` and `lang` of about `fit_rows` rows with a lang.

    The sample bounds the work. A word is kept if it makes up at least one part in
    MODEL_WORDS of all words, an n-gram one in MODEL_GRAMS of its kind, so no more than
    that many can be kept, and the model's size is bounded too.
    """
    sample = T.few_rows(docs.select("lang", "text").where("lang is not null"), fit_rows)
    counts = T.staged(_counts(sample), "langid-counts")
    totals = {(r.lang, r.kind): r.n for r in counts.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}
    kinds = Counter()
    for (_, kind), n in totals.items():
        kinds[kind] += n
    least = F.coalesce(
        *[
            F.when(F.col("kind") == k, F.lit(max(2.0, n / (MODEL_WORDS if k == 0 else MODEL_GRAMS))))
            for k, n in sorted(kinds.items())
        ],
        F.lit(2.0),
    )
    rows = counts.where(F.col("n") >= least).select("lang", "kind", "key", "n").collect()
    return Model([tuple(r) for r in rows], totals)


class _Store(dict):
    """Words to rows of a score matrix; filled as words come up, emptied when full."""

    def __init__(self, model):
        super().__init__()
        self.model, self.used = model, 0
        self.scores = np.zeros((1 << 16, len(model.langs)), np.float32)

    def __missing__(self, word):
        if self.used == len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[self.used] = self.model.word(word)
        self[word] = self.used
        self.used += 1
        return self.used - 1

    def total(self, words):
        if self.used > STORE_WORDS:
            self.clear()
            self.used = 0
        places = list(map(self.__getitem__, words))
        return self.scores[places].sum(axis=0, dtype=np.float64)


def judge(store, text):
    """(language, posterior under equal priors); ties go to the first name."""
    langs = store.model.langs
    words = letter_words(text)
    if not words or not langs:
        return "und", 0.0
    total = store.total(words)
    weight = np.exp(total - total.max())
    best = int(np.argmax(weight))
    return langs[best], float(weight[best] / weight.sum())


def predict(docs, model, keep=("doc_id",)):
    """Columns `keep`, lang_pred, score (0 to 1).

    Null texts and those without a letter are `und` with score 0, and so is everything if
    the model saw no language. A text whose words have no known part scores all languages
    alike. Repeated rows are judged alike. Only `text` decides.

    Scale: one scan, no shuffle; the model has a size bound and is broadcast.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def setup():
        store = _Store(held.value)

        def make(texts):
            found = [judge(store, t) for t in texts]
            return [f[0] for f in found], [f[1] for f in found]

        return make

    return T.map_texts(docs, list(keep), "lang_pred string, score double", setup)


def identify(docs, modulus=4, part=2, fit_rows=FIT_ROWS):
    """doc_id, held_out, lang_pred, score: learned from rows outside the held-out part.

    Rows with a null id or lang are predicted, not learned from. See `predict` for the rest.
    """
    model = fit(docs.where(T.learnable(F.col("doc_id"), modulus, part)), fit_rows)
    out = predict(docs, model)
    return out.select("doc_id", T.held_out(F.col("doc_id"), modulus, part).alias("held_out"), "lang_pred", "score")
