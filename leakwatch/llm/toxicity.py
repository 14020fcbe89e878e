"""Toxic passages as maximum-scoring segments.

Tokens carry the log-odds of the toxic class, smoothed by an informative Dirichlet prior.
A linear scan finds all maximal segments, and the best ones of a text together are judged
against the extreme values that chance gives for a text of that length.
"""

import math
import re
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from leakwatch.llm import text as T

FIT_ROWS = 30_000
MODEL_KEYS = 500_000
LEAST_TEXTS = 3
FOLDS = 5
TOGETHER = 8  # best segments of a text that are judged together
# Weight of the prior in texts, standard deviations towards 0, and what is taken off every
# token so that ordinary text drifts downwards; fitted on texts that were not counted.
GRID = list(product((10.0, 30.0), (0.5, 1.0), (1.5, 2.5)))
PREFIXES = (6, 5, 4)
THRESHOLD = 0.3
MOST = 60.0  # surprise beyond which a text is as toxic as can be

_TOKEN = re.compile(r"\w+")


def tokens(text):
    return _TOKEN.findall(text.lower()) if text else []


def _keys(token):
    """The token, and its beginnings, longest first: what stands in for a rare token."""
    return [token] + [f"{token[:n]}~" for n in PREFIXES if len(token) >= n]


def _counts(rows):
    """key, n0, n1: texts of both classes that hold the key, as arrays over the folds.

    Combined in tasks, then summed. A text counts once for a key, however often it repeats it.
    """
    cells = 2 * FOLDS

    def run(batches):
        for batch in batches:
            full = [Counter() for _ in range(cells)]
            for label, fold, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), T.Texts(batch.column(2))):
                full[label * FOLDS + fold].update({k for w in set(tokens(text)) for k in _keys(w)})
            for cell, found in enumerate(full):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(found.keys()), pa.string()),
                        pa.array([cell] * len(found), pa.int32()),
                        pa.array(list(found.values()), pa.int64()),
                    ],
                    ["key", "cell", "n"],
                )

    made = rows.select("toxic", "fold", "text").mapInArrow(run, "key string, cell int, n bigint").groupBy("key")
    summed = made.agg(*[F.sum(F.when(F.col("cell") == c, F.col("n")).otherwise(0)).alias(f"c{c}") for c in range(cells)])
    n0, n1 = (F.array(*[f"c{c}" for c in range(k, k + FOLDS)]) for k in (0, FOLDS))
    return summed.select("key", n0.alias("n0"), n1.alias("n1"))


def log_odds(n0, n1, total0, total1, prior=GRID[0][0], sure=GRID[0][1]):
    """Log-odds of class 1 for keys in n0 and n1 of total0 and total1 texts, numbers or arrays.

    The Dirichlet prior follows the share of all texts that hold the key and weighs `prior`
    texts. The result is moved `sure` standard deviations towards 0, and stops there, so a
    key seen in a few texts only says nothing.
    """
    n0, n1 = np.asarray(n0, float), np.asarray(n1, float)
    total = max(total0 + total1, 1)
    a = prior * np.clip(n0 + n1, 0.5, total - 0.5) / total
    odds = np.log((n1 + a) / (total1 + prior - n1 - a)) - np.log((n0 + a) / (total0 + prior - n0 - a))
    spread = np.sqrt(1 / (n1 + a) + 1 / (n0 + a))
    return np.copysign(np.maximum(np.abs(odds) - sure * spread, 0.0), odds)


def segments(scores):
    """All maximal scoring segments (start, end, score) of a sequence, in one linear scan.

    Each kept segment remembers the running sum before and after it. A new one either
    stands alone or swallows the kept ones back to the last with a lower start.
    """
    kept = []
    places = np.flatnonzero(scores > 0)
    if not len(places):
        return kept
    running = np.cumsum(scores)
    for i in places.tolist():
        start, low, high = i, float(running[i] - scores[i]), float(running[i])
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= high:
                kept.append((start, i + 1, low, high, j))
                break
            start, low = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, high - low) for a, b, low, high, _ in kept]


def strongest(found):
    """Scores of the best TOGETHER segments, falling, zeros where there are fewer."""
    top = sorted((s for _, _, s in found), reverse=True)[:TOGETHER]
    return top + [0.0] * (TOGETHER - len(top))


def surprise(best, n, rate, spread):
    """-ln of the chance that ordinary texts of n tokens have segments as good as `best`.

    best: (texts, TOGETHER) falling scores. The best segment follows an extreme-value law: it
    exceeds x with chance 1 - exp(-spread * n * exp(-rate * x)). The sum t of the r best,
    less their expected logarithm, exceeds t with about exp(-t) t^(r-1) / (r! (r-1)!); each
    further segment halves the weight of its alternative. The most surprising r counts; a text
    without segments is no surprise.
    """
    best, n = np.atleast_2d(np.asarray(best, float)), np.atleast_1d(np.asarray(n, float))
    over = rate * best - np.log(np.maximum(spread * np.maximum(n, 1), 1e-300))[:, None]
    expected = np.exp(-np.clip(over[:, 0], -600, 600))
    with np.errstate(divide="ignore"):
        found = np.where(expected > 1e-12, -np.log(-np.expm1(-expected)), over[:, 0])
    total = np.cumsum(over, axis=1)
    for r in range(2, best.shape[1] + 1):
        t = np.maximum(total[:, r - 1], r)
        sums = t - (r - 1) * np.log(t) + math.lgamma(r + 1) + math.lgamma(r) - (r - 1) * math.log(2)
        counts = (best[:, r - 1] > 0) & (over[:, r - 1] > 0) & (total[:, r - 1] > r)
        found = np.where(counts, np.maximum(found, sums), found)
    return np.where(best[:, 0] > 0, np.maximum(found, 0.0), 0.0)


class Model:
    """Token scores, the extreme-value law of chance, and its link to the label."""

    def __init__(self, scores, drift=GRID[0][2], rate=1.0, spread=1.0, slope=1.0, base=0.0):
        self.scores, self.drift = scores, drift
        self.rate, self.spread, self.slope, self.base = rate, spread, slope, base
        self.store = {}

    def of(self, words):
        store = self.store
        if len(store) > 400_000:
            store.clear()
        out = np.empty(len(words))
        for i, w in enumerate(words):
            s = store.get(w)
            if s is None:
                s = store[w] = next((x for x in map(self.scores.get, _keys(w)) if x is not None), 0.0) - self.drift
            out[i] = s
        return out

    def segments(self, text):
        words = tokens(text)
        return len(words), segments(self.of(words)) if words else []

    def significant(self, n, found):
        """The segments of which chance would give fewer than one in a text of n tokens."""
        least = math.log(max(self.spread * max(n, 1), 1e-300)) / self.rate
        return [x for x in found if x[2] > least]

    def link(self, best, n):
        x = surprise(best, n, self.rate, self.spread)
        return 1 / (1 + np.exp(-np.clip(self.base + self.slope * np.minimum(x, MOST), -60, 60)))


def _law(best, n):
    """(rate, spread) of the extreme-value law from best scores and lengths of ordinary texts.

    The rate is the exponential slope of the scores above their upper quartile; the spread
    then makes the expected number of exceedances right there.
    """
    best, n = np.asarray(best, float), np.asarray(n, float)
    if not len(best):
        return 1.0, 1.0
    cut = float(np.quantile(best, 0.75))
    over = best[best > cut] - cut
    rate = 1 / max(float(over.mean()), 0.2) if len(over) else 5.0
    share = max(len(over), 1) / len(best)
    return min(rate, 5.0), -math.log1p(-min(share, 0.99)) * math.exp(min(rate, 5.0) * cut) / max(n.mean(), 1)


def _logistic(x, y, steps=50):
    """(slope, base) of a one-variable logistic fit; a weak pull to 0 keeps it finite."""
    w = np.array([0.0, 0.0])
    grid = np.stack([np.minimum(x, MOST), np.ones(len(x))], axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(grid @ w, -30, 30)))
        hessian = (grid * (p * (1 - p))[:, None]).T @ grid + np.eye(2) * 0.1
        step = np.linalg.solve(hessian, grid.T @ (y - p) - 0.1 * w)
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 0.0)), float(w[1])


def _trials(rows, keys, n0, n1, texts):
    """toxic, n, best: of each row, its best segments under every member of GRID.

    Its own fold is taken off the counts first, so no text is judged by what it taught.
    """
    held = rows.sparkSession.sparkContext.broadcast((keys, n0, n1, texts))

    def run(batches):
        keys, n0, n1, texts = held.value
        number = {k: i for i, k in enumerate(keys)}
        all0, all1 = n0.sum(axis=1), n1.sum(axis=1)
        totals = texts.sum(axis=1)
        for batch in batches:
            sizes, best = [], []
            for fold, text in zip(batch.column(1).to_pylist(), T.Texts(batch.column(2))):
                words = tokens(text)
                place = np.array([next((number[k] for k in _keys(w) if k in number), -1) for w in words], np.int64)
                seen, at = np.unique(place, return_inverse=True)
                known, rest = seen >= 0, totals - texts[:, fold]
                c0, c1 = all0[seen] - n0[seen, fold], all1[seen] - n1[seen, fold]
                row = []
                for prior, sure, drift in GRID:
                    odds = np.where(known, log_odds(c0, c1, *rest, prior, sure), 0.0) - drift
                    row += strongest(segments(odds[at]) if words else [])
                sizes.append(len(words))
                best.append(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(best, pa.list_(pa.float32()))], ["toxic", "n", "best"]
            )

    return rows.select("toxic", "fold", "text").mapInArrow(run, "toxic int, n bigint, best array<float>")


def fit(labelled, fit_rows=FIT_ROWS):
    """Model from rows (text, toxic 0/1): about `fit_rows` of them, each text once.

    Equal texts count as one, toxic if one of them is. Texts are dealt to folds by their
    digest; the counts of the other folds judge a text, and prior, certainty and drift are the
    member of GRID whose extreme-value law and link give the labels the greatest likelihood. The
    scores then come from the counts of all folds. A key needs LEAST_TEXTS texts; the
    MODEL_KEYS keys that deviate most from independence of the label are kept, which bounds the model.
    """
    rows = T.few_rows(labelled.select("text", "toxic"), fit_rows)
    rows = rows.withColumn("digest", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    drawn = T.staged(rows.withColumn("fold", F.pmod("digest", F.lit(FOLDS)).cast("int")), "toxicity-sample")
    once = drawn.groupBy("digest").agg(F.max("toxic").alias("toxic"), F.min("row").alias("row"))
    sample = T.staged(drawn.drop("toxic", "digest").join(F.broadcast(once), "row"), "toxicity-texts")
    texts = np.zeros((2, FOLDS), np.int64)
    for r in sample.groupBy("toxic", "fold").count().collect():
        texts[r.toxic, r.fold] = r["count"]
    total0, total1 = texts.sum(axis=1).tolist()
    if not total0 or not total1:
        return Model({}, slope=0.0, base=-5.0)
    total = [F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y) for c in ("n0", "n1")]
    due = (total[0] + total[1]) * F.lit(total1 / (total0 + total1))
    counted = _counts(sample).where(total[0] + total[1] >= LEAST_TEXTS)
    told = F.pow(total[1] - due, F.lit(2)) / due
    kept = counted.orderBy(told.desc(), "key").limit(MODEL_KEYS).toArrow()
    keys = kept.column("key").to_pylist()
    n0, n1 = (
        kept.column(c).combine_chunks().values.to_numpy().astype(np.int32).reshape(-1, FOLDS) if keys else np.zeros((0, FOLDS), np.int32)
        for c in ("n0", "n1")
    )
    made = _trials(sample, keys, n0, n1, texts).toArrow()
    y, n = made.column("toxic").to_numpy().astype(float), made.column("n").to_numpy()
    trials = np.array(made.column("best").combine_chunks().values.to_numpy()).reshape(len(y), len(GRID), TOGETHER)
    found = None
    for i, (prior, sure, drift) in enumerate(GRID):
        best = trials[:, i]
        ordinary = (y == 0) & (n > 0)
        rate, spread = _law(best[ordinary, 0], n[ordinary])
        model = Model({}, drift, rate, spread)
        model.slope, model.base = _logistic(surprise(best, n, rate, spread), y)
        chance = np.clip(model.link(best, n), 1e-9, 1 - 1e-9)
        loss = -float((y * np.log(chance) + (1 - y) * np.log(1 - chance)).mean())
        if found is None or loss < found[0]:
            found = (loss, model, prior, sure)
    _, model, prior, sure = found
    model.scores = dict(zip(keys, log_odds(n0.sum(axis=1), n1.sum(axis=1), total0, total1, prior, sure).tolist()))
    return model


def score(docs, model, keep=("doc_id",)):
    """Columns `keep`, score (0 to 1), passages: array of (start, end, score) in tokens.

    The score is the chance of label 1 given how surprising the best segments together are for
    the text's length. Passages are all significant segments, in order. Null and empty texts
    have none and get a score too; a text is judged whole, however long it is.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def setup():
        def make(texts):
            own = held.value
            sizes, best, passages = [], [], []
            for text in texts:
                n, found = own.segments(text)
                sizes.append(n)
                best.append(strongest(found))
                passages.append([dict(start=a, end=b, score=s) for a, b, s in own.significant(n, found)])
            chance = own.link(np.array(best).reshape(-1, TOGETHER), np.array(sizes)) if sizes else []
            return chance, passages

        return make

    return T.map_texts(docs, list(keep), "score double, passages array<struct<start:int,end:int,score:double>>", setup)


def judge(docs, labels, modulus=4, part=2, fit_rows=FIT_ROWS, threshold=THRESHOLD):
    """doc_id, held_out, score, predicted, passages for every row of `docs`.

    Learns from `labels.toxic` of rows outside the held-out part. A doc_id with several
    labels counts as toxic if one of them says so; null ids and labels teach nothing.
    Without both classes every score is low and equal. Repeated rows are judged alike.

    Scale: about `fit_rows` labelled ids are drawn from `labels` alone and broadcast, so no
    text is shuffled to learn; scoring is one scan without a shuffle, with a broadcast
    model of bounded size.
    """
    known = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & T.learnable(F.col("doc_id"), modulus, part))
    drawn = T.staged(T.few_rows(T.staged(known, "toxicity-known"), fit_rows), "toxicity-drawn")
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    model = fit(rows, fit_rows)
    return score(docs, model).select(
        "doc_id",
        T.held_out(F.col("doc_id"), modulus, part).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "passages",
    )
