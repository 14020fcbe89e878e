"""Periodic runs of words in whole texts, found by multi-scale minimizers.

A run is a stretch of consecutive words whose smallest period is q (words q apart are equal),
of at least max(6, 4 * q) words, that no neighbouring word extends keeping period q.

Periods up to LAGS are found by comparing the words with themselves at each lag. Longer periods
are searched by scales: for periods in (s, 2 s] every sequence of s / 2 words gets a fingerprint,
and the least fingerprint of every s / 2 neighbouring ones is an anchor. Inside a run of period q
a window and the window q further are equal, so their anchors are q apart and equal: such pairs
are the seeds, which are extended both ways. Sequences that lie in a known run of at most an
eighth of the scale are no anchors, so that equal anchors keep their distance and the number of
pairs is linear in the words; a run of a longer period always holds other sequences, since
else it would have the short period itself.

Stretches found by fingerprints are compared word by word before they count.
"""

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from leakwatch.llm.text import map_texts, word_array

# Periods up to this one are found by direct comparison; a power of two, 16 at least.
LAGS = 16
LEAST_WORDS = 6
LEAST_TURNS = 4
# Words handled by one set of array operations; a longer text is handled alone.
CHUNK_WORDS = 400_000

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
NEVER = np.uint64(2**64 - 1)
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def mixed(values):
    """Scatter 64-bit values."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def streaks(places):
    """First and last of each group of neighbouring numbers in a sorted array."""
    if len(places) == 0:
        return places, places
    cut = np.flatnonzero(np.diff(places) != 1)
    return places[np.concatenate(([0], cut + 1))], places[np.concatenate((cut, [len(places) - 1]))]


def lag_scan(ids, q):
    """(start, length) of all maximal stretches of period q that are long enough."""
    if len(ids) <= q:
        return np.empty((0, 2), np.int64)
    first, last = streaks(np.flatnonzero(ids[:-q] == ids[q:]))
    length = last - first + 1 + q
    keep = length >= max(LEAST_WORDS, LEAST_TURNS * q)
    return np.stack([first[keep], length[keep]], axis=1)


class Fingerprints:
    """Prefix polynomials modulo 2**64 of a sequence of word numbers."""

    def __init__(self, ids):
        n = len(ids)
        steps = np.full(n, BASE, np.uint64)
        back = np.full(n, pow(BASE, -1, 2**64), np.uint64)
        steps[0] = back[0] = 1
        values = mixed(ids.astype(np.uint64) + np.uint64(1))
        self.undo = np.cumprod(back)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * np.cumprod(steps))))
        self.n = n

    def all_of(self, k):
        """Fingerprint of the k words from every place on."""
        return (self.sums[k:] - self.sums[:-k]) * self.undo[: self.n - k + 1]

    def equal(self, a, b, length):
        """Whether the words from a and from b on agree over a length (b > a)."""
        left = self.sums[a + length] - self.sums[a]
        right = self.sums[b + length] - self.sums[b]
        # Both are compared at the place of a: the right one is taken back by b - a steps.
        return left == right * self.undo[b - a]

    def common_after(self, a, b):
        """How many words from a and b on agree."""
        low, high = np.zeros_like(a), self.n - b
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(a, b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def common_before(self, a, b):
        """How many words before a and b agree."""
        low, high = np.zeros_like(a), a.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(a - middle, b - middle, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def anchors(prints, window):
    """Places that hold the leftmost least value of some window."""
    places = np.arange(len(prints))
    step = 1
    while step < window and len(places) > step:
        left, right = places[:-step], places[step:]
        places = np.where(prints[right] < prints[left], right, left)
        step *= 2
    # The leftmost least place never moves back, so equal ones are neighbours.
    places = places[np.concatenate(([True], np.diff(places) != 0))]
    return places[prints[places] != NEVER]


def seeds(prints, places, least, most):
    """Pairs (place, distance) of equal anchors with least < distance <= most."""
    order = np.argsort(prints[places], kind="stable")
    place, value = places[order], prints[places][order]
    found = []
    step = 1
    while step < len(place):
        distance = place[step:] - place[:-step]
        near = (value[step:] == value[:-step]) & (distance <= most)
        if not near.any():
            break
        hit = near & (distance > least)
        found.append(np.stack([place[:-step][hit], distance[hit]], axis=1))
        step += 1
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


def scale_scan(ids, prints, known, scale):
    """(start, length, period) of the stretches with periods in (scale, 2 * scale]."""
    none = np.empty((0, 3), np.int64)
    k = scale // 2
    if len(ids) <= 2 * k:
        return none
    values = mixed(prints.all_of(k))
    inside = known[(known[:, 2] * 4 <= k) & (known[:, 1] >= k)]
    if len(inside):
        depth = np.zeros(len(values) + 1, np.int64)
        np.add.at(depth, inside[:, 0], 1)
        np.add.at(depth, inside[:, 0] + inside[:, 1] - k + 1, -1)
        values[np.cumsum(depth)[:-1] > 0] = NEVER
    pairs = seeds(values, anchors(values, k), scale, 2 * scale)
    if len(pairs) == 0:
        return none
    at, q = pairs[:, 0], pairs[:, 1]
    before, after = prints.common_before(at, at + q), prints.common_after(at, at + q)
    stretch = np.stack([at - before, before + after + q, q], axis=1)
    stretch = np.unique(stretch[stretch[:, 1] >= LEAST_TURNS * q], axis=0)
    out, rescan = [], set()
    for start, length, q in stretch.tolist():
        if np.array_equal(ids[start : start + length - q], ids[start + q : start + length]):
            out.append((start, length, q))
        else:  # two different sequences share a fingerprint
            rescan.add(q)
    for q in rescan:
        out.extend((s, n, q) for s, n in lag_scan(ids, q).tolist())
    return np.array(sorted(set(out)), np.int64).reshape(-1, 3)


def find_runs(ids, longest=None):
    """All runs of a sequence of word numbers as rows (start, length, period), by start, then period.

    `longest` bounds the length of a run, where the caller knows it.
    """
    longest = len(ids) if longest is None else longest
    known = [np.empty((0, 3), np.int64)]
    for q in range(1, min(LAGS, longest // LEAST_TURNS) + 1):
        rows = lag_scan(ids, q)
        known.append(np.column_stack([rows, np.full(len(rows), q, np.int64)]))
    scale = LAGS
    if LEAST_TURNS * (scale + 1) <= longest:
        prints = Fingerprints(ids)
        while LEAST_TURNS * (scale + 1) <= longest:
            known.append(scale_scan(ids, prints, np.concatenate(known), scale))
            scale *= 2
    found = np.concatenate(known)
    # A stretch is found again at multiples of its smallest period: keep the smallest.
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    if len(found) > 1:
        again = (np.diff(found[:, 0]) == 0) & (np.diff(found[:, 1]) == 0)
        found = found[np.concatenate(([True], ~again))]
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
    return found


def after_first_period(runs, n):
    """Which of n words lie in a run after its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth)[:-1] > 0


def chunk_runs(texts):
    """Runs and kept words of several texts (lists of words) by one set of array operations."""
    number = defaultdict(count().__next__)
    ids, bounds = [], [0]
    for i, words in enumerate(texts):
        ids.extend(map(number.__getitem__, words))
        ids.append(-1 - i)  # a word of its own ends each text, so no run goes on
        bounds.append(len(ids))
    found = find_runs(np.array(ids, np.int64), max(map(len, texts)))
    dropped = after_first_period(found, len(ids))
    cuts = np.searchsorted(found[:, 0], bounds)
    for i, words in enumerate(texts):
        rows = found[cuts[i] : cuts[i + 1]] - np.array([bounds[i], 0, 0])
        if len(rows):
            gone = dropped[bounds[i] : bounds[i + 1]].tolist()
            words = [w for w, g in zip(words, gone) if not g]
        yield rows, b" ".join(words)


def texts_to_runs():
    """Function from texts to word counts, runs and collapsed texts."""

    def make(texts):
        sizes, rows, kept = [0] * len(texts), [None] * len(texts), [None] * len(texts)
        waiting = defaultdict(list)  # texts of like length go together, so that the scales suit all

        def flush(batch):
            for (i, _), (runs, text) in zip(batch, chunk_runs([w for _, w in batch])):
                rows[i], kept[i] = runs, text

        held = defaultdict(int)
        for i, text in enumerate(texts):
            words = text.encode("utf-8", "surrogatepass").split() if text else []
            sizes[i] = len(words)
            group = max(len(words), 64).bit_length()
            waiting[group].append((i, words))
            held[group] += len(words) + 1
            if held[group] > CHUNK_WORDS:
                flush(waiting.pop(group))
                held.pop(group)
        for batch in waiting.values():
            flush(batch)
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
        flat = np.concatenate(rows) if rows else np.empty((0, 3), np.int64)
        items = pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(3)], fields=list(RUNS.value_type))
        runs = pa.ListArray.from_arrays(pa.array(offsets), items, type=RUNS)
        return [sizes, runs, pa.array(kept, pa.binary()).cast(pa.string())]

    return make


def periodic_runs(docs):
    """doc_id, n_words, all runs (word number of the start, length, period) of each text, and
    the text with each run collapsed to its first period, words joined by one space.

    One row per document, whatever the order or number of copies. Null and empty texts and texts
    without a run have no runs; null and empty ones collapse to the empty text. A null doc_id is kept. Texts of any length
    are handled whole, at about n log n. Columns other than doc_id and text are not read.
    """
    made = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return map_texts(docs, ["doc_id"], made, texts_to_runs)


def with_planted_runs(docs):
    """doc_id and text, where every tenth id (by crc32) repeats a part of its text to the end.

    With h = crc32(doc_id as text), n words and g = floor(h / 10): where h % 10 = 0 and n > 0 each word i >= a becomes
    word a + (i - a) % p, a = g % n, p = 1 + floor((n - a) / (3 + g % 8)). Other texts, and those of null ids, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = (h % 10 == 0) & (F.trim(F.coalesce("text", F.lit("")), F.lit(" \t\n\x0b\x0c\r")) != "")
    words = docs.select(
        "doc_id",
        F.when(~F.coalesce(planted, F.lit(False)), F.col("text")).alias("plain"),
        F.when(planted, word_array(F.col("text"))).alias("w"),
        F.floor(h / 10).cast("bigint").alias("g"),
    )
    placed = words.withColumn("a", F.expr("g % size(w)")).withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
    turned = F.expr("concat_ws(' ', transform(w, (x, i) -> if(i < a, x, w[int(a + (i - a) % p)])))")
    return placed.select("doc_id", F.when(F.col("w").isNull(), F.col("plain")).otherwise(turned).alias("text"))


def run_digests(found):
    """The longest run of each document (ties: least start, then period), and digests of its runs and collapsed text."""
    line = "concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))"
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as s, -r.period as p)))")
    rows = found.withColumn("_best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("_best.s")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.p")).alias("period"),
        F.expr("1000 * _best.length div -_best.p").alias("exponent_milli"),
        F.sha2(F.expr(line).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
