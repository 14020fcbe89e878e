"""Collocations: frequent phrases of 2 to 4 words, found by Rabin-Karp fingerprints.

Three scans of the texts, each a narrow map before a shuffle of numbers:

1. Prefix polynomials over bytes give every word a fingerprint, prefix polynomials over words
   give one to every word pair. Fingerprints are counted with a pointer to one occurrence.
2. Triples and quadruples are counted the same way, but only where all their pairs are
   frequent: a phrase cannot be more frequent than its parts.
3. Occurrences with a frequent fingerprint are compared with the text and counted by their
   words; only these phrases become strings. Two phrases that share a fingerprint part here.

Which fingerprints are frequent reaches the tasks as one bitmap of a fixed size. A fingerprint
that is not frequent may fall on a set bit, which costs a count that the thresholds then
remove; none is missed.
"""

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from leakwatch.llm.text import staged

LONGEST = 4
LEAST_FOUND = 30
SCORE_SCALE = 2_000_000
# A phrase goes where a longer one has at least this share (percent) of its occurrences.
COVERED_PERCENT = 80
TOP = 2_000
UNKNOWN = "und"

CHUNK_BYTES = 300_000
HELD_KEYS = 400_000
HELD_PHRASES = 150_000
PHRASES = ["lang", "n", "phrase", "found", "key"]
# The bitmap has 2**BITMAP_BITS bits: 8 MB, whatever the size of the input.
BITMAP_BITS = 26
BLOCK_BITS = 32_768  # bits of one block of Spark's bitmap functions

BASE = 0x9E3779B97F4A7C15
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# 0: part of a word, 1: between words, 2: end of a piece.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2


def mixed(values):
    """Scatter 64-bit values."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, kept as far as they were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def __call__(self, n):
        if len(self.up) < n:
            up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 2**64), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_sums(values):
    """Prefix polynomial of a sequence: differences, taken back to place 0, are fingerprints."""
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * POWERS(len(values))[0])))


class Words:
    """The words of several texts: where they stand, their pieces and their fingerprints."""

    def __init__(self, data, text_starts, langs):
        self.data = LOWER[data]
        kind = KIND[data]
        inside = kind == 0
        edge = np.zeros(len(data) + 1, bool)
        edge[text_starts] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last[:-1] &= ~inside[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        # Of texts that start at one place all but the last are empty.
        self.text = np.searchsorted(text_starts, self.start, side="right") - 1
        self.piece = np.cumsum(kind == 2)[self.start] + self.text
        self.langs = langs
        self.lang_keys = mixed(np.array([hash_name(name) for name in langs], np.uint64))
        sums = prefix_sums(BYTE_VALUES[self.data])
        down = POWERS(len(data) + 1)[1]
        self.prints = mixed((sums[self.end] - sums[self.start]) * down[self.start])
        self.sums = prefix_sums(self.prints)

    def __len__(self):
        return len(self.start)

    def keys(self, n):
        """Fingerprint of the n words from every place on, language and length included, and
        whether they lie in one piece."""
        size = max(len(self) - n + 1, 0)
        prints = (self.sums[n:] - self.sums[:-n])[:size] * POWERS(len(self) + 1)[1][:size] if size else self.sums[:0]
        keys = mixed(prints + self.lang_keys[self.text[:size]] + np.uint64(n))
        return keys, self.piece[n - 1 :][:size] == self.piece[:size]

    def pointers(self, texts, places):
        """Half of the text's fingerprint and the number of the word in its text."""
        first = np.searchsorted(self.text, np.arange(len(texts)))
        number = places - first[self.text[places]]
        return (texts[self.text[places]] << np.int64(32)) | number

    def exact_numbers(self):
        """A number per word, equal for equal words only, proved byte by byte."""
        _, index, number = np.unique(self.prints, return_index=True, return_inverse=True)
        size, other = self.end - self.start, index[number]
        if (size == size[other]).all():
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            if (self.data[np.repeat(self.start, size) + within] == self.data[np.repeat(self.start[other], size) + within]).all():
                return number
        exact = defaultdict(count().__next__)
        return np.array([exact[self.phrase(i, 1)] for i in range(len(self))], np.int64)

    def phrase(self, place, n):
        return b" ".join(self.data[self.start[i] : self.end[i]].tobytes() for i in range(place, place + n))

    def phrases(self, places, n):
        """The phrases of n words at the given places as a binary array, words joined by one space."""
        sizes = [self.end[places + i] - self.start[places + i] for i in range(n)]
        ends = np.cumsum(sum(sizes) + n - 1)
        text = np.full(ends[-1] if len(ends) else 0, 0x20, np.uint8)
        at = ends - sum(sizes) - (n - 1)
        for i, size in enumerate(sizes):
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            text[np.repeat(at, size) + within] = self.data[np.repeat(self.start[places + i], size) + within]
            at = at + size + 1
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(text)])


def hash_name(name):
    """A 64-bit number of a language name, the same in every process."""
    value = 0
    for byte in name.encode("utf-8", "surrogatepass") + b"\x00":
        value = ((value ^ byte) * 0x100000001B3 + 0x9E37) % 2**64
    return value


def word_chunks(batch):
    """`Words` of bounded parts of a batch with columns lang and text, with the keys of their texts."""
    langs = [UNKNOWN if v is None else v for v in batch.column(0).to_pylist()]
    texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
    keys = np.asarray(batch.column(2)).astype(np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        upto = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
        upto = min(max(upto, at + 1), len(texts))
        low, high = offsets[at], offsets[upto]
        if high > low:
            yield Words(data[low:high], offsets[at:upto] - low, langs[at:upto]), keys[at:upto]
        at = upto


class Counts:
    """Counts of fingerprints with the least pointer of each, merged while they fit."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, keys, found, pointers):
        self.parts.append((keys, found, pointers))
        self.size += len(keys)

    def merge(self):
        keys, found, pointers = (np.concatenate(c) for c in zip(*self.parts))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        self.parts = [(keys[first], np.add.reduceat(found[order], first), np.minimum.reduceat(pointers[order], first))]
        self.size = len(first)

    def take(self):
        """Merged counts as a record batch; nothing is held after it."""
        self.merge()
        (keys, found, pointers), self.parts, self.size = self.parts[0], [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(found), pa.array(pointers)], ["key", "found", "pointer"]
        )


def is_set(bitmap, keys):
    bit = keys >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def possible(words, n, bitmap):
    """Places of n-word phrases, where all pairs of neighbouring words are set in the bitmap."""
    keys, whole = words.keys(n)
    if bitmap is not None and len(keys):
        pairs, _ = words.keys(2)
        good = is_set(bitmap, pairs)
        for i in range(n - 1):
            whole = whole & good[i : i + len(keys)]
    places = np.flatnonzero(whole)
    return places, keys[places]


def counting(lengths, frequent):
    """mapInArrow function: fingerprints of the phrases of the given lengths with their counts."""

    def run(batches):
        bitmap = None if frequent is None else np.frombuffer(frequent.value, np.uint8)
        counts = Counts()
        for batch in batches:
            for words, texts in word_chunks(batch):
                for n in lengths:
                    places, keys = possible(words, n, bitmap)
                    if len(keys):
                        unique, index, found = np.unique(keys, return_index=True, return_counts=True)
                        counts.add(unique, found, words.pointers(texts, places[index]))
                if counts.size > HELD_KEYS:
                    counts.merge()
                    if counts.size > HELD_KEYS // 2:
                        yield counts.take()
        if counts.size:
            yield counts.take()

    return run


def same_phrases(words, numbers, langs, places, keys, n):
    """First place and count of each phrase among the places, by fingerprint, proved by words."""
    _, index, group, found = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    first = places[index]
    other = first[group]
    same = langs[words.text[places]] == langs[words.text[other]]
    for i in range(n):
        same &= numbers[places + i] == numbers[other + i]
    if not same.all():  # different phrases share a fingerprint: group by the words themselves
        rows = np.stack([langs[words.text[places]]] + [numbers[places + i] for i in range(n)], axis=1)
        _, index, found = np.unique(rows, axis=0, return_index=True, return_counts=True)
        first = places[index]
    return first, found


def materialising(frequent):
    """mapInArrow function: phrases with a frequent fingerprint as text, with exact counts; also
    the number of words (n = 0) of each language."""

    def run(batches):
        bitmap = np.frombuffer(frequent.value, np.uint8)
        held, size = [], 0
        for batch in batches:
            for words, _ in word_chunks(batch):
                if len(words):
                    made = phrase_table(words, bitmap)
                    held.append(made)
                    size += len(made)
                if size > HELD_PHRASES:
                    held = [summed(held)]
                    size = len(held[0])
                    if size > HELD_PHRASES // 2:
                        yield from held[0].to_batches()
                        held, size = [], 0
        if held:
            yield from summed(held).to_batches()

    return run


def phrase_table(words, bitmap):
    """Counts of the frequent phrases of one chunk, and of its words by language."""
    numbers = words.exact_numbers()
    names, langs = np.unique(np.array(words.langs, object), return_inverse=True)
    names = pa.array(names, pa.string())
    total = np.bincount(langs[words.text], minlength=len(names))
    nothing = pa.array([b""] * len(names), pa.binary())
    parts = [pa.Table.from_arrays(
        [names, pa.array(np.zeros(len(names), np.int32)), nothing, pa.array(total), pa.array(np.zeros(len(names), np.int64))], PHRASES
    ).filter(pa.array(total > 0))]
    for n in range(1, LONGEST + 1):
        keys, whole = words.keys(n)
        places = np.flatnonzero(whole & is_set(bitmap, keys)) if len(keys) else np.zeros(0, np.int64)
        if len(places):
            first, found = same_phrases(words, numbers, langs, places, keys[places], n)
            parts.append(pa.Table.from_arrays([
                names.take(pa.array(langs[words.text[first]])), pa.array(np.full(len(first), n, np.int32)),
                words.phrases(first, n), pa.array(found), pa.array(keys[first].view(np.int64)),
            ], PHRASES))
    return pa.concat_tables(parts)


def summed(tables):
    """Equal phrases of several tables added up."""
    groups = pa.concat_tables(tables).group_by(["lang", "n", "phrase", "key"], use_threads=False)
    made = groups.aggregate([("found", "sum")]).rename_columns(["lang", "n", "phrase", "key", "found"]).select(PHRASES)
    return made.combine_chunks()


def frequent_keys(source, lengths, least, bitmap, name):
    """Fingerprints found at least `least` times: key, count, pointer to one occurrence."""
    counted = source.mapInArrow(counting(lengths, bitmap), "key bigint, found bigint, pointer bigint")
    total = counted.groupBy("key").agg(F.sum("found").alias("found"), F.min("pointer").alias("pointer"))
    return staged(total.filter(F.col("found") >= least), name)


def broadcast_bitmap(keys):
    """Bitmap of the leading bits of fingerprints; its size is fixed."""
    bit = F.shiftrightunsigned("key", 64 - BITMAP_BITS)
    blocks = (
        keys.select(F.floor(bit / BLOCK_BITS).cast("int").alias("block"), (bit % BLOCK_BITS).alias("place"))
        .groupBy("block")
        .agg(F.bitmap_construct_agg("place").alias("bits"))
    )
    bitmap = bytearray(2**BITMAP_BITS // 8)
    for row in blocks.toLocalIterator():
        at = row["block"] * BLOCK_BITS // 8
        bitmap[at : at + len(row["bits"])] = row["bits"]
    return keys.sparkSession.sparkContext.broadcast(bytes(bitmap))


def frequent_phrases(docs, least=LEAST_FOUND):
    """lang, n, phrase, found, pointer of all phrases of 1 to 4 words that a language has at least
    `least` times, and one row per language with n = 0 and the number of its words.

    The pointer names one occurrence of the fingerprint: 31 bits of a hash of the text and the number of the word in it.
    """
    source = docs.select(
        F.col("lang").cast("string"), F.col("text").cast("string"),
        F.shiftrightunsigned(F.xxhash64("text"), 33).alias("text_key"),
    )
    short = frequent_keys(source, (1, 2), least, None, "phrase-pairs")
    pairs = broadcast_bitmap(short)
    long = frequent_keys(source, tuple(range(3, LONGEST + 1)), least, pairs, "phrase-longer")
    keys = short.unionByName(long)
    found = source.mapInArrow(
        materialising(broadcast_bitmap(keys)), "lang string, n int, phrase binary, found bigint, key bigint"
    ).withColumn("phrase", F.col("phrase").cast("string"))
    counted = found.groupBy("lang", "n", "phrase", "key").agg(F.sum("found").alias("found"))
    # Written once: words and phrases are read from it, and the texts are not scanned for each.
    counted = staged(counted.filter((F.col("n") == 0) | (F.col("found") >= least)), "phrase-counts")
    words = counted.filter("n = 0").select("lang", "n", "phrase", "found", F.lit(None).cast("bigint").alias("pointer"))
    kept = counted.filter("n > 0").join(keys.select("key", "pointer"), "key")
    return words.unionByName(kept.drop("key"))


def collocations(docs, least=LEAST_FOUND, top=TOP):
    """The best collocations of each language: lang, rank, phrase, a, l, r, n, score, pointer.

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends, and into words at spaces and tabs. a, l, r
    are the occurrences of a phrase and of its parts at the cut with the least score, n all words of the language; the
    score is floor(2 000 000 a / (l + r)). Phrases inside a longer frequent one that has 80 % of their occurrences are
    dropped. Null languages count as `und`, null and empty texts as empty; repeated rows count as often as they stand;
    ties of the score go by a, then by the phrase's bytes. Empty tables and languages without frequent phrases give no
    rows. Columns other than lang and text are not read.
    """
    phrases = staged(frequent_phrases(docs, least), "phrases")
    parts = phrases.filter("n > 0").select("lang", "phrase", "found")
    candidates = phrases.filter("n > 1").withColumn("w", F.split("phrase", " "))
    cuts = candidates.select(
        "lang", "phrase", "n", F.col("found").alias("a"), "pointer", "w",
        F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "pointer", "k",
        F.expr("array_join(slice(w, 1, k), ' ')").alias("left"), F.expr("array_join(slice(w, k + 1, n - k), ' ')").alias("right"),
    )
    scored = (
        cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("found").alias("l")), ["lang", "left"])
        .join(parts.select("lang", F.col("phrase").alias("right"), F.col("found").alias("r")), ["lang", "right"])
        .withColumn("score", F.expr(
            f"cast({SCORE_SCALE} as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    )
    least_cut = scored.groupBy("lang", "phrase", "a", "pointer").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = (
        candidates.filter("n > 2")
        .select("lang", "found", "w", "n", F.explode(F.expr("sequence(2, n - 1)")).alias("size"))
        .select("lang", "found", "w", "size", F.explode(F.expr("sequence(1, n - size + 1)")).alias("at"))
        .select("lang", F.expr("array_join(slice(w, at, size), ' ')").alias("phrase"), "found")
        .groupBy("lang", "phrase").agg(F.max("found").alias("longer"))
    )
    covered = F.expr(f"100 * cast(longer as decimal(20,0)) >= {COVERED_PERCENT} * cast(a as decimal(20,0))")
    left = least_cut.join(inner, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    words = phrases.filter("n = 0").select("lang", F.col("found").alias("n"))
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "pointer"
    )
