"""Benchmark decontamination with suffix arrays over the training documents.

Documents are cut into shards. Each shard sorts the suffixes of its word sequence, every
suffix of every benchmark item is looked up in it by binary search, and hits are grown
to the longest verbatim matches, with their places.
"""

import numpy as np
from pyspark.sql import functions as F

from leakwatch.llm import text as T

WINDOW = 13
BLOCK_WORDS = 4_000_000
SHARD_WORDS = 1_000_000

# Digits, A-Z lower-cased, a-z and all bytes of characters beyond ASCII make words.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text):
    return text.encode("utf-8", "surrogatepass").translate(_WORDS).split() if text else []


class Items:
    """A block of benchmark items as word numbers, and its windows, each distinct one once."""

    def __init__(self, ids, texts, window=WINDOW):
        self.window = window
        self.ids = list(ids)
        self.number = {}
        parts, starts, sizes = [], [], []
        at = 0
        for text in texts:
            ws = words_of(text)
            parts.append(np.fromiter((self.number.setdefault(w, len(self.number) + 1) for w in ws), np.uint32, len(ws)))
            starts.append(at)
            sizes.append(len(ws))
            at += len(ws)
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        self.starts = np.array(starts, np.int64)
        self.sizes = np.array(sizes, np.int64)
        # A suffix counts if a window begins there: `window` words, or the whole of a shorter item.
        reach = np.minimum(self.sizes, window)
        counts = np.where(self.sizes > 0, self.sizes - reach + 1, 0)
        self.owner = np.repeat(np.arange(len(sizes)), counts)
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        self.at = self.starts[self.owner] + offset
        self.reach = reach[self.owner]
        self.ends = self.starts + self.sizes
        keys = suffix_keys(self.words, self.at, self.at + self.reach, window)
        _, first, self.kind = np.unique(keys, return_index=True, return_inverse=True)
        self.low = keys[first]
        self.high = suffix_keys(self.words, self.at[first], self.at[first] + self.reach[first], window, fill=0xFFFFFFFF)
        self.kind_reach = self.reach[first]
        order = np.argsort(self.kind, kind="stable")
        self.members = order
        self.member_start = np.searchsorted(self.kind[order], np.arange(len(first) + 1))
        self.shortest = int(self.reach.min()) if len(self.reach) else window
        self.opens = np.zeros(len(self.number) + 1, bool)
        self.opens[self.words[self.at]] = True


def suffix_keys(words, at, ends, depth, fill=0):
    """The first `depth` words from each place as one byte string; `fill` beyond its end."""
    grid = at[:, None] + np.arange(depth)[None, :]
    inside = grid < ends[:, None]
    taken = np.where(inside, words[np.minimum(grid, max(len(words) - 1, 0))] if len(words) else 0, fill)
    return np.ascontiguousarray(taken.astype(">u4")).view(f"S{4 * depth}").ravel()


def find_matches(words, items):
    """Occurrences of item windows in one shard.

    `words`: numbers of the shard's words, 0 where a word is in no item or a document
    ends. The suffix array holds the places from which a run of known words is long enough
    for the shortest window, sorted by their first `window` words. Returns shard places and
    window kinds, one pair per occurrence.
    """
    n = len(words)
    stops = np.flatnonzero(words == 0)
    limit = np.append(stops, n)
    places = np.flatnonzero(items.opens[words] & (words > 0))
    run_end = limit[np.searchsorted(limit, places)]
    fits = run_end - places >= items.shortest
    places, run_end = places[fits], run_end[fits]
    if not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = suffix_keys(words, places, run_end, items.window)
    array = np.argsort(keys, kind="stable")
    sorted_keys = keys[array]
    low = np.searchsorted(sorted_keys, items.low, "left")
    high = np.searchsorted(sorted_keys, items.high, "right")
    count = high - low
    kinds = np.repeat(np.arange(len(count)), count)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return places[array[low[kinds] + within]], kinds


def longest_matches(words, items, places, kinds):
    """(place, item suffix, length) of each occurrence that cannot be grown to the left.

    Each is grown to the right while the words agree, up to the end of the item.
    """
    counts = (items.member_start[1:] - items.member_start[:-1])[kinds]
    which = items.members[
        np.repeat(items.member_start[kinds], counts)
        + np.arange(counts.sum())
        - np.repeat(np.cumsum(counts) - counts, counts)
    ]
    place = np.repeat(places, counts)
    at = items.at[which]
    first = items.starts[items.owner[which]]
    before = np.where(place > 0, words[np.maximum(place - 1, 0)], 0)
    grows = (at > first) & (before > 0) & (items.words[np.maximum(at - 1, 0)] == before)
    place, at, which = place[~grows], at[~grows], which[~grows]
    length = items.reach[which].copy()
    room = np.minimum(items.ends[items.owner[which]] - at, len(words) - place)
    live = np.flatnonzero(length < room)
    while len(live):
        same = items.words[at[live] + length[live]] == words[place[live] + length[live]]
        live = live[same]
        length[live] += 1
        live = live[length[live] < room[live]]
    return place, which, length


def _shards(texts, number, size):
    """Lists of consecutive documents as one number array each: (first row, starts, words)."""
    parts, starts, at, begin = [], [], 0, 0
    for i, text in enumerate(texts):
        ws = words_of(text)
        found = np.fromiter((number.get(w, 0) for w in ws), np.uint32, len(ws))
        starts.append(at)
        parts += [found, np.zeros(1, np.uint32)]
        at += len(ws) + 1
        if at >= size:
            yield begin, np.array(starts + [at]), np.concatenate(parts)
            parts, starts, at, begin = [], [], 0, i + 1
    if starts:
        yield begin, np.array(starts + [at]), np.concatenate(parts)


def search(texts, items, shard_words=SHARD_WORDS):
    """(words per text, matches per text): a match is (item, start, item start, length)."""
    n_words, found = np.zeros(len(texts), np.int64), [[] for _ in texts]
    for begin, starts, words in _shards(texts, items.number, shard_words):
        n_words[begin : begin + len(starts) - 1] = np.diff(starts) - 1
        place, which, length = longest_matches(words, items, *find_matches(words, items))
        doc = np.searchsorted(starts, place, "right") - 1
        local = place - starts[doc]
        owner = items.owner[which]
        item_at = items.at[which] - items.starts[owner]
        for d, *match in zip(*(x.tolist() for x in (doc, owner, local, item_at, length))):
            found[begin + d].append(match)
    return n_words, found


def item_blocks(benchmark, window=WINDOW, block_words=BLOCK_WORDS):
    """The benchmark in blocks of bounded size, in no stated order.

    Rows come to the driver one partition at a time, and a block is closed at
    `block_words` words, so the driver and a broadcast hold one block, however long the
    benchmark. Items without words (null texts too) match nothing.
    """
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1]) // 2 if row[1] else 0
        if size >= block_words:
            yield Items(ids, texts, window)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts, window)


def _item_name(items, i):
    return "" if items.ids[i] is None else str(items.ids[i])


def contamination(docs, benchmark, keep=("doc_id",), window=WINDOW, block_words=BLOCK_WORDS):
    """Columns `keep`, n_words, n_hit, n_items, items_sha256, contaminated, matches.

    One row per input row. A word inside an occurrence of a benchmark window (13 words, or
    the whole of a shorter item) is hit; a document is contaminated if it has a hit and at
    least one word in twenty is hit. `items_sha256` is over the distinct item ids with an
    occurrence, sorted as text and joined by commas (a null id counts as an empty one).
    `matches` lists the longest verbatim matches: item_id, start, item_start, length, in
    words; each has a window at least and cannot be grown either way.

    Null and empty texts have no words. Repeated rows are judged alike. Items with equal
    text are all named. An empty benchmark hits nothing. Columns outside `keep` are not
    read, and those in it must not have the names above.

    Scale: no shuffle; shards are cut inside Arrow batches, so memory follows the batch.
    The benchmark is broadcast in blocks of at most `block_words` words. With more than one
    block, passes over the documents are chained, and matches are carried in their rows.
    """
    ddl = (
        "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
        "matches array<struct<item_id:string,start:int,item_start:int,length:int>>"
    )
    context = docs.sparkSession.sparkContext
    blocks = item_blocks(benchmark, window, block_words)
    items = next(blocks, None) or Items([], [], window)
    frame, carried = docs, []
    while True:
        following = next(blocks, None)
        held = context.broadcast(items)
        if following is None:
            break
        name = f"_found{len(carried)}"
        frame = T.staged(
            T.map_texts(frame, [*docs.columns, *carried], f"{name} {ddl.rpartition('matches ')[2]}", _finder(held)),
            "decontaminate-block",
        )
        carried.append(name)
        items = following
    if carried:
        frame = frame.withColumn("_before", F.flatten(F.array(*carried)))
        carried = ["_before"]
    last = T.map_texts(frame, [*keep, *carried], "_n bigint, _found " + ddl.rpartition("matches ")[2], _finder(held, True))
    return _counted(last, list(keep), carried)


def _finder(held, counted=False):
    def setup():
        def make(texts):
            items = held.value
            n_words, found = search(texts, items)
            named = [
                [dict(item_id=_item_name(items, o), start=s, item_start=i, length=n) for o, s, i, n in f] for f in found
            ]
            return (n_words, named) if counted else (named,)

        return make

    return setup


def _counted(found, keep, carried):
    """Counts from the matches of a row; overlapping spans count once."""
    every = F.concat("_before", "_found") if carried else F.col("_found")
    spans = F.sort_array(F.transform("matches", lambda m: F.struct(m["start"].alias("a"), (m["start"] + m["length"]).alias("b"))))
    hit = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, m: F.struct(
            (s["n"] + F.greatest(F.lit(0), m["b"] - F.greatest(m["a"], s["end"]))).alias("n"),
            F.greatest(m["b"], s["end"]).alias("end"),
        ),
        lambda s: s["n"].cast("long"),
    )
    ids = F.sort_array(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    out = found.withColumn("matches", every).withColumns({"n_hit": hit, "_ids": ids})
    return out.select(
        *keep,
        F.col("_n").alias("n_words"),
        "n_hit",
        F.size("_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("_ids", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("_n"))).alias("contaminated"),
        "matches",
    )


def drop_contaminated(docs, benchmark, **options):
    """The rows of `docs` that are not contaminated, columns as they are.

    Rows pass through the search with all their columns, so nothing is joined back.
    """
    names = docs.columns
    inner = docs.select(*[F.col(f"`{n}`").alias(f"_c{i}") for i, n in enumerate(names)], F.col("text").alias("text"))
    judged = contamination(inner, benchmark, keep=[f"_c{i}" for i in range(len(names))], **options)
    return judged.where(~F.col("contaminated")).select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)])
