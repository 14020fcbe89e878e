"""SimHash near-duplicates by the general pigeonhole principle.

Fingerprint bits are grouped into partitions, correlated bits together. Every partition
gets a threshold of its own, found by dynamic programming on estimated candidate counts:
if the thresholds plus one add up to the allowed distance plus one, two fingerprints
within that distance agree up to the threshold in at least one partition. Buckets of
those partitions are probed, and each candidate is verified on all 64 bits.
"""

import math
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import functions as F

from leakwatch.llm import text as T

BITS = 64
DISTANCE = 2
SHINGLE = 3
SEED = 42
SAMPLE = 2000
BUCKET_ROWS = 64
HASH_ROWS = 1 << 16


def shingle_hashes(words, size=SHINGLE, seed=SEED):
    """XXH64 of the joined shingles; a shorter text is one shingle, a text without words none."""
    if not words:
        return []
    if len(words) < size:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(size))))
    digest = xxhash.xxh64_intdigest
    return [digest(g, seed) for g in grams]


def _ones(hashes):
    """How often each bit is set, highest first."""
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HASH_ROWS):
        part = np.array(hashes[at : at + HASH_ROWS], dtype=">u8")
        total += np.unpackbits(part.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return total


def fingerprints(texts, size=SHINGLE, seed=SEED):
    """Signed 64-bit fingerprints; a bit is 1 if set in over half the hashes. No word: 0."""
    ones, counts = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    held, owners = [], []

    def flush():
        if held:
            bits = np.unpackbits(np.array(held, dtype=">u8").view(np.uint8)).reshape(-1, BITS)
            starts = np.cumsum([0] + [n for _, n in owners[:-1]])
            ones[[i for i, _ in owners]] = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
            held.clear()
            owners.clear()

    for i, text in enumerate(texts):
        hashes = shingle_hashes(T.lower_words(text), size, seed)
        counts[i] = len(hashes)
        if len(hashes) >= HASH_ROWS:
            ones[i] = _ones(hashes)
        elif hashes:
            held += hashes
            owners.append((i, len(hashes)))
            if len(held) >= HASH_ROWS:
                flush()
    flush()
    packed = np.packbits(ones * 2 > counts[:, None], axis=1)
    return np.ascontiguousarray(packed).view(">u8").ravel().astype(np.uint64).view(np.int64)


def with_fingerprint(docs, keep, size=SHINGLE, seed=SEED):
    """Columns `keep` and `_fp`, the signed 64-bit fingerprint of `text`."""
    return T.map_texts(docs, keep, "_fp bigint", lambda: lambda texts: (fingerprints(texts, size, seed),))


def bit_groups(sample, parts):
    """Bit numbers (0 lowest) in `parts` groups of about equal size, correlated bits together."""
    bits = ((sample.view(np.uint64)[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    spread = bits - bits.mean(axis=0) if len(bits) else np.zeros((1, BITS))
    scale = np.sqrt((spread**2).sum(axis=0)) + 1e-9
    alike = np.abs(spread.T @ spread) / np.outer(scale, scale)
    left, groups = set(range(BITS)), []
    for k in range(parts):
        size = math.ceil(len(left) / (parts - k))
        first = min(left, key=lambda b: (-alike[b, sorted(left)].sum(), b))
        group = [first]
        left.discard(first)
        while len(group) < size:
            best = min(left, key=lambda b: (-alike[b, group].sum(), b))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def _part_cost(sample, group, threshold, total):
    """Estimated work of one partition at one threshold: bucket rows plus candidates."""
    if threshold < 0:
        return 0.0
    width = len(group)
    mask = np.uint64(sum(1 << b for b in group))
    part = sample.view(np.uint64) & mask
    near = 0
    for at in range(0, len(part), 256):
        near += int((np.bitwise_count(part[at : at + 256, None] ^ part[None, :]) <= threshold).sum())
    pairs = max(len(part) * (len(part) - 1), 1)
    seen = max(near - len(part), 0) / pairs
    even = sum(math.comb(width, k) for k in range(threshold + 1)) / 2.0**width
    rows = math.comb(width, threshold) * total
    return rows + max(seen, even) * total * total / 2


def allocate(sample, total, distance=DISTANCE):
    """[(bits of a partition, threshold)] of least estimated cost.

    For each number of partitions, best[k] is the least cost of the partitions so far
    with their (threshold + 1) adding up to k; -1 leaves a partition out.
    """
    choices = []
    for parts in range(1, distance + 2):
        groups = bit_groups(sample, parts)
        best = {0: (0.0, ())}
        for group in groups:
            step = {}
            for used, (cost, picks) in best.items():
                for threshold in range(-1, distance - used + 1):
                    k = used + threshold + 1
                    price = cost + _part_cost(sample, group, threshold, total)
                    if k not in step or price < step[k][0]:
                        step[k] = (price, (*picks, threshold))
            best = step
        cost, picks = best[distance + 1]
        choices.append((cost, [(g, t) for g, t in zip(groups, picks) if t >= 0]))
    return min(choices, key=lambda c: c[0])[1]


def _signed(mask):
    return mask - (1 << 64) if mask >> 63 else mask


def buckets(fp, plan):
    """Array of (mask number, masked value): fingerprints within a partition's threshold share one.

    With a threshold of t every choice of t bits of the partition is left out once.
    """
    masks = [
        sum(1 << b for b in group if b not in out) for group, t in plan for out in combinations(group, t)
    ]
    # A constant array: thousands of masks are one value, not thousands of expressions.
    constant = F.array(*[F.lit(_signed(m)).cast("long") for m in masks])
    return F.transform(
        constant, lambda m, i: F.struct(i.alias("mask"), fp.bitwiseAND(m).alias("value"))
    )


def _apart(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def links(fps, distance=DISTANCE, bucket_rows=BUCKET_ROWS):
    """Edges (a > b) that join the same fingerprints as all pairs within `distance` (at most 2).

    fps: distinct `_fp`. Buckets of up to `bucket_rows` fingerprints are verified inside a
    row, and only true links leave it. Larger buckets take an exact way without pairs:
    two fingerprints are within 2 bits if and only if one value is within 1 bit of both,
    so each names its 65 nearest values, and those who name the same value are linked in a
    chain. At most 65 fingerprints can name one value, so no group grows.
    """
    total = fps.count()
    sample = np.array([r[0] for r in T.few_rows(fps, SAMPLE, total).select("_fp").collect()], np.int64)
    plan = allocate(sample, total, distance)
    rows = fps.select("_fp", F.explode(buckets(F.col("_fp"), plan)).alias("_b")).select("_fp", "_b.*")
    sizes = rows.groupBy("mask", "value").count().where("count > 1")
    sizes = T.staged(sizes, "simhash-sizes")
    shared = T.staged(rows.join(sizes, ["mask", "value"]), "simhash-buckets")
    small = shared.where(F.col("count") <= bucket_rows).groupBy("mask", "value").agg(F.collect_list("_fp").alias("m"))
    verified = small.select(
        F.explode(
            F.flatten(
                F.transform(
                    "m",
                    lambda x: F.transform(
                        F.filter("m", lambda y: (y < x) & (_apart(x, y) <= distance)),
                        lambda y: F.struct(x.alias("a"), y.alias("b")),
                    ),
                )
            )
        ).alias("e")
    ).select("e.*")
    hot = shared.where(F.col("count") > bucket_rows).select("_fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)).cast("long") for b in range(BITS)])
    near = F.transform(flips, lambda b: F.col("_fp").bitwiseXOR(b))
    named = hot.select("_fp", F.explode(near).alias("_at")).groupBy("_at").agg(F.sort_array(F.collect_list("_fp")).alias("m"))
    chained = named.where(F.size("m") > 1).select(
        F.explode(
            F.zip_with(
                F.slice("m", F.lit(2), F.size("m") - 1),
                F.slice("m", F.lit(1), F.size("m") - 1),
                lambda a, b: F.struct(a.alias("a"), b.alias("b")),
            )
        ).alias("e")
    ).select("e.*")
    return verified.unionByName(chained).distinct()


def components(edges, rounds=60):
    """(node, root) for every node with an edge; root is the least node reachable.

    Alternates the large-star and small-star steps. Each is a minimum per node, which is
    combined before its shuffle, and a join whose hot keys Spark can split. Tables are
    written between steps. Stops when a round changes nothing.
    """
    state, before = T.staged(edges.select("a", "b"), "component-edges"), None
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    for _ in range(rounds):
        now = tuple(state.agg(F.count(F.lit(1)), mark).first())
        if now == before or not now[0]:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = T.staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "component-least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        state = T.staged(large, "component-large")
        least = T.staged(state.groupBy("a").agg(F.min("b").alias("m")), "component-least")
        moved = state.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        state = T.staged(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "component-small")
    raise RuntimeError(f"components are not settled after {rounds} rounds")


def classes(marked, distance=DISTANCE):
    """`_fp` and `first` for every distinct fingerprint of a staged table (doc_id, _fp, maybe _row).

    `first` is the least (no id, doc_id, _row) among all rows reachable over links; rows
    with a null id come last.
    """
    row = F.col("_row") if "_row" in marked.columns else F.lit(0).cast("long")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("blank"), F.col("doc_id").alias("id"), row.alias("row")))
    fps = T.staged(marked.groupBy("_fp").agg(least.alias("first")), "simhash-distinct")
    found = T.staged(components(links(fps.select("_fp"), distance)), "simhash-members")
    # Roots are nodes of their own component.
    members = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    named = T.staged(members.join(fps, members["node"] == fps["_fp"]).select("_fp", "root", "first"), "simhash-named")
    tops = T.staged(named.groupBy("root").agg(F.min("first").alias("top")), "simhash-tops")
    moved = T.staged(named.join(tops, "root").select("_fp", "top"), "simhash-moved")
    return fps.join(moved, "_fp", "left").select("_fp", F.coalesce("top", "first").alias("first"))


def near_duplicates(docs, distance=DISTANCE):
    """doc_id, fingerprint (16 hex digits), component_id: the least doc_id reachable over links.

    One row per input row. Fingerprints link at `distance` or fewer differing bits. Null,
    empty and blank texts have fingerprint zero and link like any other. Repeated rows
    share all values. A null id takes part but is nobody's component id, unless its
    component has no other: then that is null. Other columns are not read.

    Scale: the text is read once; (doc_id, fingerprint) is written, and copies fall
    together in the distinct fingerprints before anything is compared.
    """
    marked = T.staged(with_fingerprint(docs, ["doc_id"]), "simhash-rows")
    groups = T.staged(classes(marked, distance).select("_fp", F.col("first.id").alias("component_id")), "simhash-groups")
    return marked.join(groups, "_fp").select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs, distance=DISTANCE):
    """One row of each component: the one with the least id, columns as in `docs`."""
    names = docs.columns
    numbered = docs.select(
        *[F.col(f"`{n}`").alias(f"_c{i}") for i, n in enumerate(names)],
        F.col("doc_id").alias("doc_id"),
        F.col("text").alias("text"),
    ).withColumn("_row", F.monotonically_increasing_id())
    kept = [f"_c{i}" for i in range(len(names))]
    rows = T.staged(with_fingerprint(numbered, [*kept, "doc_id", "_row"]), "simhash-rows")
    groups = classes(rows.select("doc_id", "_fp", "_row"), distance)
    firsts = T.staged(groups.select(F.col("first.row").alias("_row")).distinct(), "simhash-firsts")
    # Merged at every size: what is shuffled then follows the input.
    return rows.join(firsts.hint("merge"), "_row", "left_semi").select(*[F.col(c).alias(n) for c, n in zip(kept, names)])
