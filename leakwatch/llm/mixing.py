"""Mixing sources to target weights.

Every source gets a word budget. Its documents are put in the order of a hash of
their id, word counts are summed along that order, and the order is cut where the
budget is used up. Budgets above a source's size repeat the source (epochs).
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from leakwatch.llm import text as T

SEED = "mix"
MOST_SOURCES = 100_000  # that are broadcast
SALTS = 32


def hash_key(doc_id, seed=SEED):
    """60 bits of an md5 of the id: the random place of a document in its source."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def positional_weights(sources, cycle=(5, 2, 1)):
    """Weights by the place of a source in code point order, null last, repeating `cycle`.

    `sources` has one row per source, so the one ordered task holds a list of names.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cases = F.element_at(F.array(*[F.lit(w) for w in cycle]), (place % len(cycle) + 1).cast("int"))
    return sources.withColumn("weight", cases.cast("long"))


def targets(sources, share=(3, 2), epochs=2):
    """Word budget of each source: `share` (a fraction) of all words, split by weight.

    sources: source, source_size, weight (whole, positive), a row per source. A budget
    stops at `epochs` times the source's size; what it leaves is shared by weight among
    the others until none is above. That ends with the sources of the lowest
    size-to-weight ratios at their cap and all others at one common rate, so one pass in
    that order finds the result. Sums are exact decimals.
    """
    wide = "decimal(38,0)"
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cap = (F.col("source_size") * epochs).cast(wide)
    up, down = share
    placed = sources.select(
        "*",
        cap.alias("_cap"),
        F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(wide).alias("_before"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).cast(wide).alias("_rest"),
        F.sum("source_size").over(whole).cast(wide).alias("_all"),
    )
    full = F.col("_cap") * F.col("_rest") * down <= (F.col("_all") * up - F.col("_before") * down) * F.col("weight").cast(wide)
    marked = placed.withColumn("_full", full)
    open_weight = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(whole)
    used = F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(whole), F.lit(0))
    left = F.col("_all").cast("double") * up / down - used.cast("double")
    budget = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(
        F.col("weight").cast("double") * left / open_weight.cast("double")
    )
    return marked.select("source", "source_size", "weight", budget.alias("target"))


def mix_plan(docs, weights=positional_weights, share=(3, 2), epochs=2, seed=SEED):
    """How many words the mix takes of every document.

    Returns doc_id, size, source_size, target, taken, one row per input row. `weights` turns a table of
    (source, source_size) into one with `weight`.

    Of a source with budget t and size s, floor(t / s) whole epochs are taken and the
    rest, floor(t) minus those words, from the start of the hash order; the document on
    the cut gives only its first words. So a source's taken words add up to floor(t).

    Nulls: a null text has size 0; null sources form one source; rows with a null id
    are ordered like an empty id. Equal ids are ordered by size and text hash, and rows
    equal in all of that can swap places without a visible change. An empty table gives
    an empty plan. Other columns are not read.

    Scale: the text is read once, and only (id, source, size) go on. The hash is cut
    into about sqrt(rows) even pieces; one row per source and piece gives the offsets,
    and rows are sorted within (source, piece) only, so a source with a third of all
    rows is spread like the others.
    """
    return _plan(docs, weights, share, epochs, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("_turns") * F.col("size") + F.col("_cut")).alias("taken")
    )


def _placed(docs, seed, *more):
    """`size` and what orders a row in its source: `_key`, `doc_id`, `size`, `_text`."""
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(T.WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("_text"),
        hash_key(F.col("doc_id"), seed).alias("_key"),
        *more,
    )


def _plan(docs, weights, share, epochs, seed):
    """Every row's place in its source, the whole epochs `_turns`, and the words `_cut` of one more."""
    sized = T.staged(_placed(docs, seed), "mix-sizes")
    rows = sized.count()
    pieces = max(1, math.isqrt(rows))
    placed = sized.withColumn("_piece", F.floor(F.col("_key") / F.lit(math.ceil((1 << 60) / pieces))).cast("int"))
    by_piece = placed.groupBy("source", "_piece").agg(F.sum("size").alias("_words"))
    sources = by_piece.groupBy("source").agg(F.sum("_words").alias("source_size"))
    budgets = targets(weights(sources), share, epochs)
    before = Window.partitionBy("source").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_piece.select(
        F.col("source").alias("_source"),
        F.col("_piece").alias("_at"),
        F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_offset"),
    ).join(
        budgets.select(F.col("source").alias("_of"), "source_size", "target"),
        F.col("_source").eqNullSafe(F.col("_of")),
    )
    inside = (
        Window.partitionBy("source", "_piece")
        .orderBy("_key", "doc_id", "size", "_text")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = placed.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = summed.join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_piece") == F.col("_at")))
    turns = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor("target").cast("long") - turns * F.col("source_size")
    cut = F.least(F.greatest(rest - F.col("_offset") - F.col("_before"), F.lit(0)), F.col("size"))
    return joined.select(
        "doc_id", "source", "size", "_text", "_key", "source_size", "target", turns.alias("_turns"), cut.cast("long").alias("_cut")
    )


def first_words(text, n):
    """A text up to the end of its n-th word; the gaps between words stay as they are."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def _numbered(rows):
    """Equal rows at the end of their source, with `_part` the words each gives: whole ones first.

    They are written once, which fixes their numbers. A task numbers its own rows of a source, and starts
    from the counts of the tasks before it.
    """
    fixed = T.staged(rows.withColumn("_row", F.monotonically_increasing_id()), "mix-equal")
    fixed = fixed.withColumn("_task", F.shiftright("_row", 33))
    inside = Window.partitionBy("_of", "_task").orderBy("_row")
    before = Window.partitionBy("_of").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = fixed.groupBy("_of", "_task").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("_of").alias("_of2"), F.col("_task").alias("_task2"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    placed = fixed.withColumn("_at", F.row_number().over(inside) - 1).join(
        starts, F.col("_of").eqNullSafe(F.col("_of2")) & (F.col("_task") == F.col("_task2"))
    )
    left = F.col("_end.cut") - (F.col("_start") + F.col("_at")) * F.col("size")
    part = F.least(F.greatest(left, F.lit(0)), F.col("size")).cast("long")
    return placed.withColumn("_part", part).select(*rows.columns)


def mix(docs, weights=positional_weights, share=(3, 2), epochs=2, seed=SEED):
    """The mixed documents: each row as often as the mix takes it, with the columns of `docs`.

    A document on the cut is repeated once more with its first words only. Documents of
    which nothing is taken, such as those without words, are gone. Of rows on the cut that
    are equal in id and text, as many are whole as the rest of the budget holds, and one
    more gives its first words.

    Scale: only the plan is shuffled, and no text up to MOST_SOURCES sources. A source is described by one row, the
    last place of its order that still gives words; with that row at hand, a document
    decides for itself. Those rows are broadcast up to MOST_SOURCES sources. Beyond that
    rows are joined by source and one of SALTS parts of it, which shuffles the texts, and
    a source with a third of all rows is still met by many tasks.
    """
    names = docs.columns
    plan = _plan(docs, weights, share, epochs, seed)
    order = F.struct("_key", F.col("doc_id").isNull().alias("blank"), "doc_id", "size", "_text")
    places = plan.groupBy("source", order.alias("place")).agg(
        F.first("_turns").alias("_turns"), F.sum("_cut").alias("cut"), F.count(F.lit(1)).alias("rows")
    )
    used = F.col("cut") > 0
    ends = places.groupBy("source").agg(
        F.first("_turns").alias("_turns"),
        F.max_by(F.struct("place", "cut", "rows"), F.when(used, F.col("place"))).alias("_end"),
    )
    ends = T.staged(ends, "mix-ends")
    kept = [f"_c{i}" for i in range(len(names))]
    rows = _placed(docs, seed, *[F.col(f"`{n}`").alias(c) for n, c in zip(names, kept)]).withColumn("_place", order)
    staged_ends = ends
    ends = ends.select(F.col("source").alias("_of"), "_turns", "_end")
    same = F.col("source").eqNullSafe(F.col("_of"))
    if staged_ends.count() <= MOST_SOURCES:
        joined = rows.join(F.broadcast(ends), same)
    else:
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
        salted = ends.withColumn("_salt2", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        joined = rows.withColumn("_salt", salt).join(salted, same & (F.col("_salt") == F.col("_salt2")))
        joined = joined.drop("_salt", "_salt2")
    at_end = F.col("_place") == F.col("_end.place")
    part = F.when(F.col("_place") < F.col("_end.place"), F.col("size")).when(at_end, F.col("_end.cut"))
    joined = joined.withColumn("_part", F.coalesce(part, F.lit(0)).cast("long"))
    if not staged_ends.where("_end.rows > 1").isEmpty():
        several = F.coalesce(at_end & (F.col("_end.rows") > 1), F.lit(False))
        joined = joined.where(~several).unionByName(_numbered(joined.where(several)))
    # Copies by their number of words; whole ones as 0.
    copies = F.concat(
        F.array_repeat(F.lit(0).cast("long"), F.col("_turns").cast("int")),
        F.when(F.col("_part") == F.col("size"), F.array(F.lit(0).cast("long")))
        .when(F.col("_part") > 0, F.array("_part"))
        .otherwise(F.array().cast("array<bigint>")),
    )
    repeated = joined.where("size > 0").select(*kept, F.explode(copies).alias("_words"))
    cut = F.col(f"_c{names.index('text')}")
    text = F.when(F.col("_words") == 0, cut).otherwise(first_words(cut, F.col("_words")))
    return repeated.select(*[(text if n == "text" else F.col(c)).alias(n) for n, c in zip(names, kept)])
