"""Keeping ordered work balanced when one group holds much of the data.

Exact tools, each with one plan for every size: running totals over a long ordered list,
quantiles, ranking all rows of a group without sorting it in one task, and the cut points
of a hashed order.
"""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from leakwatch.session import staged

BINS = 1 << 16


def running_totals(rows, by, key, values, descending=False):
    """Distinct keys of each group with `values` (name -> aggregate), `cum_<name>` and
    `total_<name>`, the sum over the group.

    Rows are first reduced to one per distinct key, and those are range-partitioned by
    (group, key) and written, so that a piece is what one task sorted; there are as many as
    the session has shuffle partitions. One row per piece gives each its start.
    """
    by = list(by)
    counts = rows.groupBy(*by, key).agg(*[c.alias(n) for n, c in values.items()])
    ranged = counts.repartitionByRange(*[F.col(c) for c in by], F.col(key))
    placed = staged(ranged.withColumn("_piece", F.spark_partition_id()), "running-totals")
    order = F.col(key).desc() if descending else F.col(key).asc()
    group = Window.partitionBy(*by)
    piece_order = F.col("_piece").desc() if descending else F.col("_piece").asc()
    before = group.orderBy(piece_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*by, "_piece")
        .agg(*[F.sum(n).alias(n) for n in values])
        .select(
            *[F.col(c).alias(f"_of_{i}") for i, c in enumerate(by)],
            F.col("_piece").alias("_at"),
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in values],
            *[F.sum(n).over(group).alias(f"total_{n}") for n in values],
        )
    )
    same = F.col("_piece") == F.col("_at")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{i}"))
    inside = Window.partitionBy(*by, "_piece").orderBy(order)
    summed = placed.withColumns({f"cum_{n}": F.sum(n).over(inside) for n in values})
    joined = summed.join(offsets, same)
    out = joined.withColumns({f"cum_{n}": F.col(f"_before_{n}") + F.col(f"cum_{n}") for n in values})
    return out.drop("_piece", "_at", *[f"_of_{i}" for i in range(len(by))], *[f"_before_{n}" for n in values])


def hash_cuts(rows, by, number, domain, tie, ranks):
    """Where the hashed order of each group reaches given ranks: {(group values): {name: (number, tie)}}.

    `number` is an evenly spread whole number in 0..domain-1; ties are broken by `tie`.
    `ranks` maps a name to a function from a group's size to a rank from 1. A rank of 0 or
    less has no cut (None); one beyond the size gets the last row. Only bin counts and the
    few bins that hold a cut are looked at, so nothing long is sorted or shuffled.
    """
    by = list(by)

    def bin_of(n):
        return F.floor(n * F.lit(float(BINS)) / F.lit(float(domain))).cast("int")

    sizes = staged(rows.groupBy(*by, bin_of(number).alias("_bin")).count(), "hash-bins")
    group = Window.partitionBy(*by)
    running = sizes.select(
        *by,
        "_bin",
        F.sum("count").over(group).alias("_size"),
        F.sum("count").over(group.orderBy("_bin")).alias("_upto"),
        "count",
    )
    wanted = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.least(rank(F.col("_size")), F.col("_size")).cast("long").alias("rank")) for n, rank in ranks.items()]))
    hits = (
        running.withColumn("_w", wanted)
        .filter((F.col("_w.rank") <= F.col("_upto")) & (F.col("_w.rank") > F.col("_upto") - F.col("count")))
        .select(*by, "_bin", "_w.name", (F.col("_w.rank") - F.col("_upto") + F.col("count")).alias("place"))
        .collect()
    )
    cuts = {tuple(r[c] for c in by): dict.fromkeys(ranks) for r in sizes.select(*by).distinct().collect()}
    if not hits:
        return cuts
    bins = {}
    for r in hits:
        bins.setdefault(tuple(r[c] for c in by), set()).add(r["_bin"])

    def holds_a_cut(b):
        found = F.lit(False)
        for values, own in bins.items():
            one = b.isin(sorted(own))
            for c, v in zip(by, values):
                one = one & F.col(c).eqNullSafe(F.lit(v))
            found = found | one
        return found

    # Bound once: the hash is a long expression.
    held = F.get(F.transform(F.array(bin_of(number)), holds_a_cut), F.lit(0))
    binned = rows.filter(held).select(*by, number.alias("_number"), F.col(tie).alias("_tie"))
    binned = binned.withColumn("_bin", bin_of(F.col("_number")))
    inside = Window.partitionBy(*by, "_bin").orderBy("_number", "_tie")
    places = sorted({r["place"] for r in hits})
    found = binned.withColumn("_place", F.row_number().over(inside)).filter(F.col("_place").isin(places))
    at = {(*[r[c] for c in by], r["_bin"], r["_place"]): (r["_number"], r["_tie"]) for r in found.collect()}
    for r in hits:
        key = tuple(r[c] for c in by)
        cuts[key][r["name"]] = at[(*key, r["_bin"], r["place"])]
    return cuts


def within_cut(number, tie, cut):
    """Whether a row is at or before a cut of the hashed order."""
    if cut is None:
        return F.lit(False)
    # Bound once: the hash is a long expression.
    bound = F.transform(
        F.array(number), lambda n: (n < cut[0]) | ((n == cut[0]) & (F.col(tie) <= F.lit(cut[1])))
    )
    return F.get(bound, F.lit(0))


def global_rank(df, by, number, domain, tie, name="_rank"):
    """Exact position (from 1) of each row in its group, and `<name>_of`, its size.

    `number` is an evenly spread whole number in 0..domain-1 (a hash of the id),
    so equal pieces of its domain hold like numbers of rows and no task has to
    sort a whole group. There are about as many pieces as rows in a piece.
    """
    by = list(by)
    pieces = max(1, math.isqrt(df.count()))
    placed = df.withColumn("_number", number).withColumn(
        "_piece", F.floor(F.col("_number") / F.lit(math.ceil(domain / pieces))).cast("int")
    )
    group = Window.partitionBy(*by)
    before = group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        placed.groupBy(*by, "_piece")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(
            *by,
            "_piece",
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
            F.sum("_size").over(group).alias(f"{name}_of"),
        )
    )
    inside = Window.partitionBy(*by, "_piece").orderBy("_number", tie)
    ranked = placed.join(sizes, [*by, "_piece"]).withColumn(
        name, F.col("_before") + F.row_number().over(inside)
    )
    return ranked.drop("_number", "_piece", "_before")


def exact_quantiles(df, by, value, shares):
    """Exact quantiles with linear interpolation; `shares` maps name -> share.

    Works on distinct values with running counts, so no task ever holds all
    values of a group.
    """
    by = list(by)
    keyed = df.filter(F.col(value).isNotNull())
    sized = running_totals(keyed, by, value, {"n": F.count(F.lit(1))})
    picks = []
    for name, share in shares.items():
        spot = F.lit(float(share)) * (F.col("total_n") - 1)
        low = F.min(F.when(F.col("cum_n") > F.floor(spot), F.col(value)))
        high = F.min(F.when(F.col("cum_n") > F.ceil(spot), F.col(value)))
        weight = F.max(spot - F.floor(spot))
        picks.append((low + (high - low) * weight).alias(name))
    return sized.groupBy(*by).agg(*picks)
