"""Oversampling: interpolation between nearest neighbours, and jitter."""

from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.functions import fixed
from leakwatch.operators import spread
from leakwatch.operators.neighbours import nearest_neighbours
from leakwatch.session import staged

# Copies of one row beyond this many are made by several tasks.
COPIES_PER_PIECE = 10_000
COPIES_PER_TASK = 200_000


def interpolation_target(n_minority, n_majority, ratio=0.1):
    """Minority rows wanted, and how many neighbours to use; too few rows: no change."""
    if n_minority < 10:
        return n_minority, 0
    return max(int(n_majority * ratio), n_minority), min(5, n_minority - 1)


def interpolate_minority(rows, names, ratio=0.1, id_col="id", label="label", seed=fixed.SEED):
    """Synthetic minority rows between a row and one of its nearest neighbours.

    Extra rows are shared out evenly over the minority; which neighbour and how
    far along is drawn from the row's id and copy number, so retries repeat it.

    The rows are written once: they are read in five places, and a filter on a label that is still an expression
    carries all of it into every scan.
    """
    rows = staged(rows.select(*[F.col(f"`{n}`") for n in dict.fromkeys([id_col, *names, label])]), "oversample-rows")
    sizes = rows.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    target, k = interpolation_target(sizes[0], sizes[1], ratio)
    base = rows.select(id_col, *[F.col(f"`{n}`").cast("double").alias(n) for n in names], label)
    base = base.withColumn("synthetic", F.lit(False))
    extra = target - sizes[0]
    if k == 0 or extra <= 0:
        return base
    minority = rows.filter(F.col(label) == 1)
    point = F.struct(*[F.col(f"`{n}`").cast("double").alias(n) for n in names])
    points = minority.select(F.col(id_col).cast("bigint").alias("id"), point.alias("p"))
    near = staged(nearest_neighbours(minority, names, k, id_col), "oversample-neighbours")
    choices = near.groupBy("id").agg(F.max("rank").alias("found"))
    keys = F.col("draw.one"), F.col("draw.two")
    copies = (
        even_copies(points, "id", sizes[0], extra, seed)
        .join(choices, "id")
        .withColumn("draw", F.struct(*[k.alias(n) for k, n in zip(C.draw_keys("id", "copy"), ("one", "two"))]))
        .withColumn("rank", (F.floor(C.unit_of(keys, seed) * F.col("found")) + 1).cast("int"))
    )
    joined = copies.join(near.select("id", "rank", "neighbour"), ["id", "rank"]).join(
        points.select(F.col("id").alias("neighbour"), F.col("p").alias("q")), "neighbour"
    )
    step = C.unit_of(keys, seed + 1)
    made = joined.select(
        F.col("id").alias(id_col),
        *[(F.col(f"p.`{n}`") + step * (F.col(f"q.`{n}`") - F.col(f"p.`{n}`"))).alias(n) for n in names],
        F.lit(1).alias(label),
        F.lit(True).alias("synthetic"),
    )
    return base.unionByName(made)


def even_copies(rows, id_col, size, extra, seed):
    """Repeat rows so that `extra` copies come out, as evenly as possible.

    Adds `copy`, numbered from 1; rows without a share are left out. The copies of a row are cut into pieces
    of a bounded number, which are spread over the tasks before the copies are made.
    """
    one = rows.withColumn("_all", F.lit(1))
    ranked = spread.global_rank(one, ["_all"], C.mix(id_col, seed), C.MIX_DOMAIN, id_col)
    share = F.lit(extra // size) + (F.col("_rank") <= extra % size).cast("bigint")
    last = F.floor((F.col("_share") - 1) / COPIES_PER_PIECE)
    pieces = (
        ranked.withColumn("_share", share)
        .filter(F.col("_share") > 0)
        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        # By number, as the few bytes of the pieces do not show what they grow to.
        .repartition(-(-extra // COPIES_PER_TASK), id_col, "_part")
    )
    start = F.col("_part") * COPIES_PER_PIECE
    numbers = F.sequence(start + 1, F.least(start + COPIES_PER_PIECE, F.col("_share")))
    return pieces.withColumn("copy", F.explode(numbers)).drop("_all", "_rank", "_rank_of", "_share", "_part")


def jitter(rows, names, target, id_col="id", seed=fixed.SEED):
    """Rows plus noisy copies up to `target` rows: value + N(0, max(8 % of it, 1)), at least 0.

    `copy` is 0 for the rows themselves. The noise depends on the row's id and the copy's number alone, so a retry
    repeats it, and no two copies share it.
    """
    size = rows.count()
    cells = [F.col(f"`{n}`").cast("double").alias(n) for n in names]
    base = rows.select(id_col, *cells).withColumn("copy", F.lit(0).cast("bigint"))
    if size == 0 or target <= size:
        return base
    copies = even_copies(rows.select(id_col, *cells), id_col, size, target - size, seed)
    copies = copies.withColumn("_draw", F.struct(*[k.alias(n) for k, n in zip(C.draw_keys(id_col, "copy"), ("one", "two"))]))
    keys = F.col("_draw.one"), F.col("_draw.two")
    noisy = []
    for i, n in enumerate(names):
        scale = F.greatest(F.abs(F.col(f"`{n}`")) * 0.08, F.lit(1.0))
        noisy.append(F.greatest(F.lit(0.0), F.col(f"`{n}`") + C.normal_of(keys, seed + i) * scale).alias(n))
    return base.unionByName(copies.select(id_col, *noisy, "copy"))
