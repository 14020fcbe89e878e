"""Column expressions shared by the operators. Everything here stays in the JVM."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from leakwatch.functions import fixed


def finite(col, fill=0.0) -> Column:
    """The value as a double, or `fill` where it is null, NaN or infinite."""
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return F.when(bad, F.lit(float(fill))).otherwise(c)


def numeric_or_zero(col) -> Column:
    """Strings that are not numbers, nulls and NaN become 0; infinities stay."""
    c = (F.col(col) if isinstance(col, str) else col).try_cast("double")
    return F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0))


def safe_div(a, b, default=0.0) -> Column:
    """a / b, or `default` where b is null or 0 or the result is not finite."""
    a, b = F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b
    a, b = a.cast("double"), b.cast("double")
    quotient = F.when(b != 0, a / F.when(b != 0, b))
    usable = (quotient > F.lit(-1e308)) & (quotient < F.lit(1e308))
    return F.when(usable, quotient).otherwise(F.lit(float(default)))


def zero_to_one(c: Column) -> Column:
    return F.when(c == 0, F.lit(1).cast("double")).otherwise(c)


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def total(cols) -> Column:
    return reduce(lambda a, b: a + b, cols)


def variance(n: Column, s: Column, sq: Column) -> Column:
    """Population variance from count, sum and sum of squares; 0 below two values."""
    n, s = n.cast("double"), s.cast("double")
    return F.when(n > 1, F.greatest((sq - s * s / n) / n, F.lit(0.0))).otherwise(F.lit(0.0))


def spread(n: Column, s: Column, sq: Column) -> Column:
    """Population standard deviation from count, sum and sum of squares."""
    return F.sqrt(variance(n, s, sq))


def moment_names(name):
    return (f"{name}_n", f"{name}_mean", f"{name}_m2")


def moments(name, x: Column) -> dict:
    """Aggregates `<name>_n`, `_mean` and `_m2` (summed squared deviation), taken around the mean."""
    return {
        f"{name}_n": F.count(x),
        f"{name}_mean": F.avg(x),
        f"{name}_m2": F.coalesce(F.var_pop(x) * F.count(x), F.lit(0.0)),
    }


def stitched_m2(name, seam, center) -> Column:
    """Summed squared deviation from `center`, over parts with moments and single seam values.

    Parts are moved to the common mean by their distance from it, never by squares of the
    values, so equal values far from 0 give 0.
    """
    moved = F.col(f"{name}_m2") + F.col(f"{name}_n") * F.pow(F.col(f"{name}_mean") - F.col(center), F.lit(2.0))
    single = F.pow(F.col(seam) - F.col(center), F.lit(2.0))
    return F.coalesce(F.sum(F.when(F.col(f"{name}_n") > 0, moved)), F.lit(0.0)) + F.coalesce(F.sum(single), F.lit(0.0))


def decode_flags(flags: Column) -> Column:
    """TCP flag byte to a struct of six booleans; null (UDP) gives all false."""
    byte = F.coalesce(flags.cast("int"), F.lit(0))
    return F.struct(
        *[(byte.bitwiseAND(bit) != 0).alias(name) for name, bit in fixed.TCP_FLAG_BITS.items()]
    )


def direction(flags="tcp_flags", src_port="src_port", dst_port="dst_port") -> Column:
    """Ordered rules: a bare SYN opens forward, SYN+ACK answers, a closing packet
    keeps the default, and otherwise the ephemeral side is the client."""
    syn, ack = F.col(f"{flags}.SYN"), F.col(f"{flags}.ACK")
    closing = F.col(f"{flags}.RST") | F.col(f"{flags}.FIN")
    return (
        F.when(syn & ~ack, F.lit("fwd"))
        .when(syn & ack, F.lit("bwd"))
        .when(closing, F.lit("fwd"))
        .when(F.col(src_port) > fixed.EPHEMERAL_FLOOR, F.lit("fwd"))
        .when(F.col(dst_port) > fixed.EPHEMERAL_FLOOR, F.lit("bwd"))
        .otherwise(F.lit("fwd"))
    )


def is_http(src_port="src_port", dst_port="dst_port", ports=None) -> Column:
    ports = ports or fixed.HTTP_PORTS
    return F.col(src_port).isin(*ports) | F.col(dst_port).isin(*ports)


def severity(score: Column) -> Column:
    """Ladder on the score; rounding first removes the noise of summed weights."""
    s = F.round(score, 6)
    ladder = F.lit("INFO")
    for name, floor in reversed(fixed.SEVERITY_FLOORS):
        ladder = F.when(s >= floor, F.lit(name)).otherwise(ladder)
    return ladder


def round_exact(c: Column, digits: int) -> Column:
    """Rounded by the exact binary value, true ties to even, as C's printf does.

    Scaling by a power of ten rounds, so 0.5255 (a little less than that in
    binary) would look like a tie. `lost` is what the scaling rounded away.
    """
    scale = float(10**digits)
    x = c.cast("double")
    scaled = x * scale
    big = x * 134217729.0
    high = big - (big - x)
    lost = (high * scale - scaled) + (x - high) * scale
    whole = F.floor(scaled)
    rest = scaled - whole
    tie_up = (lost > 0) | ((lost == 0) & (F.pmod(whole, F.lit(2)) == 1))
    up = (rest > 0.5) | ((rest == 0.5) & tie_up)
    return (whole + up.cast("int")) / scale


def fixed_text(c: Column, digits: int) -> Column:
    """Text with a fixed number of decimals; null stays null."""
    text = F.format_string(f"%.{digits}f", round_exact(c, digits))
    return F.when(c.isNotNull(), text)


def utc_text(seconds: Column, pattern: str) -> Column:
    """Epoch seconds as UTC text, whatever the session's time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    moment = F.timestamp_add("MICROSECOND", F.round(seconds * 1e6).cast("bigint"), epoch)
    return F.date_format(moment, pattern)


def grouped_text(c: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(c.cast("bigint"), 0)


# --- repeatable pseudo-randomness --------------------------------------------------
# rand()/randn() depend on the partition a row falls into, so a retried task could
# draw other numbers. These depend on the row's id alone.

MIX_DOMAIN = 2_147_483_647


def mix(id_col, seed=0) -> Column:
    """Map an id to 0..MIX_DOMAIN-1, evenly spread.

    Two quadratic steps modulo a prime: draws of different seeds are independent
    enough to be paired (linear steps are not), and whole numbers keep it the same
    in every engine.
    """
    c = (F.col(id_col) if isinstance(id_col, str) else id_col).cast("bigint")
    s = seed if isinstance(seed, Column) else F.lit(seed)
    s, m = s.cast("bigint"), F.lit(MIX_DOMAIN)
    x = F.pmod(F.pmod(c, m) * 48271 + s * 7919 + 1, m)
    x = F.pmod(F.pmod(x * (x + 69621), m) + s * 104729, m)
    return F.pmod(x * (x + 69621), m)


def mix_sql(c: str, seed) -> str:
    """The same mapping as SQL text, for checks in another engine."""
    m = MIX_DOMAIN
    x = f"((({c}) % {m} * 48271 + {seed} * 7919 + 1) % {m})"
    x = f"(({x} * ({x} + 69621) % {m} + {seed} * 104729) % {m})"
    return f"({x} * ({x} + 69621) % {m})"


def draw_keys(id_col, copy):
    """Two numbers of a (row, copy) pair, for `unit_of`. Each names the pair up to chance alone, and together they
    tell any two pairs apart but for one chance in MIX_DOMAIN squared. Ids may have 63 bits."""
    a, c, m = F.col(id_col).cast("bigint"), F.col(copy).cast("bigint"), F.lit(MIX_DOMAIN)
    high = F.floor(a / m)
    one = F.pmod(mix(id_col, 77) + F.pmod(high, m) + c * 1_000_003, m)
    two = F.pmod(mix(id_col, 79) + F.pmod(high, m) * 3 + c * 998_244_353, m)
    return one, two


def draw_keys_sql(a: str, c: str):
    """The same two numbers as SQL text, for ids of 31 bits."""
    m = MIX_DOMAIN
    return f"(({mix_sql(a, 77)} + {c} * 1000003) % {m})", f"(({mix_sql(a, 79)} + {c} * 998244353) % {m})"


def unit_of(keys, seed) -> Column:
    """Uniform in (0, 1) with 53 bits, fixed by the keys and the seed."""
    m = float(MIX_DOMAIN)
    return (mix(keys[0], seed * 2).cast("double") * m + mix(keys[1], seed * 2 + 1) + 0.5) / (m * m)


def unit_of_sql(keys, seed):
    m = f"{MIX_DOMAIN}e0"
    return f"((CAST({mix_sql(keys[0], seed * 2)} AS DOUBLE) * {m} + {mix_sql(keys[1], seed * 2 + 1)} + 0.5e0) / ({m} * {m}))"


def normal_of(keys, seed) -> Column:
    """Standard normal (Box-Muller), fixed by the keys and the seed."""
    radius = F.sqrt(-2.0 * F.log(unit_of(keys, seed * 2 + 1)))
    return radius * F.cos(2.0 * F.pi() * unit_of(keys, seed * 2 + 2))


def normal_of_sql(keys, seed):
    return f"(sqrt(-2e0 * ln({unit_of_sql(keys, seed * 2 + 1)})) * cos(2e0 * pi() * {unit_of_sql(keys, seed * 2 + 2)}))"
