"""Reproducible uniform draws: a pure function of the key and a salt, never ``rand()``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 1_000_000

# A draw takes (salt, *columns) and gives a bucket in [0, BUCKETS).
Draw = Callable[..., Column]


def xx_draw(salt: int, *cols: Column | str) -> Column:
    """Production draw: one 64-bit hash, whole-stage codegen."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.pmod(F.xxhash64(*parts, F.lit(salt)), F.lit(BUCKETS))


def md5_draw(salt: int, *cols: Column | str) -> Column:
    """Portable draw that any SQL engine with md5 can repeat; used for comparison runs."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    text = F.concat_ws("|", F.lit(str(salt)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(BUCKETS)


# A weighted pick needs finer draws than BUCKETS: there may be more keys than that.
WIDE_BITS = 48


def xx_wide(salt: int, *cols: Column | str) -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.shiftrightunsigned(F.xxhash64(*parts, F.lit(salt)), 64 - WIDE_BITS)


def md5_wide(salt: int, *cols: Column | str) -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    text = F.concat_ws("|", F.lit(str(salt)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, WIDE_BITS // 4), 16, 10).cast("bigint")


WIDE: dict[Draw, Draw] = {xx_draw: xx_wide, md5_draw: md5_wide}


def uniform(bucket: Column) -> Column:
    return bucket / F.lit(float(BUCKETS))


def pick(values: list[str], index: Column) -> Column:
    """The value at a zero-based index that wraps around the list."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def by_threshold(bucket: Column, cuts: list[tuple[int, object]], otherwise: object) -> Column:
    """First category whose upper cut (in buckets) is above the draw."""
    first_cut, first_value = cuts[0]
    chain = F.when(bucket < first_cut, F.lit(first_value))
    for cut, value in cuts[1:]:
        chain = chain.when(bucket < cut, F.lit(value))
    return chain.otherwise(F.lit(otherwise))


def lognormal(u1: Column, u2: Column, sigma: float) -> Column:
    """Box-Muller from two uniform draws; the epsilon keeps the logarithm finite."""
    radius = F.sqrt(F.lit(-2.0) * F.log(u1 + F.lit(1e-9)))
    return F.exp(F.lit(sigma) * radius * F.cos(F.lit(2.0) * F.pi() * u2))
