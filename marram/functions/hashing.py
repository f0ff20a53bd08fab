"""Orders and weights that depend on a row's key alone, never on its place or partition."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_md5(seed: int, *keys: Column) -> Column:
    """Lower-case hex digest of `seed:key[:key…]`; its text order is the engine's shuffle order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def prefix_digits(buckets: int) -> int:
    """Hex digits that give at least this many equally filled buckets."""
    return max(1, min(6, math.ceil(math.log(max(buckets, 2), 16))))


def unit_interval(seed: int, *keys: Column) -> Column:
    """A repeatable uniform number in [0, 1): the first 32 bits of the seeded digest."""
    return F.conv(F.substring(seeded_md5(seed, *keys), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def poisson_steps() -> list[float]:
    """Edges of the Poisson(1) counts in [0, 1). The series is followed until a further term no longer moves the double."""
    steps, term, total = [], math.exp(-1.0), 0.0
    while total + term != total:
        total += term
        steps.append(total)
        term /= len(steps)
    return steps


def poisson_one(u: Column) -> Column:
    """Poisson(1) count for a uniform `u`: how often a bootstrap bag draws the row."""
    count = F.lit(0)
    for edge in poisson_steps():
        count = count + (u >= F.lit(edge)).cast("int")
    return count
