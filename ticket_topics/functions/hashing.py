"""Hash draws that do not depend on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = 1 << 32


def md5_draw(seed, *cols: Column) -> Column:
    """A number in 0 .. 2**32-1 from the seed and the columns."""
    text = F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def md5_bucket(seed, buckets: int, *cols: Column) -> Column:
    return F.pmod(md5_draw(seed, *cols), F.lit(buckets))


def poisson_cuts(rate: float) -> list[int]:
    """Cumulative Poisson probabilities on the scale of :func:`md5_draw`."""
    cuts, p, total, k = [], math.exp(-rate), 0.0, 0
    while True:
        total += p
        cut = math.floor(total * _RANGE)
        if cut >= _RANGE or (cuts and cut == cuts[-1]):
            return cuts
        cuts.append(cut)
        k += 1
        p *= rate / k


def poisson_weight(draw: Column, rate: float) -> Column:
    """Poisson count of a draw: how many cumulative cuts lie at or below it."""
    weight = F.lit(0)
    for cut in poisson_cuts(rate):
        weight = weight + (draw >= F.lit(cut)).cast("int")
    return weight
