"""Column expressions, all evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def without_nan(c: Column) -> Column:
    """NaN is a value to Spark but a missing measurement to us."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def ratio_or_zero(num: Column, den: Column) -> Column:
    """num / den as double, 0 where the denominator is 0 or either side is missing."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def decode_label(label: Column, fail_value: int = 1) -> Column:
    """1 reads as `fail`, anything else as `pass`."""
    return F.when(label == fail_value, "fail").otherwise("pass")


def edge_index(c: Column, edges: Sequence[float]) -> Column:
    """How many of the ascending `edges` are <= c, as a balanced CASE tree.

    Depth grows with log2(len(edges)) and the expression stays inside generated code, so bucketing a
    row against a fixed grid needs neither a join with the grid nor a copy of the row per grid point.
    """

    def branch(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c >= F.lit(float(edges[mid])), branch(mid + 1, hi)).otherwise(branch(lo, mid))

    return F.when(c.isNotNull(), branch(0, len(edges)))


def unit_hash(c: Column, seed: int | str = 0) -> Column:
    """Hex digest that orders rows at random but repeatably: a retried task gets the same order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), c.cast("string")))
