"""Column expressions shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def finite(c: Column) -> Column:
    """True for numbers, false for NaN and infinities, null for null."""
    return ~F.isnan(c) & (F.abs(c) != INFINITY)


def safe_round(c: Column, digits: int = 4) -> Column:
    """Rounded half-even; null where not finite."""
    return F.when(finite(c), F.bround(c, digits))


def snapped(c: Column, resolution: float) -> Column:
    """A coordinate in cells, set to the nearest whole one where it is within 1e-9 of it."""
    cells = c / resolution
    near = F.rint(cells)
    return F.when(F.abs(cells - near) < 1e-9, near).otherwise(cells)


def safe_xy_scale(largest: Column, current: Column | None = None) -> Column:
    """The least power of ten that stores coordinates as 32-bit integers with room to spare.

    Never finer than the current scale.
    """
    safe = F.pow(F.lit(10.0), F.ceil(F.log10(largest / (0.95 * (2**31 - 1)))))
    return F.greatest(current, safe) if current is not None else safe


def rescaled(c: Column, scale: float) -> Column:
    return F.rint(c / scale) * scale


def fail_reason(*passes: tuple[str, Column]) -> Column:
    """Names of the gates that are not passed, each followed by a space."""
    return F.concat(*(F.when(~ok, F.lit(f"{name} ")).otherwise(F.lit("")) for name, ok in passes))


def bucket(instance_id: Column, buckets: int = 64) -> Column:
    """1 to `buckets`: the id modulo their number."""
    return F.pmod(instance_id, F.lit(float(buckets))).cast("int") + 1


def in_cells(c: Column, resolution: float) -> Column:
    """The cell a coordinate is in: rounded down, of negative numbers too."""
    return F.floor(c / F.lit(resolution)).cast("long")


def layer_bin(height: Column) -> Column:
    """Bin of 1 m that is closed above, the first one at both ends: (0) 0..1, (1) 1..2, and so on."""
    return F.greatest(F.ceil(height) - 1, F.lit(0)).cast("long")


def layers_to(maximum_height: float) -> int:
    """Number of whole 1 m layers from 0."""
    return math.floor(maximum_height + 1e-9)
