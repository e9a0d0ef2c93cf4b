"""Seeded draws that depend on a row's id only.

The same id, seed and stream give the same number on any partitioning, and
after any retry. Integer arithmetic modulo a prime keeps them portable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2147483647  # 2**31 - 1, so squares stay within a long


def coefficients(seed: int, stream: int) -> tuple[int, int]:
    """Multiplier and offset of one stream of draws."""
    return 48271 * (2 * stream + 1) % PRIME, (69621 * seed + 40692 * stream) % PRIME


def uniform(row_id: Column, seed: int, stream: int) -> Column:
    """A number in [0, 1): two squaring rounds between linear ones."""
    a, b = coefficients(seed, stream)
    p = F.lit(PRIME).cast("long")
    row = row_id.cast("long")
    # What of an id is above the prime is added before the squaring rounds.
    high = F.pmod(F.call_function("div", row, p), p)
    x = (F.pmod(row, p) * a + b + high * 40692 % p) % p
    x = (x * x + a) % p
    x = (x * 16807 + b) % p
    x = (x * x + a) % p
    return x / F.lit(float(PRIME))
