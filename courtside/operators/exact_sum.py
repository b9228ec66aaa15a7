"""Sums of doubles that do not depend on the order of rows or partitions.

A finite double is cut into whole limbs: the part before the point and 24 bits at
a time after it. Every cut is exact, the sums of limbs are sums of whole
numbers, and only their combination is rounded, always in the same order. Bits
beyond 2**-144 are not summed: of doubles of at least 2**-91 in magnitude there are none.
Sums hold 2**39 rows a group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtside.functions.util import col_of

LIMBS, BITS = 6, 24
RADIX = 2.0 ** BITS


def _limbs(x: Column) -> list[Column]:
    whole = F.floor(x)
    out, rest = [whole.cast("decimal(20,0)")], x - whole.cast("double")
    for _ in range(LIMBS):
        scaled = rest * RADIX
        limb = F.floor(scaled)
        out.append(limb)
        rest = scaled - limb.cast("double")
    return out


def exact_sum(value) -> Column:
    """The sum of a double column's non-null values (null if there are none).

    With an infinite or undefined value, or one of 2**62 or more, it is the plain sum.
    """
    x = col_of(value).cast("double")
    plain = F.isnan(x) | (F.abs(x) >= 2.0 ** 62)
    parts = [F.sum(limb) for limb in _limbs(F.when(~plain, x))]
    whole, places = parts[0].cast("decimal(38,0)"), parts[1:]
    # from the last place up: what exceeds a place goes to the one before it
    carry, digits = F.lit(0).cast("bigint"), []
    for s in reversed(places):
        total = s + carry
        carry = F.shiftright(total, BITS)
        digits.append(total - F.shiftleft(carry, BITS))
    fraction = F.lit(0.0)
    for d in digits:  # from the last place up
        fraction = (fraction + d.cast("double")) / RADIX
    exact = (whole + carry.cast("decimal(20,0)")).cast("double") + fraction
    return F.when(F.max(plain), F.sum(x)).otherwise(exact)
