"""Sums and means of doubles that do not hang on the order of the rows.

Adding doubles rounds at every step, so a plain sum changes its last digits with
the order in which tasks and partitions come.  Here every value is cut at fixed
powers of two into whole numbers of ``BITS`` bits, which is exact; these are summed
as integers, which no order changes; and the integer sums become one double at
the end.  Partial sums merge as any integer sums do, before and after a shuffle.

Values under ``2 ** top`` in size take part with all bits down to ``2 ** low``
(what lies below is added as plain doubles); a narrower range than the given one
costs less per value.  A group that holds a larger value, an infinity or a NaN
gets the plain sum.  NULLs are left out, a group of NULLs
gives NULL.  A group may hold 2 ** 39 rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 24
LOW, TOP = -120, 96


def _parts(x: Column, steps: list[int]) -> tuple[list[Column], Column]:
    """Whole multiples of the cuts, from the highest, and what is left below
    them: a remainder by a power of two is exact, and so is the difference of two."""
    def below(e: int) -> Column:
        return x % F.lit(float(2.0 ** e))
    return [((below(e + BITS) - below(e)) / F.lit(float(2.0 ** e))).cast("bigint") for e in steps], below(steps[-1])


def _joined(sums: list[Column], steps: list[int]) -> tuple[Column, Column]:
    """The double of integer sums (from the highest cut, of a total that is not
    negative), and the highest digit after all carries: its sign is the total's."""
    carry, digits = F.lit(0).cast("bigint"), []
    for s in reversed(sums[1:]):
        t = s + carry
        digits.append(t.bitwiseAND(F.lit((1 << BITS) - 1)))
        carry = F.shiftright(t, BITS)
    top = sums[0] + carry
    terms = [d * F.lit(float(2.0 ** e)) for d, e in zip([*digits, top], reversed(steps))]
    return reduce(lambda a, b: a + b, terms), top  # from the smallest to the largest


def exact_sum(column: Column | str, low: int = LOW, top: int = TOP) -> Column:
    """An aggregate like ``sum`` of a double column, the same for every order."""
    x = (F.col(column) if isinstance(column, str) else column).cast("double")
    steps = list(range(top - BITS, low - 1, -BITS))  # exponents of the cuts, falling
    limit = F.lit(float(2.0 ** top))
    parts, rest = _parts(F.when(F.abs(x) < limit, x), steps)
    sums = [F.sum(p) for p in parts]
    value, highest = _joined(sums, steps)
    turned, _ = _joined([-s for s in sums], steps)
    exact = F.when(highest < 0, -turned).otherwise(value) + F.coalesce(F.sum(rest), F.lit(0.0))
    return F.when(F.max(F.abs(x)) < limit, exact).otherwise(F.sum(x))


def exact_avg(column: Column | str, low: int = LOW, top: int = TOP) -> Column:
    """An aggregate like ``avg``, the same for every order."""
    x = F.col(column) if isinstance(column, str) else column
    return exact_sum(x, low, top) / F.count(x)


def money_sum(column: Column | str) -> Column:
    """:func:`exact_sum` for amounts: all bits of values between 2 ** -19 (or 0)
    and 2 ** 48, five integer sums."""
    return exact_sum(column, -72, 48)
