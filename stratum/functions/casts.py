"""Casts and date arithmetic with the warehouse SQL semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: Column | str) -> Column:
    """Integer cast that rounds half to even (3.7 -> 4, 2.5 -> 2), as the SQL
    engine does; Spark's own cast truncates.  Text is read as a number first,
    so ``'3.7'`` gives 4; unparsable text is an error."""
    return F.bround(_c(c).cast("double"), 0).cast("int")


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Calendar days from ``start`` to ``end``: midnights crossed, so
    23:00 -> 01:00 next day is 1 (not ``timestampdiff(DAY)``, which gives 0)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))
