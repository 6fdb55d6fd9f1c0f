"""Reusable dimension / fact building blocks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.exact import exact_avg


def centroid(df: DataFrame, key: str | list[str], means: Mapping[str, str],
             picks: Mapping[str, str] | None = None, *, count_as: str | None = None, exact: bool = False) -> DataFrame:
    """Per-key averages (``{out: col}``) plus ``max`` picks (``{out: col}``).

    Outliers and digits are kept; ``max`` of a text column is a lexicographic
    pick.  One aggregate, partially evaluated before the shuffle, so a hot key
    is no problem.  ``exact``: means that no order of the rows changes.
    """
    keys = [key] if isinstance(key, str) else list(key)
    aggs: list[Column] = [(exact_avg if exact else F.avg)(F.col(col)).alias(out) for out, col in means.items()]
    for out, col in (picks or {}).items():
        aggs.append(F.max(F.col(col)).alias(out))
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    return df.groupBy(*keys).agg(*aggs)


def rekey(df: DataFrame, mapping: DataFrame, old_key: str, new_key: str,
          mapping_old: str | None = None, mapping_new: str | None = None) -> DataFrame:
    """Foreign-key replacement: swap ``old_key`` for the stable ``new_key``
    through ``mapping`` (inner join: rows without a mapping are dropped)."""
    mo = mapping_old or old_key
    mn = mapping_new or new_key
    m = mapping.select(F.col(mo).alias("__old"), F.col(mn).alias(new_key))
    j = df.join(m, F.col(old_key) == F.col("__old"), "inner").drop("__old")
    cols = [new_key if c == old_key else c for c in df.columns]
    return j.select(*cols)
