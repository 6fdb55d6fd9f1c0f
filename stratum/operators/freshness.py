"""Source freshness: how old is the newest row?"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FreshnessPolicy:
    """Warn when the newest row is older than ``warn_after``, error when older
    than ``error_after``.  ``None`` for both means the source is not checked."""
    warn_after: dt.timedelta | None = dt.timedelta(hours=24)
    error_after: dt.timedelta | None = dt.timedelta(days=2)


def _ts_literal(t: dt.datetime, ntz: bool) -> Column:
    lit = F.lit(t.isoformat(sep=" "))
    return lit.cast("timestamp_ntz") if ntz else lit.cast("timestamp")


def freshness(df: DataFrame, source: str, loaded_at: str, as_of: dt.datetime,
              policy: FreshnessPolicy = FreshnessPolicy()) -> DataFrame:
    """One row ``(source_name, max_loaded_at, status)`` with status ``pass`` /
    ``warn`` / ``error`` (``error`` also when the source is empty).  ``as_of``
    is a parameter, so results are reproducible."""
    ntz = dict(df.dtypes)[loaded_at] == "timestamp_ntz"
    m = F.col("max_loaded_at")
    status = F.when(m.isNull(), F.lit("error"))
    if policy.error_after is not None:
        status = status.when(m < _ts_literal(as_of - policy.error_after, ntz), F.lit("error"))
    if policy.warn_after is not None:
        status = status.when(m < _ts_literal(as_of - policy.warn_after, ntz), F.lit("warn"))
    status = status.otherwise(F.lit("pass"))
    return (df.agg(F.max(F.col(loaded_at)).alias("max_loaded_at"))
              .select(F.lit(source).alias("source_name"), "max_loaded_at", status.alias("status")))


def freshness_report(sources: list[tuple[str, DataFrame, str, FreshnessPolicy | None]],
                     as_of: dt.datetime) -> DataFrame | None:
    """Union of :func:`freshness` over the sources that have a policy."""
    out = None
    for name, df, col, pol in sources:
        if pol is None or (pol.warn_after is None and pol.error_after is None):
            continue
        f = freshness(df, name, col, as_of, pol)
        out = f if out is None else out.unionByName(f)
    return out
