"""Latest row per key (top-1 per group) without a window.

``row_number() OVER (PARTITION BY k ORDER BY ts DESC) = 1`` sends every row
of a key to one task; one hot key holding a third of the rows then stalls a
single task.  Here the pick is an aggregate, ``max(struct(order..., payload...))``,
which Spark evaluates partially on the map side: every task reduces its share
of a hot key to one row before the shuffle.  The result is the same row the
window would keep, with ties broken deterministically by the later struct
fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str], *,
                   payload: list[str] | None = None, descending: bool = True,
                   count_as: str | None = None, count_of: str | None = None,
                   extra: list[Column] | None = None,
                   rank_struct: str = "__pick") -> DataFrame:
    """One row per ``keys``: the row first by ``order_by`` then ``payload``.

    ``descending=True`` is ``ORDER BY ... DESC NULLS LAST`` (newest first);
    ``descending=False`` is ``ASC NULLS LAST``.  ``payload`` defaults to all
    other columns, which makes the order total when rows are distinct.
    ``count_as`` adds ``count(count_of)`` over the whole key group (``count(*)``
    when ``count_of`` is None) — the ``COUNT(...) OVER (PARTITION BY k)`` of
    the window form, computed in the same aggregate.  ``extra`` adds further
    named aggregates over the same groups (one shuffle for all of them).
    """
    if payload is None:
        payload = [c for c in df.columns if c not in keys and c not in order_by]
    if descending:
        fields = [F.col(c).alias(c) for c in order_by + payload]
        pick = F.max(F.struct(*fields))
    else:
        # ascending, NULLs last: sort on (is_null, value) pairs with min()
        fields = []
        for c in order_by:
            fields += [F.col(c).isNull().alias(f"__null_{c}"), F.col(c).alias(c)]
        fields += [F.col(c).alias(c) for c in payload]
        pick = F.min(F.struct(*fields))
    aggs: list[Column] = [pick.alias(rank_struct)]
    if count_as:
        aggs.append(F.count(F.col(count_of) if count_of else F.lit(1)).alias(count_as))
    extra = list(extra or [])
    g = df.groupBy(*keys).agg(*aggs, *extra)
    cols = [F.col(k) for k in keys] + [F.col(f"{rank_struct}.{c}").alias(c) for c in order_by + payload]
    if count_as:
        cols.append(F.col(count_as))
    cols += [F.col(c) for c in g.columns[len(keys) + len(aggs):]]
    return g.select(*cols)
