"""Wide <-> long reshaping: conditional-sum pivot and grouped unpivot."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.exact import exact_sum, money_sum


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pivot_sum(column: Column | str, values: Iterable, then: Column | str, *, suffix: str = "",
              prefix: str = "", else_value=0, where: Column | None = None,
              agg: str = "sum") -> list[Column]:
    """One aggregate column per value: ``sum(CASE WHEN column = v THEN then ELSE 0 END)``.

    Unlike ``GroupedData.pivot`` a group that has rows but none of value ``v``
    gets ``else_value`` (0), not NULL.  ``where`` restricts the rows that
    take part (a fused ``WHERE``): a group with no qualifying row gets NULL
    in every column.  Values are summed as they are, with all their digits;
    ``agg="exact"`` (amounts: ``"money"``) sums them so that no order of the
    rows changes a bit.
    Output names are ``prefix + v + suffix``.
    """
    col, val = _c(column), _c(then)
    out = []
    for v in values:
        e = F.when(col == F.lit(v), val).otherwise(F.lit(else_value))
        if where is not None:
            e = F.when(where, e)
        made = {"exact": exact_sum, "money": money_sum}.get(agg) or getattr(F, agg)
        out.append(made(e).alias(f"{prefix}{v}{suffix}"))
    return out


def unpivot_groups(df: DataFrame, ids: list[str], groups: Mapping[object, Mapping[str, str]],
                   label: str = "year", labels: Iterable | None = None) -> DataFrame:
    """Wide to long where several columns move together per label.

    ``groups = {2017: {"hdi": "hdi_2017", "education_index": "hdi_education_2017"}, ...}``
    gives one row per (ids, label) with columns ``label`` and the group's
    output names.  One pass over ``df`` (``inline`` of an array of structs),
    instead of one scan per label.  ``labels`` keeps only some groups, so a
    later filter on ``label`` does not make every measure be read.
    """
    wanted = list(groups) if labels is None else [g for g in groups if g in set(labels)]
    if not wanted:
        raise ValueError("no unpivot group selected")
    outs = list(groups[wanted[0]])
    for g in wanted:
        if list(groups[g]) != outs:
            raise ValueError(f"group {g!r} has columns {list(groups[g])}, expected {outs}")
    structs = [F.struct(F.lit(g).alias(label), *[F.col(groups[g][o]).alias(o) for o in outs])
               for g in wanted]
    return df.select(*ids, F.inline(F.array(*structs)))
