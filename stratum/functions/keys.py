"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the warehouse's key macro for keys to match:
# the token that stands in for a NULL part, and the separator between parts.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*cols: Column | str) -> Column:
    """md5 hex of the ``-``-joined text casts of ``cols``; NULL parts become
    :data:`NULL_TOKEN`.  Keep to string and integer parts: engines print
    doubles and timestamps differently."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TOKEN))
             for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))
