"""Join helpers: lookups proven small and unique, and joins on hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup is broadcast when it is proven to hold at most this many rows and
# characters.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_CHARS = 64 << 20


def mark_validated(df: DataFrame, keys: list[str], rows: int, chars: int = 0, widest: int | None = None) -> DataFrame:
    """Record on the DataFrame object that ``keys`` were proven unique over
    ``rows`` rows of ``chars`` characters in all (seeds validated at load
    time), so later lookups skip the check job; ``widest``: characters of the
    longest cell.  The mark does not survive transformations."""
    df._stratum_validated = (tuple(keys), int(rows), int(chars))
    df._stratum_widest = int(chars if widest is None else widest)
    return df


def widest_cell(df: DataFrame) -> int:
    """Characters of the longest cell of a validated frame, at most."""
    return df._stratum_widest


def validated_size(df: DataFrame, keys: list[str]) -> tuple[int, int] | None:
    mark = getattr(df, "_stratum_validated", None)
    if mark and tuple(keys) == mark[0]:
        return mark[1:]
    return None


def key_stats(df: DataFrame, keys: list[str]) -> tuple[int, int, int]:
    """(rows, largest multiplicity of one key, characters of all cells) in one
    small aggregate job."""
    chars = sum((F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    row = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.sum(chars).alias("chars"))
             .agg(F.sum("count").alias("n"), F.max("count").alias("dup"), F.sum("chars").alias("chars"))
             .first())
    return int(row["n"] or 0), int(row["dup"] or 0), int(row["chars"] or 0)


def small(rows: int, chars: int, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    return rows <= max_rows and chars <= DEFAULT_BROADCAST_CHARS


def checked_lookup(lookup: DataFrame, key: str | list[str],
                   max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Validate a lookup table before it is joined.

    Keys must be unique, otherwise a left join would fan rows out.  The
    table is broadcast when it is proven small; else the planner decides.
    """
    keys = [key] if isinstance(key, str) else list(key)
    n, dup, chars = key_stats(lookup, keys)
    if dup > 1:
        raise ValueError(f"lookup key {keys} is not unique ({dup} rows share one key)")
    return F.broadcast(lookup) if small(n, chars, max_rows) else lookup


def salted_left_join(df: DataFrame, other: DataFrame, key: str, spread_by: str, salts: int = 16) -> DataFrame:
    """LEFT JOIN on a key of which a few values hold much of ``df``.

    ``other`` has one row per key and is an aggregate or small table, of which
    each row is repeated ``salts`` times; ``df`` gets a salt from the column
    ``spread_by``, so a hot key's rows are shared out over ``salts`` tasks
    (the engine cannot split a join whose other side is an aggregate).
    """
    left = df.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    right = other.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return left.join(right, [key, "__salt"], "left").drop("__salt")
