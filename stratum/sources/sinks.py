"""Layered table sinks: ``{target_base}/{layer}/{model}`` folders."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stratum.sources.committed import replace_table


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full replace of a table (snapshot materialisation): all of its new rows
    count at once, and until then the old ones do."""
    replace_table(df, path, partition_by)
