"""Raw ingestion: typed CSV -> parquet, one idempotent replace per table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from stratum.session import path_exists
from stratum.sources.committed import read_table, replace_table
from stratum.sources.config import PipelineConfig
from stratum.sources.specs import SourceSpec


def read_csv(spark: SparkSession, path: str, spec: SourceSpec) -> DataFrame:
    """Read one CSV with the declared schema (header row, no inference).

    Cells are read as text and cast, so a cell that its type cannot hold
    fails the load with its value; an empty cell is NULL.  Timestamps may be a
    date, have a blank or a ``T`` before the time, and fractions of a second.
    Files are split over tasks; only a source that declares ``multiLine`` (line
    breaks inside quoted cells) is read whole per file.
    """
    text = StructType([StructField(f.name, StringType()) for f in spec.schema.fields])
    opts = {"header": "true", "mode": "FAILFAST", "escape": '"', **spec.options}
    raw = spark.read.schema(text).options(**opts).csv(path)
    return raw.select(*[raw[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in spec.schema.fields])


def load_csvs(spark: SparkSession, cfg: PipelineConfig, raw_dir: str,
              specs: Iterable[SourceSpec], filenames: dict[str, str] | None = None) -> list[str]:
    """Load every spec's CSV from ``raw_dir`` into ``{source_base}/{namespace}/{name}``.

    ``filenames`` maps logical table names to the file names of the drop
    (default: the spec's ``{name}.csv``).  All files are checked first; a
    missing one raises ``FileNotFoundError`` before anything is written.
    Each table is replaced as a whole: a load that fails leaves its old rows.
    """
    specs = list(specs)
    names = filenames or {}
    paths = {s.name: f"{raw_dir.rstrip('/')}/{names.get(s.name, s.filename)}" for s in specs}
    for s in specs:
        if not path_exists(spark, paths[s.name]):
            raise FileNotFoundError(f"Missing file: {paths[s.name]}")
    done = []
    for s in specs:
        out = cfg.source_path(s.namespace, s.name)
        replace_table(read_csv(spark, paths[s.name], s), out)
        done.append(out)
    return done


def read_source(spark: SparkSession, cfg: PipelineConfig, spec: SourceSpec) -> DataFrame:
    """A declared source, as loaded by :func:`load_csvs` or as plain parquet files."""
    return read_table(spark, cfg.source_path(spec.namespace, spec.name))


def mirror(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Bronze 1:1 copy with the declared column list (nothing else leaks in)."""
    return df.select(*[df[f"`{c}`"] for c in spec.columns])
