"""Seeds: small typed lookup tables kept next to the models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from stratum.operators.joins import key_stats, mark_validated
from stratum.session import path_exists


@dataclass(frozen=True)
class SeedSpec:
    name: str
    schema: StructType
    key: str

    @property
    def filename(self) -> str:
        return f"{self.name}.csv"


def _s(*cols):
    return StructType([StructField(n, t, True) for n, t in cols])


SEEDS = {s.name: s for s in [
    SeedSpec("brazil_holidays", _s(("holiday_date", DateType()), ("holiday_name", StringType())), "holiday_date"),
    SeedSpec("category_map", _s(("raw_category", StringType()), ("business_area", StringType())), "raw_category"),
    SeedSpec("municipality_map", _s(("locality", StringType()), ("municipality", StringType())), "locality"),
    SeedSpec("typo_cure", _s(("original_city", StringType()), ("fixed_city", StringType())), "original_city"),
    SeedSpec("zip_code_fix", _s(("zip_code_prefix", StringType()), ("city_associated", StringType())),
             "zip_code_prefix"),
]}

# National holidays used to flag days of the date dimension
# (date, name), as shipped with the warehouse.
BRAZIL_HOLIDAYS = [
    ("2016-09-07", "Dia da Independencia"),
    ("2016-10-12", "Nossa Senhora Aparecida"),
    ("2016-11-02", "Finados"),
    ("2016-11-15", "Proclamacao da Republica"),
    ("2016-12-25", "Natal"),
    ("2017-01-01", "Ano Novo"),
    ("2017-04-14", "Sexta-feira Santa"),
    ("2017-04-21", "Dia de Tiradentes"),
    ("2017-05-01", "Dia do Trabalho"),
    ("2017-09-07", "Dia da Independencia"),
    ("2017-10-12", "Nossa Senhora Aparecida"),
    ("2017-11-02", "Finados"),
    ("2017-11-15", "Proclamacao da Republica"),
    ("2017-12-25", "Natal"),
    ("2018-01-01", "Ano Novo"),
    ("2018-03-30", "Sexta-feira Santa"),
    ("2018-04-21", "Dia de Tiradentes"),
    ("2018-05-01", "Dia do Trabalho"),
    ("2018-09-07", "Dia da Independencia"),
    ("2018-10-12", "Nossa Senhora Aparecida"),
]


class SeedError(ValueError):
    pass


def load_seed(spark: SparkSession, spec: SeedSpec, seeds_dir: str | None) -> DataFrame:
    """Read a seed CSV with its declared types and check its key.

    The key must be unique and not NULL (a duplicate would fan out every
    lookup join).  ``brazil_holidays`` falls back to the built-in rows when
    no file is present.
    """
    path = f"{seeds_dir.rstrip('/')}/{spec.filename}" if seeds_dir else None
    if path and path_exists(spark, path):
        df = spark.read.schema(spec.schema).option("header", "true").csv(path)
    elif spec.name == "brazil_holidays":
        df = spark.createDataFrame(BRAZIL_HOLIDAYS, "holiday_date string, holiday_name string") \
                  .select(F.to_date("holiday_date").alias("holiday_date"), "holiday_name")
    else:
        raise FileNotFoundError(f"Missing seed: {path or spec.filename}")
    n, dup, chars = key_stats(df, [spec.key])
    longest = F.greatest(*[F.coalesce(F.max(F.length(F.col(c).cast("string"))), F.lit(0)) for c in df.columns])
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns], longest.alias("__widest")).first().asDict()
    widest = nulls.pop("__widest")
    if dup > 1 or nulls[spec.key]:
        raise SeedError(f"seed {spec.name}: key {spec.key} must be unique and not null")
    empty = sorted(c for c, k in nulls.items() if k)
    if empty:  # a NULL would silently fall through the coalesce of a lookup
        raise SeedError(f"seed {spec.name}: {', '.join(empty)} must not be null")
    return mark_validated(df, [spec.key], n, chars, widest)


def seed_frame(spark: SparkSession, rows: list[tuple], schema: str, key: str) -> DataFrame:
    """A seed given as literal rows: the key is checked on the driver (the
    rows are already there), no Spark job is needed."""
    names = [c.strip().split()[0] for c in schema.split(",")]
    i = names.index(key)
    keys = [r[i] for r in rows]
    if len(set(keys)) != len(keys) or any(k is None for k in keys):
        raise SeedError(f"seed rows: key {key} must be unique and not null")
    cells = [len(str(v)) for r in rows for v in r]
    return mark_validated(spark.createDataFrame(rows, schema), [key], len(rows), sum(cells), max(cells, default=0))
