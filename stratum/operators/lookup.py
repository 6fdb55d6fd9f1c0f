"""Lookup-based correction of values (``coalesce(lookup.fixed, value)``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.text import normalize_name
from stratum.operators.joins import (DEFAULT_BROADCAST_ROWS, checked_lookup, mark_validated, small, validated_size,
                                     widest_cell)


def lookup_override(df: DataFrame, target: str, lookup: DataFrame, key: str, value: str,
                    match: str | None = None, out: str | None = None,
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    checked: bool = True) -> DataFrame:
    """Replace ``target`` by ``lookup.value`` where ``df[match] == lookup.key``.

    ``match`` defaults to ``target`` itself.  Rows without a match keep their
    value; NULL never matches.  The lookup must be unique on ``key`` (checked
    here with one small job, unless it was validated at load time, see
    :func:`stratum.operators.joins.mark_validated`) and is broadcast within
    ``max_broadcast_rows``, so the big side is never shuffled.
    """
    match = match or target
    out = out or target
    lk = lookup.select(F.col(key).alias("__lk_key"), F.col(value).alias("__lk_val"))
    known = validated_size(lookup, [key])
    if known is not None:
        lk = F.broadcast(lk) if small(*known, max_broadcast_rows) else lk
    elif checked:
        lk = checked_lookup(lk, "__lk_key", max_broadcast_rows)
    joined = df.join(lk, F.col(match) == F.col("__lk_key"), "left")
    return (joined.withColumn(out, F.coalesce(F.col("__lk_val"), F.col(target)))
                  .drop("__lk_key", "__lk_val"))


def correct_names(df: DataFrame, name: str, zip_col: str, typo: DataFrame, zip_fix: DataFrame,
                  municipality: DataFrame, out: str = "city", *,
                  typo_key: str = "original_city", typo_value: str = "fixed_city",
                  zip_key: str = "zip_code_prefix", zip_value: str = "city_associated",
                  muni_key: str = "locality", muni_value: str = "municipality",
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Name-correction cascade, single pass, fixed order:

    1. standardise the name (strip accents, keep ``[A-Z0-9 ]``),
    2. typo map on the standardised name,
    3. postcode map: an absolute rule that wins over step 2,
    4. locality -> municipality on the result of step 3.

    Lookups are not scoped by state; each step sees the previous result.  The
    municipality map is composed into the other two before any row is read
    (:func:`composed`), so a row meets two broadcast joins, and no shuffle.
    """
    names, places = composed(typo, zip_fix, municipality, typo_key, typo_value, zip_key, zip_value, muni_key, muni_value)
    df = df.withColumn(out, normalize_name(F.col(name)))
    df = lookup_override(df, out, names, "name", "final", max_broadcast_rows=max_broadcast_rows)
    return lookup_override(df, out, places, "place", "final", match=zip_col, max_broadcast_rows=max_broadcast_rows)


def composed(typo: DataFrame, zip_fix: DataFrame, municipality: DataFrame, typo_key: str, typo_value: str, zip_key: str,
             zip_value: str, muni_key: str, muni_value: str) -> tuple[DataFrame, DataFrame]:
    """The cascade as two maps: (``name``, ``final``) of standardised names, the
    typo map followed by the municipality map, and (``place``, ``final``) of
    postcodes, followed by the municipality map.

    A name is a typo, whose correction may be a locality, or else a locality
    itself; so the composed keys are those of the typo map and the other
    localities, and are unique where the maps are."""
    m = municipality.select(F.col(muni_key).alias("locality"), F.col(muni_value).alias("town"))

    def then_town(lookup: DataFrame, key: str, value: str, name: str) -> DataFrame:
        own = lookup.select(F.col(key).alias(name), F.col(value).alias("value"))
        return own.join(m, F.col("value") == F.col("locality"), "left") \
            .select(name, F.coalesce("town", "value").alias("final"))
    typos = typo.select(F.col(typo_key).alias("typo"))
    others = m.join(typos, F.col("locality") == F.col("typo"), "left_anti").select(F.col("locality").alias("name"),
                                                                                   F.col("town").alias("final"))
    names = then_town(typo, typo_key, typo_value, "name").unionByName(others)
    places = then_town(zip_fix, zip_key, zip_value, "place")
    known = [validated_size(df, [k]) for df, k in ((typo, typo_key), (zip_fix, zip_key), (municipality, muni_key))]
    if all(known):  # unique maps compose to unique ones; a composed cell is a cell of one of the maps
        (n_typo, typo_chars), (n_zip, zip_chars), (n_muni, muni_chars) = known
        town = widest_cell(municipality)
        mark_validated(names, ["name"], n_typo + n_muni, typo_chars + muni_chars + n_typo * town)
        mark_validated(places, ["place"], n_zip, zip_chars + n_zip * town)
    return names, places
