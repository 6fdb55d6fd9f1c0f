"""Scalar functions: SQL-engine parity for trim/upper/lower/accents/casts/keys."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from stratum.functions import casts, keys, text

SAMPLES = ["  São Paulo ", " x ", "D'OESTE", "A-B", "straße", "ﬀ ligature", "ǰ", "Ação 𝔸b ç😀d",
           "\tkeep tabs\n", "İstanbul", "ÉCOLE", "é", "　wide　", None]


def _duck(sql, vals):
    con = duckdb.connect()
    return [con.execute(sql, [v]).fetchone()[0] for v in vals]


def _spark(spark, col_fn, vals):
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    return [r[0] for r in df.select(col_fn(F.col("s"))).collect()]


@pytest.mark.parametrize("fn,sql", [
    (text.trim_spaces, "SELECT trim(?)"),
    (text.upper_simple, "SELECT upper(?)"),
    (text.lower_simple, "SELECT lower(?)"),
    (text.strip_accents, "SELECT strip_accents(?)"),
    (text.clean_upper, "SELECT upper(trim(?))"),
    (text.normalize_text, "SELECT regexp_replace(strip_accents(upper(trim(?))), '[^A-Z0-9 ]', '', 'g')"),
    (text.normalize_name, "SELECT regexp_replace(strip_accents(?), '[^A-Z0-9 ]', '', 'g')"),
])
def test_text_matches_sql_engine(spark, fn, sql):
    assert _spark(spark, fn, SAMPLES) == _duck(sql, SAMPLES)


def test_normalize_deletes_not_spaces(spark):
    out = _spark(spark, text.normalize_name, ["D'OESTE", "A-B", "SÃO"])
    assert out == ["DOESTE", "AB", "SAO"]


def test_trim_unicode_spaces_only(spark):
    assert _spark(spark, text.trim_spaces, [" x ", "\tx\n"]) == ["x", "\tx\n"]


def test_sharp_s_is_not_expanded(spark):
    assert _spark(spark, text.upper_simple, ["straße"]) == ["STRAẞE"]
    assert _spark(spark, text.normalize_text, ["straße"]) == ["STRAE"]


def test_accent_map_is_rule_built():
    matching, replace = text.accent_map()
    assert "é" in matching and len(matching) > len(replace) > 400


def test_rounding_int_cast(spark):
    df = spark.createDataFrame([(3.7,), (2.5,), (3.5,), (-2.5,), (None,)], "x double")
    assert [r[0] for r in df.select(casts.to_int("x")).collect()] == [4, 2, 4, -2, None]
    assert spark.createDataFrame([("3.7",)], "s string").select(casts.to_int("s")).first()[0] == 4
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):  # as in the SQL engine
        spark.createDataFrame([("x",)], "s string").select(casts.to_int("s")).collect()


def test_day_diff_counts_midnights(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 2, 1, 23), dt.datetime(2017, 2, 2, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(casts.day_diff("a", "b")).first()[0] == 1


def test_surrogate_key_matches_sql(spark):
    rows = [("a", 1), (None, 2), ("c", None)]
    df = spark.createDataFrame(rows, "k string, n int")
    got = [r[0] for r in df.select(keys.surrogate_key("k", "n")).collect()]
    con = duckdb.connect()
    tok = keys.NULL_TOKEN
    want = [con.execute(
        "SELECT md5(coalesce(CAST(? AS VARCHAR), ?) || '-' || coalesce(CAST(? AS VARCHAR), ?))",
        [k, tok, n, tok]).fetchone()[0] for k, n in rows]
    assert got == want


def test_ascii_takes_no_map_and_gives_the_same(spark):
    """Plain ASCII goes past the character maps; every such character, and one
    that is not, gives what the maps give."""
    vals = [f"{pad}{chr(i)}{mid}{chr(i)}{pad}" for i in range(1, 128) for pad in ("", " ", "  ") for mid in ("aZ 9", "é")]
    vals += ["", " ", "   ", "\u00a0", " \u3000 ", None]
    c = F.col("s")
    trimmed = text._trim_any(c)
    fold, to = text._fold_and_delete(True)
    pairs = [(text.trim_spaces(c), trimmed), (text.upper_simple(c), text._case_any(c, "upper")),
             (text.lower_simple(c), text._case_any(c, "lower")), (text.clean_upper(c), text._case_any(trimmed, "upper")),
             (text.clean_lower(c), text._case_any(trimmed, "lower")),
             (text.normalize_name(c), text.keep_upper_alnum(text.strip_accents(c))),
             (text.normalize_text(c), text.keep_upper_alnum(F.translate(trimmed, fold, to)))]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    wrong = df.where(F.lit(False))
    for fast, full in pairs:
        wrong = wrong.union(df.where(~fast.eqNullSafe(full)))
    assert wrong.collect() == []
    plan = df.select(text.clean_upper(c))._jdf.queryExecution().analyzed().toString()
    assert "octet_length" in plan
