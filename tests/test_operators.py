"""Lookup cascade, reshape, latest-per-key, calendar."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators.calendar import date_dimension
from stratum.operators.joins import checked_lookup, salted_left_join, small
from stratum.operators.latest import latest_per_key
from stratum.operators.lookup import correct_names, lookup_override
from stratum.operators.reshape import pivot_sum, unpivot_groups
from stratum.operators.star import centroid, rekey


def _seed(spark, rows, cols):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_cascade_order_and_chain(spark):
    df = spark.createDataFrame([("LAGES SC", "1"), ("ABC", "01307"), ("D'OESTE", "9"), ("X", "2")],
                               "city string, zip string")
    typo = _seed(spark, [("LAGES SC", "LAGES"), ("D'OESTE", "NEVER")], ["original_city", "fixed_city"])
    zips = _seed(spark, [("01307", "PARAISO"), ("2", "IDENT")], ["zip_code_prefix", "city_associated"])
    muni = _seed(spark, [("LAGES", "MARANGUAPE"), ("PARAISO", "SAO PAULO"), ("IDENT", "IDENT")],
                 ["locality", "municipality"])
    out = correct_names(df, "city", "zip", typo, zips, muni, out="fixed")
    got = {r.zip: r.fixed for r in out.collect()}
    assert got == {"1": "MARANGUAPE", "01307": "SAO PAULO", "9": "DOESTE", "2": "IDENT"}


def test_lookup_rejects_duplicate_keys(spark):
    df = spark.createDataFrame([("A",)], "c string")
    lk = _seed(spark, [("A", "x"), ("A", "y")], ["k", "v"])
    with pytest.raises(ValueError):
        lookup_override(df, "c", lk, "k", "v")


def test_lookup_is_broadcast(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("c"))
    lk = _seed(spark, [("1", "one")], ["k", "v"])
    plan = lookup_override(df, "c", lk, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_lookup_broadcast_is_bound_by_rows_and_bytes(spark):
    df = spark.range(10)
    logical = lambda d: d._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" in logical(checked_lookup(df, "id", 100))
    assert "broadcast" not in logical(checked_lookup(df, "id", 5))
    assert small(10, 1000) and not small(10, 1 << 30)
    with pytest.raises(ValueError):
        checked_lookup(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_salted_join_shares_out_a_hot_key(spark):
    # a third of all rows have one postcode
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("z"), (F.col("id") % 50).cast("string"))).alias("zip"))
    other = df.groupBy("zip").agg(F.count("*").alias("n")).where("zip <> 'z1'")
    got = salted_left_join(df, other, "zip", spread_by="id")
    assert sorted(map(tuple, got.select("id", "zip", "n").collect())) == \
        sorted(map(tuple, df.join(other, "zip", "left").select("id", "zip", "n").collect()))
    salts = df.withColumn("s", F.pmod(F.xxhash64("id"), F.lit(16))).where("zip = 'hot'").groupBy("s").count()
    assert salts.count() == 16 and salts.agg(F.max("count")).first()[0] < 150


def test_sums_keep_all_digits(spark):
    df = spark.createDataFrame([("a", 0.004)] * 3, "k string, v double")
    r = df.groupBy("k").agg(*pivot_sum("k", ["a"], "v")).first()
    assert r.a == pytest.approx(0.012, abs=1e-15)
    pts = spark.createDataFrame([("1", -23.545851204094), ("1", -23.545851204094212)], "z string, lat double")
    assert centroid(pts, "z", {"m": "lat"}).first().m == pytest.approx(-23.545851204094106, abs=1e-13)


def test_pivot_zero_vs_null(spark):
    rows = [("o1", "credit_card", 10.0), ("o1", "boleto", 5.5), ("o2", "not_defined", 3.0), ("o3", "paypal", 7.0)]
    df = spark.createDataFrame(rows, "o string, t string, v double")
    keep = F.col("t") != "not_defined"
    out = df.groupBy("o").agg(*pivot_sum("t", ["credit_card", "boleto"], "v", suffix="_value", where=keep),
                              F.sum(F.when(keep, F.col("v"))).alias("total"))
    got = {r.o: (r.credit_card_value, r.boleto_value, r.total) for r in out.collect()}
    assert got == {"o1": (10.0, 5.5, 15.5), "o2": (None, None, None), "o3": (0.0, 0.0, 7.0)}


def test_unpivot_groups_and_pruning(spark, tmp):
    spark.createDataFrame([("SP", 0.8, 0.7, 0.6, 0.5)], "s string, a17 double, b17 double, a10 double, b10 double") \
        .write.parquet(f"{tmp}/wide")
    df = spark.read.parquet(f"{tmp}/wide")
    groups = {2017: {"a": "a17", "b": "b17"}, 2010: {"a": "a10", "b": "b10"}}
    long = unpivot_groups(df, ["s"], groups, label="year")
    assert sorted(tuple(r) for r in long.collect()) == [("SP", 2010, 0.6, 0.5), ("SP", 2017, 0.8, 0.7)]
    pruned = unpivot_groups(df, ["s"], groups, label="year", labels=[2017])
    assert [tuple(r) for r in pruned.collect()] == [("SP", 2017, 0.8, 0.7)]
    scan = [ln for ln in pruned._jdf.queryExecution().executedPlan().toString().splitlines() if "ReadSchema" in ln]
    assert scan and "a10" not in scan[0] and "a17" in scan[0]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 1000)),
                min_size=1, max_size=40, unique_by=lambda t: t[2]))
def test_latest_per_key_equals_window(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, id int")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["ts", "id"], count_as="n").collect())
    w = Window.partitionBy("k").orderBy(F.col("ts").desc_nulls_last(), F.col("id").desc_nulls_last())
    ref = (df.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k")))
             .filter("rn = 1").select("k", "ts", "id", "n"))
    assert got == sorted(tuple(r) for r in ref.collect())


def test_latest_ascending_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 3, "c")], "k int, ts int, v string")
    r = latest_per_key(df, ["k"], ["ts"], payload=["v"], descending=False).first()
    assert (r.ts, r.v) == (3, "c")


def test_latest_is_an_aggregate_not_a_window(spark):
    df = spark.createDataFrame([(1, 2, "a")], "k int, ts int, v string")
    plan = latest_per_key(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan


def test_calendar_end_exclusive_and_parts(spark):
    hol = spark.createDataFrame([(dt.date(2016, 9, 7),)], "holiday_date date")
    d = date_dimension(spark, "2016-09-01", "2020-05-01", holidays=hol, flag="is_holiday_brazil")
    assert d.count() == 1338
    r = d.filter(F.col("date_id") == dt.date(2016, 9, 7)).first()
    assert (r.year, r.quarter, r.month, r.month_name, r.day_of_week, r.day_of_week_name, r.is_weekend,
            r.is_holiday_brazil) == (2016, 3, 9, "September", 3, "Wednesday", False, True)
    assert d.agg(F.max("date_id")).first()[0] == dt.date(2020, 4, 30)
    assert d.filter("is_holiday_brazil").count() == 1


def test_centroid_and_rekey(spark):
    pts = spark.createDataFrame([("01", -23.5, "B"), ("01", -23.7, "A"), ("02", 1.0, "C")], "z string, lat double, c string")
    g = {r.z: (round(r.m, 9), r.c) for r in centroid(pts, "z", {"m": "lat"}, {"c": "c"}).collect()}
    assert g == {"01": (-23.6, "B"), "02": (1.0, "C")}
    o = spark.createDataFrame([("o1", "b1"), ("o2", "b9")], "order_id string, basket string")
    m = spark.createDataFrame([("b1", "u1")], "basket string, customer string")
    assert [tuple(r) for r in rekey(o, m, "basket", "customer").collect()] == [("o1", "u1")]


def test_composed_cascade_equals_its_steps(spark):
    """Two joins against composed maps give what three joins in a row give, on
    chains, misses, nulls and keys that several maps share."""
    import random

    from stratum.functions.text import normalize_name
    from stratum.operators.lookup import composed, correct_names, lookup_override
    from stratum.sources.seeds import seed_frame
    rng = random.Random(12)
    names = [f"N{i}" for i in range(40)]
    typo = seed_frame(spark, [(n, rng.choice(names)) for n in rng.sample(names, 18)], "original_city string, fixed_city string",
                      "original_city")
    zips = seed_frame(spark, [(str(i), rng.choice([*names, "ELSEWHERE"])) for i in range(6)],
                      "zip_code_prefix string, city_associated string", "zip_code_prefix")
    muni = seed_frame(spark, [(n, rng.choice([*names, n])) for n in rng.sample(names, 20)], "locality string, municipality string",
                      "locality")
    df = spark.createDataFrame([(i, rng.choice([*names, "n3", " N7 ", None]), rng.choice([None, *map(str, range(12))]))
                                for i in range(600)], "id int, name string, zip string")
    steps = df.withColumn("city", normalize_name(F.col("name")))
    steps = lookup_override(steps, "city", typo, "original_city", "fixed_city")
    steps = lookup_override(steps, "city", zips, "zip_code_prefix", "city_associated", match="zip")
    steps = lookup_override(steps, "city", muni, "locality", "municipality")
    once = correct_names(df, "name", "zip", typo, zips, muni)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, steps.collect()), key=str)
    # both maps are proven small and unique, so no job checks them, and they are broadcast
    maps = composed(typo, zips, muni, "original_city", "fixed_city", "zip_code_prefix", "city_associated", "locality",
                    "municipality")
    for m, key in zip(maps, ("name", "place")):
        (_,), rows, chars = m._stratum_validated
        got = m.collect()
        assert len({r[0] for r in got}) == len(got) <= rows and sum(len(v) for r in got for v in r) <= chars
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rightHint=(strategy=broadcast)") == 2
