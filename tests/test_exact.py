"""Sums that are the same for every order of the rows."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stratum.functions.exact import exact_avg, exact_sum
from stratum.operators.reshape import pivot_sum
from stratum.operators.star import centroid


def total(spark, values, parts=1):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(exact_sum("x").alias("s")).first().s


def test_no_order_changes_a_bit(spark):
    rng = random.Random(17)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-9, 12) for _ in range(4000)] + [0.1, 0.2, 0.3, -1e12]
    plain, exact = set(), set()
    for seed in range(6):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(1 + 2 * seed)
        got = df.agg(F.sum("x").alias("p"), exact_sum("x").alias("e"), exact_avg("x").alias("m")).first()
        plain.add(got.p)
        exact.add((got.e, got.m))
    assert len(plain) > 1 and len(exact) == 1
    assert next(iter(exact))[0] == pytest.approx(math.fsum(values), rel=4e-16)


@pytest.mark.parametrize("values", [
    [1e16, 1.0, -1e16], [1.0, 1e-20, -1.0], [-0.1] * 10, [0.1] * 10, [3.0], [-2.5, 2.5], [2.0 ** 90, 2.0 ** -100, -2.0 ** 90],
    [-1e-7, 1e9, -1e9], [1 / 3, 2 / 3, -1.0], [5e-324, 5e-324]])
def test_value_is_the_rounded_sum(spark, values):
    want = float(sum(map(Fraction, values)))
    got = total(spark, values, 2)
    assert got == want or abs(got - want) <= math.ulp(want)


def test_defined_cases(spark):
    assert total(spark, [None, None]) is None and total(spark, []) is None
    assert total(spark, [1.5, None, 2.0]) == 3.5
    assert math.isnan(total(spark, [1.0, float("nan")])) and total(spark, [float("inf"), 1.0]) == float("inf")
    assert total(spark, [1e300, 1e300]) == 2e300


def test_groups_merge_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") / 7).alias("x"))
    out = df.groupBy("k").agg(exact_sum("x").alias("s"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "partial_sum" in plan
    for r in out.collect():
        assert r.s == pytest.approx(math.fsum(i / 7 for i in range(1000) if i % 3 == r.k), rel=4e-16)


def test_pivots_and_centroids_use_it(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice("xy"), rng.uniform(0, 1e6), rng.uniform(-90, 90)) for _ in range(3000)]
    seen = set()
    for n in (1, 5, 9):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, t string, v double, g double").repartition(n)
        a = df.groupBy("k").agg(*pivot_sum("t", ["x", "y"], "v", suffix="_value", agg="money")).orderBy("k").collect()
        b = centroid(df, "k", {"g_mean": "g"}, exact=True).orderBy("k").collect()
        seen.add((tuple(map(tuple, a)), tuple(map(tuple, b))))
    assert len(seen) == 1
