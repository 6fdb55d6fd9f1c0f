"""A key holding a third of all rows: results stay exact, work stays partial."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators.latest import latest_per_key
from stratum.operators.quality import Unique
from stratum.operators.reshape import pivot_sum

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def skewed(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    # every line whose number is <= 2 moves to order 0: about a third of rows
    return li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 2, F.lit(0)).otherwise(F.col("l_orderkey")))


def test_hot_key_share(skewed):
    n = skewed.count()
    hot = skewed.filter("l_orderkey = 0").count()
    assert hot * 4 > n


def test_latest_exact_under_skew(skewed):
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    got = latest_per_key(skewed, ["l_orderkey"], order, payload=["l_discount", "l_tax", "l_returnflag",
                                                                 "l_linestatus"], count_as="n")
    w = Window.partitionBy("l_orderkey").orderBy(*[F.col(c).desc_nulls_last() for c in
                                                   order + ["l_discount", "l_tax", "l_returnflag", "l_linestatus"]])
    ref = (skewed.withColumn("rn", F.row_number().over(w))
                 .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("l_orderkey")))
                 .filter("rn = 1").drop("rn"))
    cols = got.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.select(*cols).collect()))


def test_pivot_and_unique_exact_under_skew(skewed):
    agg = skewed.groupBy("l_orderkey").agg(
        *pivot_sum("l_returnflag", ["A", "N", "R"], "l_extendedprice", suffix="_v"),
        F.sum("l_extendedprice").alias("t"))
    hot = agg.filter("l_orderkey = 0").first()
    assert abs(hot.A_v + hot.N_v + hot.R_v - hot.t) < 1e-4
    u = Unique("u", ["l_orderkey"]).rows(skewed).filter("l_orderkey = 0").first()
    assert u.n_records == skewed.filter("l_orderkey = 0").count()
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan  # map-side combine before the shuffle
