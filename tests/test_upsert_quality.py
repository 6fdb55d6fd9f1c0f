"""Incremental upsert, quality checks and freshness."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.operators.freshness import FreshnessPolicy, freshness
from stratum.operators.quality import (AcceptedRange, AcceptedValues, MeanConsistency, NotNull, QualityError,
                                       RatioConsistency, Relationships, RowRule, SumConsistency, Tolerance,
                                       Unique, evaluate, gate)
from stratum.operators.upsert import lookback_filter, merge_keyed, upsert_table
from stratum.sources.committed import current, read_table

SCHEMA = "id int, ts date, v string, month string"


def _rows(spark, rows):
    return spark.createDataFrame([(i, d, v, d.strftime("%Y-%m") if d else None) for i, d, v in rows], SCHEMA)


D = dt.date


def test_merge_keyed_deletes_then_inserts(spark):
    t = _rows(spark, [(1, D(2020, 1, 1), "a"), (2, D(2020, 1, 2), "b")])
    b = _rows(spark, [(2, D(2020, 1, 2), "B"), (3, D(2020, 1, 3), "c")])
    got = sorted((r.id, r.v) for r in merge_keyed(t, b, "id").collect())
    assert got == [(1, "a"), (2, "B"), (3, "c")]


def test_lookback_rules(spark):
    t = _rows(spark, [(1, D(2020, 1, 10), "a")])
    src = _rows(spark, [(1, D(2020, 1, 7), "x"), (2, D(2020, 1, 6), "y"), (3, None, "z"), (4, D(2020, 2, 1), "w")])
    kept = sorted(r.id for r in lookback_filter(src, t, "ts", 3).collect())
    assert kept == [1, 4]  # >= max - 3 days; NULL timestamps never pass
    empty = t.limit(0)
    assert lookback_filter(src, empty, "ts", 3).count() == 4  # empty target = first load


@pytest.mark.parametrize("parts", [None, ["month"]])
def test_upsert_table_incremental_equals_full(spark, tmp, parts):
    path = f"{tmp}/fact"
    first = _rows(spark, [(1, D(2020, 1, 10), "a"), (2, D(2020, 1, 30), "b"), (3, D(2020, 2, 1), "c")])
    assert upsert_table(spark, first, path, "id", partition_by=parts)["mode"] == "full"
    # the new full result: id 3 changed inside the window, id 2 moved month
    # and changed, id 1 changed outside the window, id 4 is new
    src = _rows(spark, [(1, D(2020, 1, 10), "A"), (2, D(2020, 2, 2), "B"), (3, D(2020, 2, 1), "C"),
                        (4, D(2020, 2, 3), "d")])
    upsert_table(spark, src, path, "id", ts_col="ts", lookback_days=3, partition_by=parts)
    got = sorted((r.id, r.v, r.ts) for r in read_table(spark, path).collect())
    assert got == [(1, "a", D(2020, 1, 10)), (2, "B", D(2020, 2, 2)), (3, "C", D(2020, 2, 1)),
                   (4, "d", D(2020, 2, 3))]
    upsert_table(spark, src, path, "id", full_refresh=True, partition_by=parts)
    got = sorted((r.id, r.v) for r in read_table(spark, path).collect())
    assert got == [(1, "A"), (2, "B"), (3, "C"), (4, "d")]


def test_row_checks_fused_into_one_scan(spark):
    df = spark.createDataFrame([(1, "x", 0.5), (None, "y", 1.5), (3, None, -0.1)], "a int, b string, c double")
    checks = [NotNull("nn_a", "a"), AcceptedValues("av_b", "b", values=["x"]),
              AcceptedRange("rng_c", "c", min_value=0, max_value=1)]
    rep = evaluate(df, checks, "t")
    got = {r.check_name: (r.violations, r.status) for r in rep.collect()}
    assert got == {"nn_a": (1, "error"), "av_b": (1, "error"), "rng_c": (2, "error")}
    plan = rep._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Scan") == 1


def test_set_checks(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert Unique("u", ["k"]).rows(child).collect()[0].n_records == 2
    assert [r.from_field for r in Relationships("r", "k", parent=parent).rows(child).collect()] == [2]


def test_consistency_checks_and_three_valued_logic(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.5, 0.5, 10, 4, 6, 2.0, 1.0, 0.0),
                                (0.9, 0.1, 0.1, 0.1, 10, 4, 5, 2.0, 1.0, 2.0),
                                (None, 0.1, 0.1, 0.1, None, 1, 1, None, 1.0, 1.0)],
                               "m double, a double, b double, c double, tot int, p int, q int, "
                               "r double, num double, den double")
    rep = evaluate(df, [MeanConsistency("mean", "m", parts=["a", "b", "c"], tolerance=0.1),
                        SumConsistency("sum", "tot", parts=["p", "q"]),
                        RatioConsistency("ratio", "r", "num", "den", tolerance=0.05),
                        Tolerance("tol", "r", expected=F.col("num") * 2, tolerance=0.01),
                        RowRule("rule", "den", expr=F.col("den") > 1)], "t")
    got = {r.check_name: r.violations for r in rep.collect()}
    # ratio: den=0 -> NULL passes; den=2 -> 0.5 vs 2.0 fails; NULL ratio passes
    assert got == {"mean": 1, "sum": 1, "ratio": 1, "tol": 0, "rule": 1}


def test_ratio_with_join(spark):
    m = spark.createDataFrame([("SP", 10, 0.5), ("RJ", 10, 9.0)], "s string, beds int, r double")
    e = spark.createDataFrame([("SP", 200), ("RJ", 100)], "s string, pop int")
    chk = RatioConsistency("ratio", "r", "beds", "pop", scale=10, join_to=e, join_on="s")
    assert [r.ratio for r in chk.rows(m).collect()] == [9.0]
    assert evaluate(m, [chk], "t").first().violations == 1


def test_gate_raises_on_error_only(spark):
    df = spark.createDataFrame([(None,)], "a int")
    with pytest.raises(QualityError):
        gate(evaluate(df, [NotNull("nn", "a")], "t"))
    gate(evaluate(df, [NotNull("nn", "a", severity="warn")], "t"))


def test_freshness_statuses(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30, 23, 0),)], "ts timestamp_ntz")
    pol = FreshnessPolicy(dt.timedelta(hours=24), dt.timedelta(days=2))
    at = lambda t: freshness(df, "s", "ts", t, pol).first().status
    assert at(dt.datetime(2024, 1, 31, 12)) == "pass"
    assert at(dt.datetime(2024, 2, 1, 12)) == "warn"
    assert at(dt.datetime(2024, 2, 3, 12)) == "error"
    assert freshness(df.limit(0), "s", "ts", dt.datetime(2024, 1, 31), pol).first().status == "error"


def test_stream_feeds_upsert(spark, tmp):
    from stratum.streaming.incremental import start_upsert_stream
    src, out = f"{tmp}/landing", f"{tmp}/fact"
    schema = "id int, ts date, v string, month string"
    _rows(spark, [(1, D(2020, 1, 1), "a"), (2, D(2020, 1, 2), "b")]).write.mode("append").parquet(src)
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    q = start_upsert_stream(spark, src, st, out, "id", checkpoint=f"{tmp}/ckpt", order_by=["ts"])
    q.awaitTermination(120)
    # a key twice in one micro-batch: the newest row counts
    _rows(spark, [(2, D(2020, 1, 2), "old"), (2, D(2020, 1, 3), "B"), (3, D(2020, 1, 4), "c")]) \
        .write.mode("append").parquet(src)
    q = start_upsert_stream(spark, src, st, out, "id", checkpoint=f"{tmp}/ckpt", order_by=["ts"])
    q.awaitTermination(120)
    assert sorted((r.id, r.v) for r in read_table(spark, out).collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_removes_emptied_partition_with_odd_names(spark, tmp):
    path = f"{tmp}/odd"
    df = spark.createDataFrame([(1, "a/b:c", "x"), (2, "plain", "y")], "id int, p string, v string")
    upsert_table(spark, df, path, "id", partition_by=["p"])
    moved = spark.createDataFrame([(1, "plain", "x2")], "id int, p string, v string")
    upsert_table(spark, moved, path, "id", partition_by=["p"])
    out = read_table(spark, path)
    assert sorted((r.id, r.p, r.v) for r in out.collect()) == [(1, "plain", "x2"), (2, "plain", "y")]
    assert len(current(spark, path).parts) == 1   # the emptied partition is no part of the table


def test_upsert_leaves_one_row_when_a_key_changes_month(spark, tmp):
    path = f"{tmp}/moving"
    upsert_table(spark, _rows(spark, [(1, D(2018, 1, 5), "a"), (2, D(2018, 1, 6), "b")]), path, "id",
                 partition_by=["month"])
    upsert_table(spark, _rows(spark, [(1, D(2018, 2, 1), "a2")]), path, "id", partition_by=["month"])
    assert sorted((r.id, r.month, r.v) for r in read_table(spark, path).collect()) == \
        [(1, "2018-02", "a2"), (2, "2018-01", "b")]


def test_upsert_empty_batch_is_noop(spark, tmp):
    path = f"{tmp}/t"
    upsert_table(spark, _rows(spark, [(1, D(2020, 1, 1), "a")]), path, "id")
    info = upsert_table(spark, _rows(spark, [(2, D(2019, 1, 1), "old")]), path, "id", ts_col="ts")
    assert info["partitions"] == [] and [r.id for r in read_table(spark, path).collect()] == [1]


def test_partitioned_writes_are_rebalanced(spark):
    from stratum.sources.committed import PART, clustered
    df = spark.range(10).withColumn(PART, F.lit("2020-01"))
    plan = clustered(df, ["m"])._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    assert clustered(df, []) is df


def test_freshness_report_skips_sources_without_policy(spark):
    from stratum.operators.freshness import freshness_report
    df = spark.createDataFrame([(dt.datetime(2024, 1, 30),)], "ts timestamp_ntz")
    rep = freshness_report([("a", df, "ts", FreshnessPolicy()), ("b", df, "ts", None),
                            ("c", df, "ts", FreshnessPolicy(None, None))], dt.datetime(2024, 1, 30, 12))
    assert [(r.source_name, r.status) for r in rep.collect()] == [("a", "pass")]
