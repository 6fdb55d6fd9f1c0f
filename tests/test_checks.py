"""Checks while writing, orphans in one pass, kept uniqueness, shared views."""

import dataclasses
import random
import re

import pytest
from pyspark.sql import functions as F

import fixtures
from stratum.operators import quality
from stratum.operators.quality import (AcceptedRange, NotNull, QualityError, RatioConsistency, Relationships, RowRule,
                                       Unique, evaluate, observed, observed_report, orphan_counts, row_level)
from stratum.plans import runner
from stratum.plans.warehouse import MODEL_INDEX, MODELS
from stratum.sources.config import PipelineConfig


def rows_of(report):
    return sorted(map(tuple, report.collect()), key=str)


def test_observed_checks_equal_evaluate(spark, tmp):
    df = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("a"), (F.col("id") % 11).alias("b"),
                                  (F.col("id") % 3).cast("double").alias("r"))
    checks = [NotNull("nn", "a"), AcceptedRange("rng", "b", min_value=0, max_value=9), RowRule("rule", "b", expr=F.col("a") < F.col("b")),
              NotNull("fine", "b"), NotNull("warns", "a", severity="warn"),
              RatioConsistency("ratio", "r", "a", "b", tolerance=1.0)]
    assert row_level(checks) == checks
    counted, seen = observed(df.repartition(6), checks)
    counted.write.parquet(f"{tmp}/out")
    assert rows_of(observed_report(spark, seen, checks, "t")) == rows_of(evaluate(df, checks, "t"))
    assert observed(df, []) == (df, None)


def test_orphans_equal_anti_joins(spark):
    rng = random.Random(6)

    def keys(n, top):
        return [(rng.choice([None, 1, rng.randint(0, top)]),) for _ in range(n)]
    parent = spark.createDataFrame(keys(80, 60) + [(2,), (2,)], "k bigint")       # repeated and null parent keys
    one = spark.createDataFrame([(a[0], b[0]) for a, b in zip(keys(300, 90), keys(300, 200))], "a bigint, b bigint")
    two = spark.createDataFrame(keys(50, 80), "k int")                            # another width of integer
    children = [("x", one, "a"), ("y", one, "b"), ("z", two, "k"), ("none", two.limit(0), "k")]
    got = {r.child: r.violations for r in orphan_counts(parent, "k", children).collect()}
    assert got == {n: Relationships("r", c, parent=parent, to_column="k").rows(df).count() for n, df, c in children}
    assert got["y"] > got["x"] > 0 and got["none"] == 0
    none = spark.createDataFrame([], "k bigint")
    assert [r.violations for r in orphan_counts(none, "k", [("x", two, "k")]).collect()] == [two.where("k is not null").count()]
    report = evaluate(one, [Relationships("r1", "a", parent=parent, to_column="k"),
                            Relationships("r2", "b", parent=lambda: parent, to_column="k")], "t")
    assert rows_of(report) == sorted([("t", "r1", "a", got["x"], "error"), ("t", "r2", "b", got["y"], "error")], key=str)


def test_orphans_read_the_parent_once_and_combine_first(spark, tmp):
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(f"{tmp}/parent")
    parent = spark.read.parquet(f"{tmp}/parent")
    for i in range(3):
        spark.range(5000).select(F.lit(1).alias("hot"), (F.col("id") % 1100).alias("k")).write.parquet(f"{tmp}/c{i}")
    children = [(f"c{i}", spark.read.parquet(f"{tmp}/c{i}"), "k") for i in range(3)]
    df = orphan_counts(parent, "k", children)
    assert {r.child: r.violations for r in df.collect()} == {f"c{i}": 400 for i in range(3)}
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet", plan)) == 4                        # the parent and each child once
    assert "Join" not in plan
    # rows are counted by key within a task before they are sent
    exchange = plan.index("hashpartitioning(key")
    assert "partial_count" in plan[exchange:]


def test_unique_from_the_kept_state_reads_no_table(spark, tmp):
    kept = spark.createDataFrame([(4, 2)], "id int, n_records bigint")

    class Unread:
        sparkSession = spark
    assert rows_of(evaluate(Unread(), [Unique("u", ["id"])], "t", repeated={("id",): kept})) == [("t", "u", "id", 1, "error")]


# ------------------------------------------------------------- whole builds
@pytest.fixture(scope="module")
def drop(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("drop"))
    paths = fixtures.write_all(base)
    cfg = PipelineConfig(source_base=f"{base}/src", target_base=f"{base}/wh", seeds_dir=paths["seeds"])
    runner.ingest(spark, cfg, paths["marketplace"], paths["state_stats"])
    return cfg


class Watch:
    """What a run evaluates, writes and where its frames come from."""

    def __init__(self, monkeypatch):
        self.evaluated, self.contexts = [], []
        real_eval, real_ctx = quality.evaluate, runner.BuildContext
        watch = self

        def spy(df, checks, table, repeated=None):
            watch.evaluated += [(table, c, repeated) for c in checks]
            return real_eval(df, checks, table, repeated)

        class Context(real_ctx):
            def __init__(self, *a):
                super().__init__(*a)
                watch.contexts.append(self)
        monkeypatch.setattr(runner, "evaluate", spy)
        monkeypatch.setattr(runner, "BuildContext", Context)


def test_a_full_build_computes_views_once_and_counts_while_writing(spark, drop, monkeypatch, tmp):
    watch = Watch(monkeypatch)
    cfg = dataclasses.replace(drop, target_base=f"{tmp}/wh")
    res = runner.run(spark, cfg, gate=False)
    ctx = watch.contexts[0]
    # every view with several consumers was written once, and all read that copy
    assert ctx.shared == runner.shared_views(MODELS, runner.model_graph(spark))
    assert {"slv_stg_market__orders", "slv_int_market__geolocation", "slv_int_market__order_items"} <= ctx.shared
    assert len(ctx.scratch) == len(ctx.shared)
    # row checks of what is written are never evaluated by a scan of their own
    for table, c, _ in watch.evaluated:
        m = MODEL_INDEX.get(table)
        if m and (m.materialized == "table" or table in ctx.shared):
            assert not row_level([c]), (table, c.name)
    # uniqueness of a fact's key comes from the state kept with it
    for name in ("fct_orders", "fct_order_items"):
        assert [r for t, c, r in watch.evaluated if t == name and isinstance(c, Unique)][0]
    # the same report as from plain evaluations over the finished tables
    want = {}
    lazy = runner.BuildContext(spark, cfg, set())     # views anew, over the written tables
    for m in MODELS:
        checks = m.checks(lazy) if m.checks else []
        if checks:
            for r in quality.evaluate(lazy.ref(m.name), checks, m.name).collect():
                want[r.table_name, r.check_name] = (r.column_name, r.violations, r.status)
    got = {(r.table_name, r.check_name): (r.column_name, r.violations, r.status) for r in res.report().collect()
           if not r.table_name.startswith("source.")}
    assert got == want and len(want) > 90
    # scratch copies are gone
    from stratum.session import path_exists
    assert not any(path_exists(spark, p) for p in ctx.scratch)


def test_graph_counts_uses(spark):
    graph = runner.model_graph(spark)
    assert graph["fct_order_items"].models == {"slv_int_market__order_items"}
    assert sorted(graph["fct_order_items"].checks) == ["dim_date", "dim_products", "dim_sellers", "fct_orders"]
    # facts alone, without their checks' views: nothing is computed twice, so nothing is written
    assert runner.shared_views(runner.selection(["incremental"]), graph) == set()
    both = runner.shared_views(runner.selection(["dim_customers", "dim_sellers"]), graph)
    assert both == {"slv_int_market__geolocation"}


def test_checks_against_a_blocked_parent_are_reported_skipped(spark, drop, monkeypatch, tmp):
    skipped = []
    real = runner._publish

    def keep(spark_, cfg_, res, part, rep, gated):
        if rep is not None:
            skipped.extend(r for r in rep.collect() if r.status == "skipped")
        return real(spark_, cfg_, res, part, rep, gated)
    monkeypatch.setattr(runner, "_publish", keep)
    with pytest.raises(QualityError):
        runner.run(spark, dataclasses.replace(drop, target_base=f"{tmp}/wh2"), gate=True)
    got = {(r.table_name, r.check_name): r.violations for r in skipped}
    assert got[("slv_stg_market__order_items", "relationships_order_id_slv_stg_market__orders")] is None


def test_planted_faults_come_from_one_pass_over_the_table(spark, monkeypatch, tmp):
    """The rows of the SQL form, repeated and null keys too, but the table's
    plan stands in the plan once: second copies are no second computation."""
    from stratum.plans import quality_queries

    keys = [f"p{i}" for i in (0, 1, 89, 89, 178, 500)] + [None]
    spark.createDataFrame([(k, "c") for k in keys], "product_id string, category_name string").write.parquet(f"{tmp}/products")
    products = spark.read.parquet(f"{tmp}/products")
    written = []
    monkeypatch.setattr(quality_queries, "observed", lambda df, checks: (written.append(df) or df, None))

    class Plain:
        source = seed = None

        def ref(self, name):
            return products
    ctx = quality_queries._Planted(spark, Plain())
    got = ctx.ref("dim_products")
    want = spark.sql(quality_queries.planted_sql("dim_products", "{rows}", products.columns), rows=products)
    assert rows_of(got) == rows_of(want) and got.count() == len(keys) + 4  # 0, 89 twice and 178 come twice
    assert got.dtypes == want.dtypes
    assert written[0]._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_planted_faults_equal_the_sql_form(spark):
    from stratum.plans import quality_queries

    orders = spark.range(600).selectExpr(
        "concat('o', id) AS order_id", "concat('c', id % 50) AS customer_id", "DATE '1995-01-01' AS order_date_id", "'SHIPPED' AS status",
        "TIMESTAMP_NTZ '1995-02-01 00:00:00' AS delivered_customer_date", "31 AS days_to_deliver", "1.0D AS credit_card_value")
    orders = orders.unionByName(orders.where("order_id = 'o131'")).unionByName(
        orders.limit(1).withColumn("order_id", F.lit(None).cast("string")))
    got = quality_queries.planted(orders, "fct_orders")
    want = spark.sql(quality_queries.planted_sql("fct_orders", "{rows}", orders.columns), rows=orders)
    assert rows_of(got) == rows_of(want) and got.dtypes == want.dtypes
