"""Session/partitioning/seed helpers and the lazy warehouse on derived sources."""

import os

import pytest

from stratum.session import _qualify, checkpoint_root, path_exists, scratch_path
from stratum.sources.committed import current, part_id, read_table
from stratum.sources.seeds import SeedError, seed_frame

SF = "/root/testdata/sf0.001"


def test_path_qualification(spark, tmp):
    assert _qualify("file:/x/y") == "file:/x/y" and _qualify("s3a://b/k") == "s3a://b/k"
    assert _qualify("rel/dir") == os.path.abspath("rel/dir")
    assert path_exists(spark, "file:" + tmp) and not path_exists(spark, tmp + "/missing")


def test_scratch_under_checkpoint_root(spark):
    root = checkpoint_root(spark)
    assert scratch_path(spark, "x").startswith(root + "/x-")


def test_partition_ids_tell_values_and_nulls_apart(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "a"), (None, None), (1, "a")], "y int, k string")
    ids = df.select("y", "k", part_id(["y", "k"]).alias("p")).collect()
    assert len({r.p for r in ids}) == 5 and ids[0].p == ids[5].p
    assert {r[0] for r in df.select(part_id([])).collect()} == {"all"}


def test_seed_frame_checks_key(spark):
    df = seed_frame(spark, [("a", "1"), ("b", "2")], "k string, v string", "k")
    assert df._stratum_validated == (("k",), 2, 4)
    with pytest.raises(SeedError):
        seed_frame(spark, [("a", "1"), ("a", "2")], "k string, v string", "k")
    with pytest.raises(SeedError):
        seed_frame(spark, [(None, "1")], "k string, v string", "k")


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_lazy_warehouse_resolves_every_model(spark):
    from stratum.plans.warehouse import MODELS
    from stratum.plans.warehouse_queries import lazy_warehouse
    ctx = lazy_warehouse(spark, SF)
    for m in MODELS:
        df = ctx.ref(m.name)
        assert df.columns, m.name
    assert ctx.ref("fct_orders").count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    plan = ctx.ref("dim_customers")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_warehouse_build_on_derived_sources(spark, tmp):
    from stratum.plans import runner
    from stratum.plans.marketplace_views import materialize
    from stratum.sources.config import PipelineConfig
    cfg = PipelineConfig(source_base=f"{tmp}/src", target_base=f"{tmp}/wh", seeds_dir=f"{tmp}/seeds")
    materialize(spark, SF, cfg)
    res = runner.run(spark, cfg, gate=False)
    assert len(res.built) == 45 and set(res.seconds) == set(res.built)
    facts = read_table(spark, cfg.model_path("gold", "fct_orders"))
    assert "order_month" in facts.columns                      # layout column on disk
    n_before = facts.count()
    # clustered partitioned write: few files per month partition, not one per task
    fact_dir = cfg.model_path("gold", "fct_orders")
    per_part = [len([f for f in os.listdir(d) if f.endswith(".parquet")])
                for d in current(spark, fact_dir).folders(fact_dir)]
    assert len(per_part) == facts.select("order_month").distinct().count() and max(per_part) <= 2
    again = runner.run(spark, cfg, select=["fct_orders", "fct_order_items"], gate=False)
    assert again.incremental["fct_orders"]["mode"] == "incremental"
    after = read_table(spark, cfg.model_path("gold", "fct_orders"))
    assert after.count() == n_before
    assert after.groupBy("order_id").count().filter("count > 1").count() == 0
