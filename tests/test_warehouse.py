"""The layered warehouse on fixture CSVs: build, checks, gating, incremental."""

import csv
import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

import fixtures
from stratum.operators.quality import QualityError
from stratum.plans import runner
from stratum.plans.warehouse import MODELS
from stratum.sources.committed import read_table
from stratum.sources.config import PipelineConfig, resolve_target


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("wh"))
    paths = fixtures.write_all(base)
    cfg = PipelineConfig(source_base=f"{base}/src", target_base=f"{base}/wh", seeds_dir=paths["seeds"])
    runner.ingest(spark, cfg, paths["marketplace"], paths["state_stats"])
    res = runner.run(spark, cfg, gate=False)
    return spark, cfg, res, paths, base


def gold(spark, cfg, name):
    return {tuple(r)[0]: r for r in read_table(spark, cfg.model_path("gold", name)).collect()}


def test_model_count():
    layers = [m.layer for m in MODELS]
    assert len(MODELS) == 45 and layers.count("bronze") == 13 and layers.count("gold") == 8


def test_customers_dimension(built):
    spark, cfg, *_ = built
    c = gold(spark, cfg, "dim_customers")
    # newest of three records (two orders at the same instant, one later)
    assert (c["u1"].zip_code_prefix, c["u1"].city, c["u1"].total_orders) == ("12345", "DOESTE", 3)
    assert c["u2"].city == "ALTA FLORESTA D OESTE"       # typo seed
    assert c["u3"].city == "MARANGUAPE"                  # typo -> municipality chain
    assert c["u4"].city == "STRAE"                       # sharp s: simple case mapping
    assert c["u5"].city == "CAMACARI"                    # NBSP trimmed
    assert c["u6"].city == "SANTA RITA"                  # hyphen deleted, then typo seed
    assert c["u1"].latitude == -10.0


def test_sellers_dimension(built):
    spark, cfg, *_ = built
    s = gold(spark, cfg, "dim_sellers")
    assert (s["s1"].zip_code_prefix, s["s1"].city, s["s1"].latitude) == ("01307", "SAO PAULO", -23.6)
    assert s["s2"].city == "SAO PAULO"                   # postcode rule, then municipality
    assert s["s3"].latitude is None                      # prefix without geolocation


def test_products_and_category(built):
    spark, cfg, *_ = built
    p = gold(spark, cfg, "dim_products")
    assert (p["p1"].name_lenght, p["p1"].description_lenght) == (2, 4)   # half-even rounding cast
    assert (p["p2"].category_name, p["p2"].business_area) == ("pc_gamer", "Electronics")
    assert p["p3"].category_name is None and p["p4"].business_area is None


def test_order_fact(built):
    spark, cfg, *_ = built
    f = gold(spark, cfg, "fct_orders")
    assert "o6" not in f                                  # customer record missing
    o1 = f["o1"]
    assert (o1.credit_card_value, o1.boleto_value, o1.voucher_value, o1.debit_card_value) == (60.0, 55.75, 50.0, 0.0)
    assert (o1.total_payment_value, o1.installments_count, o1.review_score) == (165.75, 3, 4)
    assert f["o2"].status == "CANCELLED" and f["o2"].total_payment_value is None   # only not_defined
    assert f["o3"].status == "CANCELED"                  # ' canceled' is not recoded
    assert f["o4"].days_to_deliver == 1                  # 23:00 -> 01:00
    assert f["o4"].review_score == 2                     # tie on date broken by answer time
    assert f["o5"].days_to_deliver == -1 and f["o5"].total_payment_value == 32.0
    assert f["o5"].credit_card_value == 0.0              # unlisted type: total only


def test_dimensions_misc(built):
    spark, cfg, *_ = built
    st = gold(spark, cfg, "dim_states")
    assert st["SP"].region == "south-east" and st["BA"].region == "north-east" and st["SP"].state_name == "SAO PAULO"
    se = gold(spark, cfg, "dim_socio_economics")
    assert (se["SP"].education_index, se["SP"].public_icu_beds, se["SP"].airports_passengers_rate) == (0.83, 60, 0.4)
    d = read_table(spark, cfg.model_path("gold", "dim_date"))
    assert d.count() == 1338
    assert d.filter(F.col("date_id") > dt.date(2018, 10, 12)).filter("is_holiday_brazil").count() == 0


def test_reports_flag_planted_violations(built):
    spark, cfg, res, *_ = built
    bad = {(r.table_name, r.check_name) for r in res.report().filter("status = 'error'").collect()}
    for want in [("source.orders", "accepted_order_status"),
                 ("slv_stg_ibge__intensive_care_unit_beds", "icu_beds_sum"),
                 ("slv_stg_market__orders", "relationships_customer_basket_id_slv_stg_market__customers"),
                 ("slv_int_market__order_payments", "accepted_type"),
                 ("fct_orders", "payment_breakdown_matches_total"),
                 ("fct_orders", "delivery_date_after_purchase"),
                 ("fct_orders", "range_days_to_deliver")]:
        assert want in bad
    ok = {(r.table_name, r.check_name) for r in res.report().filter("status = 'pass'").collect()}
    assert ("slv_int_market__order_reviews", "unique_order_review_id") in ok
    assert ("slv_stg_ibge__states", "ratio_density") in ok           # zero area -> NULL ratio passes


def test_gate_stops_build(built, tmp):
    spark, cfg0, _, paths, base = built
    cfg = PipelineConfig(source_base=cfg0.source_base, target_base=f"{tmp}/wh", seeds_dir=paths["seeds"])
    with pytest.raises(QualityError, match="accepted_order_status"):
        runner.run(spark, cfg, gate=True)
    # what reads the failing source is not built, the other branches are
    assert not os.path.exists(cfg.model_path("gold", "fct_orders"))
    assert not os.path.exists(cfg.model_path("bronze", "brz_market__orders"))
    assert os.path.exists(cfg.model_path("gold", "dim_states")) and os.path.exists(cfg.model_path("gold", "dim_date"))
    assert os.path.exists(cfg.model_path("gold", "dim_sellers"))


def test_incremental_equals_full_refresh_inside_window(built, tmp):
    spark, cfg0, _, paths, base = built
    # copy the built warehouse, change sources, run incrementally
    src = f"{tmp}/src"
    shutil.copytree(cfg0.source_base, src)
    wh = f"{tmp}/wh"
    shutil.copytree(cfg0.target_base, wh)
    cfg = PipelineConfig(source_base=src, target_base=wh, seeds_dir=paths["seeds"])
    raw = f"{tmp}/raw"
    shutil.copytree(paths["marketplace"], raw)
    rows = list(csv.reader(open(f"{raw}/order_payments.csv")))
    rows = [r if r[0] != "o9" else r for r in rows] + [["o9", "1", "credit_card", "2", "77.00"]]
    rows = [r if not (r[0] == "o1" and r[1] == "1") else ["o1", "1", "credit_card", "3", "61.00"] for r in rows]
    with open(f"{raw}/order_payments.csv", "w", newline="") as fh:
        csv.writer(fh).writerows(rows)
    from stratum.sources.ingest import load_csvs
    from stratum.sources.specs import MARKETPLACE
    load_csvs(spark, cfg, raw, MARKETPLACE)
    res = runner.run(spark, cfg, gate=False, source_checks=False)  # standard job: incremental facts
    assert res.incremental["fct_orders"]["since"].startswith("2017-07-30")
    f = gold(spark, cfg, "fct_orders")
    assert f["o9"].credit_card_value == 77.0             # inside the window: updated
    assert f["o1"].credit_card_value == 60.0             # outside the window: stale until full refresh
    runner.run(spark, cfg, select=["fct_orders"], full_refresh=True, gate=False, source_checks=False)
    f = gold(spark, cfg, "fct_orders")
    assert f["o1"].credit_card_value == 61.0 and f["o9"].credit_card_value == 77.0
    assert len(f) == 8


def test_selection_and_config():
    names = [m.name for m in runner.selection(["gold"])]
    assert names[0] == "dim_date" and all(n.startswith(("dim_", "fct_")) for n in names)
    assert [m.name for m in runner.selection(["fct_orders"])] == ["fct_orders"]
    assert len(runner.selection(["silver"])) == 24
    targets = {"dev": PipelineConfig("a", "b"), "prod": PipelineConfig("a", "c")}
    assert resolve_target(targets, "prod").target_base == "c"
    with pytest.raises(ValueError):
        resolve_target(targets, "qa")


def test_jobs(built):
    spark, cfg, *_ = built
    names = [m.name for m in runner.selection(["incremental"])]
    assert names == ["fct_orders", "fct_order_items"]
    res = runner.full_refresh_job(spark, cfg, gate=False)
    assert set(res.incremental) == {"fct_orders", "fct_order_items"}
    assert all(v["mode"] == "full" for v in res.incremental.values())
    assert runner.freshness_job(spark, cfg, dt.datetime(2017, 8, 3)).count() == 2


def test_bad_cells_fail_the_load(spark, tmp):
    from stratum.sources.ingest import read_csv
    from stratum.sources.specs import ALL_SOURCES
    head = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    for k, row in enumerate(["o1,x1,p,s,2018-01-01 10:00:00,1.0,1.0", "o1,1,p,s,2018-01-01 10:00:00,1e,1.0",
                             "o1,1,p,s,someday,1.0,1.0"]):
        with open(f"{tmp}/bad{k}.csv", "w") as fh:
            fh.write(head + row + "\n")
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            read_csv(spark, f"{tmp}/bad{k}.csv", ALL_SOURCES["order_items"]).collect()
    with open(f"{tmp}/good.csv", "w") as fh:
        fh.write(head + "".join(f"o1,1,p,s,{t},1.5,\n" for t in (
            "2018-01-01", "2018-01-01T10:00:00", "2018-01-01 10:00:00.500", "")))
    got = read_csv(spark, f"{tmp}/good.csv", ALL_SOURCES["order_items"]).collect()
    assert [r.shipping_limit_date for r in got] == [
        dt.datetime(2018, 1, 1), dt.datetime(2018, 1, 1, 10), dt.datetime(2018, 1, 1, 10, 0, 0, 500000), None]
    assert all(r.freight_value is None for r in got)


def test_csv_files_are_split(spark, tmp):
    from stratum.sources.ingest import read_csv
    from stratum.sources.specs import ALL_SOURCES
    with open(f"{tmp}/customers.csv", "w") as fh:
        fh.write("customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n")
        fh.writelines(f"b{i},c{i},01307,sao paulo,SP\n" for i in range(20_000))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = read_csv(spark, f"{tmp}/customers.csv", ALL_SOURCES["customers"])
        assert df.rdd.getNumPartitions() > 4 and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_missing_csv_is_rejected(spark, tmp):
    cfg = PipelineConfig(source_base=f"{tmp}/src", target_base=f"{tmp}/wh")
    with pytest.raises(FileNotFoundError):
        runner.ingest(spark, cfg, f"{tmp}/nothing", f"{tmp}/nothing")


def test_freshness_job(built):
    spark, cfg, *_ = built
    rep = {r.source_name: r.status for r in runner.freshness(spark, cfg, dt.datetime(2017, 8, 3, 0, 0)).collect()}
    assert rep == {"orders": "pass", "order_reviews": "error"}
    nowhere = PipelineConfig(source_base=cfg.source_base + "-missing", target_base=cfg.target_base)
    rep = {r.source_name: r.status for r in runner.freshness_job(spark, nowhere).collect()}
    assert rep == {"orders": "error", "order_reviews": "error"}  # reported, not raised


def test_command_line(built, capsys):
    from stratum.__main__ import main
    spark, cfg, *_ = built
    args = ["--source-base", cfg.source_base, "--target-base", cfg.target_base, "--seeds-dir", cfg.seeds_dir]
    assert main(["full-refresh", *args, "--no-gate"], spark=spark) == 0
    assert "built 2 models" in capsys.readouterr().out
    assert main(["freshness", *args, "--as-of", "2017-08-03T00:00:00"], spark=spark) == 0
    out = capsys.readouterr().out
    assert "orders: pass" in out and "order_reviews: error" in out
    assert main(["ingest", *args], spark=spark) == 2
