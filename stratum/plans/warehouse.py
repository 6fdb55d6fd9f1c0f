"""The layered marketplace warehouse, model by model, as DataFrame functions.

Every model is ``fn(ctx) -> DataFrame``; ``ctx.source(name)``, ``ctx.seed(name)``
and ``ctx.ref(model)`` resolve inputs.  :data:`MODELS` lists them in build
order with their layer, materialisation and checks; :mod:`stratum.plans.runner`
executes the list.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.casts import day_diff, to_int
from stratum.functions.keys import surrogate_key
from stratum.functions.text import clean_lower, clean_upper, normalize_name, trim_spaces
from stratum.operators.calendar import date_dimension
from stratum.operators.joins import salted_left_join
from stratum.operators.latest import latest_per_key
from stratum.operators.lookup import correct_names
from stratum.operators.quality import (AcceptedRange, AcceptedValues, MeanConsistency, NotNull,
                                       RatioConsistency, Relationships, RowRule, SumConsistency,
                                       Tolerance, Unique)
from stratum.operators.reshape import pivot_sum, unpivot_groups
from stratum.operators.star import centroid
from stratum.sources.ingest import mirror
from stratum.sources.specs import ALL_SOURCES, HDI_YEARS


@dataclass
class Model:
    name: str
    layer: str
    fn: Callable
    materialized: str = "view"          # table | view | ephemeral | incremental
    unique_key: str | None = None       # incremental models
    lookback_col: str | None = None     # incremental models
    lookback_days: int = 3
    checks: Callable | None = None      # ctx -> list of checks on this model
    tags: tuple = ()
    partition_by: list[str] = field(default_factory=list)
    # layout-only columns added at write time (and dropped on read), e.g. the
    # month of the date key; they are not part of the model's output
    partition_cols: dict = field(default_factory=dict)


# --------------------------------------------------------------------- bronze
def _bronze(source: str) -> Callable:
    def build(ctx) -> DataFrame:
        return mirror(ctx.source(source), ALL_SOURCES[source])
    build.__name__ = f"bronze_{source}"
    return build


def _q(c: str):
    return F.col(f"`{c}`")


# ------------------------------------------------------------ silver staging
def stg_airports(ctx):
    b = ctx.ref("brz_ibge__airports")
    return b.select(clean_upper(_q("UF")).alias("state_id"), _q("Passengers rate").alias("passengers_rate"))


def stg_human_development_index(ctx):
    b = ctx.ref("brz_ibge__hdi")
    cols = [clean_upper(_q("UF")).alias("state_id")]
    for y in HDI_YEARS:
        cols += [_q(f"HDI {y}").alias(f"hdi_{y}"),
                 _q(f"HDI Education {y}").alias(f"hdi_education_{y}"),
                 _q(f"HDI Wealth {y}").alias(f"hdi_wealth_{y}"),
                 _q(f"HDI Health {y}").alias(f"hdi_health_{y}")]
    return b.select(*cols)


def stg_intensive_care_unit_beds(ctx):
    b = ctx.ref("brz_ibge__icu_beds")
    return b.select(clean_upper(_q("UF")).alias("state_id"), _q("ICU beds").alias("icu_beds"),
                    _q("Public beds").alias("public_beds"), _q("Private beds").alias("private_beds"),
                    _q("Public beds per citizen").alias("public_beds_per_10k_citizens"),
                    _q("Private beds per citizen").alias("private_beds_per_10k_citizens"))


def stg_states(ctx):
    b = ctx.ref("brz_ibge__states")
    region = (F.when(_q("Region") == "Northeast", F.lit("North-east"))
               .when(_q("Region") == "Southeast", F.lit("South-east"))
               .otherwise(_q("Region")))
    return b.select(
        clean_upper(_q("UF")).alias("state_id"), clean_upper(_q("State")).alias("state_name"),
        clean_upper(_q("Capital")).alias("capital"), clean_lower(region).alias("region"),
        _q("Area").alias("area_km2"), _q("Population").alias("population"),
        _q("Demographic Density").alias("demographic_density_per_km2"),
        _q("Cities count").alias("cities_number"), _q("GDP").alias("gdp"),
        _q("GDP rate").alias("gdp_world_share"), _q("Poverty").alias("poverty_index"),
        _q("Latitude").alias("latitude"), _q("Longitude").alias("longitude"))


def stg_customers(ctx):
    b = ctx.ref("brz_market__customers")
    return b.select(trim_spaces("customer_id").alias("customer_basket_id"),
                    trim_spaces("customer_unique_id").alias("customer_id"),
                    trim_spaces("customer_zip_code_prefix").alias("zip_code_prefix"),
                    clean_upper("customer_city").alias("city"), clean_upper("customer_state").alias("state_id"))


def stg_geolocation(ctx):
    b = ctx.ref("brz_market__geolocation")
    return b.select(trim_spaces("geolocation_zip_code_prefix").alias("zip_code_prefix"),
                    F.col("geolocation_lat").alias("latitude"), F.col("geolocation_lng").alias("longitude"),
                    clean_upper("geolocation_city").alias("city"),
                    clean_upper("geolocation_state").alias("state_id"))


def stg_order_items(ctx):
    b = ctx.ref("brz_market__order_items")
    return b.select(trim_spaces("order_id").alias("order_id"),
                    to_int("order_item_id").alias("item_sequence_number"),
                    trim_spaces("product_id").alias("product_id"), trim_spaces("seller_id").alias("seller_id"),
                    F.col("shipping_limit_date").cast("timestamp_ntz").alias("shipping_limit_date"),
                    "price", "freight_value")


def stg_order_payments(ctx):
    b = ctx.ref("brz_market__order_payments")
    return b.select(trim_spaces("order_id").alias("order_id"),
                    to_int("payment_sequential").alias("sequence_number"),
                    clean_lower("payment_type").alias("type"),
                    to_int("payment_installments").alias("installments_count"),
                    F.col("payment_value").alias("value"))


def stg_order_reviews(ctx):
    b = ctx.ref("brz_market__order_reviews")
    return b.select(trim_spaces("review_id").alias("review_id"), trim_spaces("order_id").alias("order_id"),
                    to_int("review_score").alias("score"),
                    clean_lower("review_comment_title").alias("comment_title"),
                    clean_lower("review_comment_message").alias("comment_text"),
                    F.to_date("review_creation_date").alias("creation_date"),
                    F.col("review_answer_timestamp").cast("timestamp_ntz").alias("answer_timestamp"))


def stg_orders(ctx):
    b = ctx.ref("brz_market__orders")
    # the recode sees the raw value: ' canceled' is not recoded
    status = F.when(F.col("order_status") == "canceled", F.lit("cancelled")).otherwise(F.col("order_status"))
    ts = lambda c: F.col(c).cast("timestamp_ntz")
    return b.select(trim_spaces("order_id").alias("order_id"),
                    trim_spaces("customer_id").alias("customer_basket_id"),
                    clean_upper(status).alias("status"),
                    ts("order_purchase_timestamp").alias("purchase_timestamp"),
                    ts("order_approved_at").alias("approved_at"),
                    ts("order_delivered_carrier_date").alias("delivered_carrier_date"),
                    ts("order_delivered_customer_date").alias("delivered_customer_date"),
                    ts("order_estimated_delivery_date").alias("estimated_delivery_date"))


def stg_product_category(ctx):
    b = ctx.ref("brz_market__category_translation")
    return b.select(clean_lower("product_category_name").alias("local_name"),
                    clean_lower("product_category_name_english").alias("english_name"))


def stg_products(ctx):
    b = ctx.ref("brz_market__products")
    return b.select(trim_spaces("product_id").alias("product_id"),
                    clean_lower("product_category_name").alias("local_category_name"),
                    to_int("product_name_lenght").alias("name_lenght"),
                    to_int("product_description_lenght").alias("description_lenght"),
                    to_int("product_photos_qty").alias("photos_qty"),
                    F.col("product_weight_g").alias("weight_g"), F.col("product_length_cm").alias("length_cm"),
                    F.col("product_height_cm").alias("height_cm"), F.col("product_width_cm").alias("width_cm"))


def stg_sellers(ctx):
    b = ctx.ref("brz_market__sellers")
    # the postcode is passed through untouched (no trim), as in the source model
    return b.select(trim_spaces("seller_id").alias("seller_id"),
                    F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
                    clean_upper("seller_city").alias("city"), clean_upper("seller_state").alias("state_id"))


# ------------------------------------------------------- silver intermediate
def int_human_development_index(ctx, years=None):
    s = ctx.ref("slv_stg_ibge__human_development_index")
    groups = {y: {"hdi": f"hdi_{y}", "education_index": f"hdi_education_{y}",
                  "wealth_index": f"hdi_wealth_{y}", "health_index": f"hdi_health_{y}"} for y in HDI_YEARS}
    long = unpivot_groups(s, ["state_id"], groups, label="year", labels=years)
    return long.select(surrogate_key("state_id", "year").alias("hdi_id"), "state_id", "education_index",
                       "wealth_index", "health_index", "year")


def int_intensive_care_unit_beds(ctx):
    return ctx.ref("slv_stg_ibge__intensive_care_unit_beds").select("state_id", "public_beds", "private_beds")


def int_states(ctx):
    s = ctx.ref("slv_stg_ibge__states")
    return s.select("state_id", normalize_name("state_name").alias("state_name"),
                    normalize_name("capital").alias("capital"), "region", "area_km2", "population",
                    "cities_number", "gdp", "gdp_world_share", "poverty_index", "latitude", "longitude")


def _cascade(ctx, df, name_col, zip_col, out="city"):
    return correct_names(df, name_col, zip_col, ctx.seed("typo_cure"), ctx.seed("zip_code_fix"),
                         ctx.seed("municipality_map"), out=out)


def int_customers(ctx):
    c = ctx.ref("slv_stg_market__customers")
    o = ctx.ref("slv_stg_market__orders").select("customer_basket_id", "purchase_timestamp")
    joined = c.join(o, "customer_basket_id", "inner")
    # newest record per customer (NULL timestamps last), total joined records;
    # the basket id breaks ties, then the location columns
    latest = latest_per_key(joined, ["customer_id"], ["purchase_timestamp", "customer_basket_id"],
                            payload=["zip_code_prefix", "city", "state_id"],
                            count_as="total_orders", count_of="customer_basket_id")
    # names are corrected after the pick: once per customer, not per record
    return _cascade(ctx, latest, "city", "zip_code_prefix", out="city").select(
        "customer_id", "zip_code_prefix", "city", "state_id", "total_orders")


def int_geolocation(ctx):
    g = ctx.ref("slv_stg_market__geolocation")
    g = _cascade(ctx, g, "city", "zip_code_prefix", out="city_final")
    return centroid(g, "zip_code_prefix", {"latitude_mean": "latitude", "longitude_mean": "longitude"},
                    {"city": "city_final", "state_id": "state_id"})


def int_order_items(ctx):
    s = ctx.ref("slv_stg_market__order_items")
    return s.select(surrogate_key("order_id", "item_sequence_number").alias("order_item_id"), *s.columns)


def int_order_payments(ctx):
    s = ctx.ref("slv_stg_market__order_payments")
    return s.select(surrogate_key("order_id", "sequence_number").alias("order_payment_id"), *s.columns)


def int_order_reviews(ctx):
    s = ctx.ref("slv_stg_market__order_reviews")
    d = s.select(F.col("review_id").alias("review_group_id"), "order_id", "score", "comment_title",
                 "comment_text", "creation_date", "answer_timestamp").distinct()
    return d.select(surrogate_key("review_group_id", "order_id").alias("order_review_id"), *d.columns)


def int_orders(ctx):
    o = ctx.ref("slv_stg_market__orders")
    c = ctx.ref("slv_stg_market__customers").select("customer_basket_id", "customer_id")
    j = o.join(c, "customer_basket_id", "inner")
    return j.select("order_id", "customer_id", "status", "purchase_timestamp", "approved_at",
                    "delivered_carrier_date", "delivered_customer_date", "estimated_delivery_date")


# Categories missing from the translation table and their names.
CATEGORY_NAME_OVERRIDES = [
    ("pc_gamer", "pc_gamer"),
    ("portateis_cozinha_e_preparadores_de_alimentos", "small_kitchen_appliances_and_food_processors"),
]


def int_product_category(ctx):
    seed = ctx.seed("category_map")
    pc = ctx.ref("slv_stg_market__product_category")
    j = seed.join(pc, seed["raw_category"] == pc["local_name"], "left")
    eng = F.col("english_name")
    for k, v in reversed(CATEGORY_NAME_OVERRIDES):
        eng = F.when(F.col("raw_category") == k, F.lit(v)).otherwise(eng)
    return j.select(F.col("raw_category").alias("local_name"), eng.alias("english_name"), "business_area")


def int_sellers(ctx):
    s = ctx.ref("slv_stg_market__sellers")
    return _cascade(ctx, s, "city", "zip_code_prefix", out="city").select(
        "seller_id", "zip_code_prefix", "city", "state_id")


# ------------------------------------------------------------------- gold
def dim_customers(ctx):
    c = ctx.ref("slv_int_market__customers")
    g = ctx.ref("slv_int_market__geolocation").select("zip_code_prefix", F.col("latitude_mean").alias("latitude"),
                                                      F.col("longitude_mean").alias("longitude"))
    return salted_left_join(c, g, "zip_code_prefix", spread_by="customer_id").select(
        "customer_id", "zip_code_prefix", "city", "state_id", "latitude", "longitude", "total_orders")


def dim_sellers(ctx):
    s = ctx.ref("slv_int_market__sellers")
    g = ctx.ref("slv_int_market__geolocation").select("zip_code_prefix", F.col("latitude_mean").alias("latitude"),
                                                      F.col("longitude_mean").alias("longitude"))
    return salted_left_join(s, g, "zip_code_prefix", spread_by="seller_id").select(
        "seller_id", "zip_code_prefix", "city", "state_id", "latitude", "longitude")


def dim_products(ctx):
    p = ctx.ref("slv_stg_market__products")
    pc = ctx.ref("slv_int_market__product_category")
    j = p.join(pc, p["local_category_name"] == pc["local_name"], "left")
    return j.select("product_id", F.col("english_name").alias("category_name"), "business_area", "name_lenght",
                    "description_lenght", "photos_qty", "weight_g", "length_cm", "height_cm", "width_cm")


# The days the date dimension covers (end exclusive).
DATE_START, DATE_END ="2016-09-01", "2020-05-01"


def dim_date(ctx):
    d = date_dimension(ctx.spark, DATE_START, DATE_END, holidays=ctx.seed("brazil_holidays"),
                       flag="is_holiday_brazil")
    return d


def dim_states(ctx):
    s = ctx.ref("slv_int_ibge__states")
    return s.select("state_id", "state_name", "capital", "region", "area_km2", "cities_number",
                    "latitude", "longitude")


def dim_socio_economics(ctx):
    s = ctx.ref("slv_int_ibge__states")
    h = (ctx.ref_with("slv_int_ibge__human_development_index", years=[2017])
            .filter(F.col("year") == 2017).select("state_id", "education_index", "wealth_index", "health_index"))
    i = ctx.ref("slv_int_ibge__intensive_care_unit_beds")
    a = ctx.ref("slv_stg_ibge__airports")
    j = (s.join(h, "state_id", "left").join(i, "state_id", "left").join(a, "state_id", "left"))
    return j.select("state_id", "population", "gdp", "gdp_world_share", "education_index", "wealth_index",
                    "health_index", "poverty_index", F.col("passengers_rate").alias("airports_passengers_rate"),
                    F.col("public_beds").alias("public_icu_beds"), F.col("private_beds").alias("private_icu_beds"))


# The payment types that get a column of their own.
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card"]


def fct_orders(ctx, since=None):
    """Order fact.  ``since`` (incremental runs) restricts to orders approved
    at or after it; payments and reviews are then semi-joined to those order
    ids *before* they are aggregated, so only touched orders are aggregated."""
    o = ctx.ref("slv_int_market__orders")
    pay = ctx.ref("slv_int_market__order_payments")
    rev = ctx.ref("slv_int_market__order_reviews")
    if since is not None:
        o = o.filter(F.col("approved_at") >= since)
        ids = o.select("order_id")
        pay = pay.join(ids, "order_id", "left_semi")
        rev = rev.join(ids, "order_id", "left_semi")
    pa = (pay.filter(F.col("type") != "not_defined").groupBy("order_id")
             .agg(F.sum("value").alias("total_payment_value"),
                  F.max("installments_count").alias("installments_count"),
                  *pivot_sum("type", PAYMENT_TYPES, "value", suffix="_value")))
    # newest review per order; ties broken by answer time, then review id
    r = latest_per_key(rev.select("order_id", "creation_date", "answer_timestamp", "review_group_id", "score"),
                       ["order_id"], ["creation_date", "answer_timestamp", "review_group_id"], payload=["score"])
    f = o.join(pa, "order_id", "left").join(r, "order_id", "left")
    return f.select(
        "order_id", "customer_id", F.to_date("purchase_timestamp").alias("order_date_id"), "status",
        "approved_at", "delivered_carrier_date", "delivered_customer_date", "estimated_delivery_date",
        day_diff("purchase_timestamp", "delivered_customer_date").alias("days_to_deliver"),
        day_diff("estimated_delivery_date", "delivered_customer_date").alias("delivery_delay_days"),
        "installments_count", *[f"{t}_value" for t in PAYMENT_TYPES], "total_payment_value",
        F.col("score").alias("review_score"), F.col("creation_date").alias("review_creation_date"),
        F.col("answer_timestamp").alias("review_answer_timestamp"))


def fct_order_items(ctx, since=None):
    i = ctx.ref("slv_int_market__order_items")
    f = i.select("order_item_id", "order_id", "product_id", "seller_id",
                 F.to_date("shipping_limit_date").alias("shipping_date_id"), "item_sequence_number",
                 "price", "freight_value", (F.col("price") + F.col("freight_value")).alias("total_item_value"))
    if since is not None:
        f = f.filter(F.col("shipping_date_id") >= since)
    return f


# ------------------------------------------------------------------ checks
def _nn_unique(col):
    return [Unique(f"unique_{col}", [col]), NotNull(f"not_null_{col}", col)]


def _rel(ctx, col, parent, to=None, name=None):
    return Relationships(name or f"relationships_{col}_{parent}", col, parent=lambda: ctx.ref(parent), to_column=to or col)


# The accepted payment types and raw order states.
PAYMENT_TYPE_VALUES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
ORDER_STATUS_VALUES = ["delivered", "shipped", "canceled", "unavailable", "invoiced", "processing",
                       "created", "approved"]


def _hdi_source_checks(ctx):
    out = _nn_unique("UF")
    for y in HDI_YEARS:
        for part in ("", " Education", " Wealth", " Health"):
            c = f"HDI{part} {y}"
            out += [NotNull(f"not_null_{c}", c), AcceptedRange(f"range_{c}", c, min_value=0, max_value=1)]
    return out


SOURCE_CHECKS = {
    "airports": lambda ctx: _nn_unique("UF") + [NotNull("not_null_passengers_rate", "Passengers rate"),
                                                AcceptedRange("range_passengers_rate", "Passengers rate",
                                                              min_value=0, max_value=1)],
    "hdi": _hdi_source_checks,
    "icu_beds": lambda ctx: _nn_unique("UF"),
    "states": lambda ctx: _nn_unique("UF") + [NotNull(f"not_null_{c}", c) for c in
                                              ("State", "Capital", "Region", "Cities count", "Latitude", "Longitude")],
    "customers": lambda ctx: _nn_unique("customer_id") + [NotNull("not_null_customer_unique_id", "customer_unique_id")],
    "geolocation": lambda ctx: [NotNull("not_null_geolocation_zip_code_prefix", "geolocation_zip_code_prefix")],
    "order_items": lambda ctx: [NotNull("not_null_order_id", "order_id"),
                                NotNull("not_null_order_item_id", "order_item_id")],
    "order_payments": lambda ctx: [NotNull("not_null_order_id", "order_id")],
    "order_reviews": lambda ctx: [NotNull("not_null_review_id", "review_id"),
                                  AcceptedValues("accepted_review_score", "review_score", values=[1, 2, 3, 4, 5])],
    "orders": lambda ctx: _nn_unique("order_id") + [
        NotNull("not_null_order_status", "order_status"),
        AcceptedValues("accepted_order_status", "order_status", values=ORDER_STATUS_VALUES)],
    "products": lambda ctx: _nn_unique("product_id"),
    "sellers": lambda ctx: _nn_unique("seller_id"),
}


def _icu_ratio_checks(ctx):
    def st():
        return ctx.ref("slv_stg_ibge__states").select("state_id", "population")
    return [RatioConsistency("ratio_public_beds", "public_beds_per_10k_citizens", "public_beds", "population",
                             scale=10000, join_to=st, join_on="state_id"),
            RatioConsistency("ratio_private_beds", "private_beds_per_10k_citizens", "private_beds", "population",
                             scale=10000, join_to=st, join_on="state_id"),
            SumConsistency("icu_beds_sum", "icu_beds", parts=["public_beds", "private_beds"])]


def _fct_orders_checks(ctx):
    total = F.col("total_payment_value")
    parts = None
    for t in PAYMENT_TYPES:
        parts = F.col(f"{t}_value") if parts is None else parts + F.col(f"{t}_value")
    return _nn_unique("order_id") + [
        NotNull("not_null_customer_id", "customer_id"), _rel(ctx, "customer_id", "dim_customers"),
        NotNull("not_null_order_date_id", "order_date_id"),
        _rel(ctx, "order_date_id", "dim_date", "date_id"),
        NotNull("not_null_status", "status"),
        AcceptedRange("range_days_to_deliver", "days_to_deliver", min_value=0),
        Tolerance("payment_breakdown_matches_total", "total_payment_value", expected=parts, tolerance=0.01,
                  guard=total.isNotNull()),
        RowRule("delivery_date_after_purchase", "delivered_customer_date",
                expr=F.col("delivered_customer_date").isNotNull()
                & (F.col("delivered_customer_date") < F.col("order_date_id"))),
    ]


def _fct_items_checks(ctx):
    return _nn_unique("order_item_id") + [
        NotNull(f"not_null_{c}", c) for c in ("order_id", "product_id", "seller_id", "shipping_date_id",
                                              "item_sequence_number", "price", "freight_value", "total_item_value")
    ] + [_rel(ctx, "order_id", "fct_orders"), _rel(ctx, "product_id", "dim_products"),
         _rel(ctx, "seller_id", "dim_sellers"), _rel(ctx, "shipping_date_id", "dim_date", "date_id"),
         Tolerance("total_item_value_is_price_plus_freight", "total_item_value",
                   expected=F.col("price") + F.col("freight_value"), tolerance=0.01)]


MODELS: list[Model] = [
    # bronze: 1:1 mirrors, materialised
    *[Model(f"brz_ibge__{s}", "bronze", _bronze(s), "table") for s in ("airports", "hdi", "icu_beds", "states")],
    *[Model(f"brz_market__{s}", "bronze", _bronze(s), "table") for s in (
        "category_translation", "customers", "geolocation", "order_items", "order_payments", "order_reviews",
        "orders", "products", "sellers")],
    # silver staging
    Model("slv_stg_ibge__airports", "silver_staging", stg_airports, "ephemeral"),
    Model("slv_stg_ibge__human_development_index", "silver_staging", stg_human_development_index,
          checks=lambda ctx: [MeanConsistency(f"mean_hdi_{y}", f"hdi_{y}",
                                              parts=[f"hdi_education_{y}", f"hdi_wealth_{y}", f"hdi_health_{y}"],
                                              tolerance=0.1) for y in HDI_YEARS]),
    Model("slv_stg_ibge__intensive_care_unit_beds", "silver_staging", stg_intensive_care_unit_beds,
          checks=_icu_ratio_checks),
    Model("slv_stg_ibge__states", "silver_staging", stg_states,
          checks=lambda ctx: [RatioConsistency("ratio_density", "demographic_density_per_km2", "population",
                                               "area_km2")]),
    Model("slv_stg_market__customers", "silver_staging", stg_customers, "ephemeral"),
    Model("slv_stg_market__geolocation", "silver_staging", stg_geolocation, "ephemeral"),
    Model("slv_stg_market__orders", "silver_staging", stg_orders,
          checks=lambda ctx: [_rel(ctx, "customer_basket_id", "slv_stg_market__customers")]),
    Model("slv_stg_market__products", "silver_staging", stg_products,
          checks=lambda ctx: [_rel(ctx, "local_category_name", "slv_stg_market__product_category", "local_name")]),
    Model("slv_stg_market__sellers", "silver_staging", stg_sellers, "ephemeral"),
    Model("slv_stg_market__order_items", "silver_staging", stg_order_items,
          checks=lambda ctx: [_rel(ctx, "order_id", "slv_stg_market__orders"),
                              _rel(ctx, "product_id", "slv_stg_market__products"),
                              _rel(ctx, "seller_id", "slv_stg_market__sellers")]),
    Model("slv_stg_market__order_payments", "silver_staging", stg_order_payments,
          checks=lambda ctx: [_rel(ctx, "order_id", "slv_stg_market__orders")]),
    Model("slv_stg_market__order_reviews", "silver_staging", stg_order_reviews,
          checks=lambda ctx: [_rel(ctx, "order_id", "slv_stg_market__orders")]),
    Model("slv_stg_market__product_category", "silver_staging", stg_product_category, "ephemeral"),
    # silver intermediate
    Model("slv_int_ibge__human_development_index", "silver_intermediate", int_human_development_index,
          checks=lambda ctx: _nn_unique("hdi_id")),
    Model("slv_int_ibge__intensive_care_unit_beds", "silver_intermediate", int_intensive_care_unit_beds,
          checks=lambda ctx: _nn_unique("state_id")),
    Model("slv_int_ibge__states", "silver_intermediate", int_states, checks=lambda ctx: _nn_unique("state_id")),
    Model("slv_int_market__customers", "silver_intermediate", int_customers,
          checks=lambda ctx: _nn_unique("customer_id")),
    Model("slv_int_market__orders", "silver_intermediate", int_orders,
          checks=lambda ctx: _nn_unique("order_id") + [_rel(ctx, "customer_id", "slv_int_market__customers")]),
    Model("slv_int_market__product_category", "silver_intermediate", int_product_category,
          checks=lambda ctx: _nn_unique("local_name") + [NotNull("not_null_english_name", "english_name")]),
    Model("slv_int_market__geolocation", "silver_intermediate", int_geolocation,
          checks=lambda ctx: _nn_unique("zip_code_prefix")),
    Model("slv_int_market__order_items", "silver_intermediate", int_order_items,
          checks=lambda ctx: _nn_unique("order_item_id")),
    Model("slv_int_market__order_payments", "silver_intermediate", int_order_payments,
          checks=lambda ctx: _nn_unique("order_payment_id") + [
              AcceptedValues("accepted_type", "type", values=PAYMENT_TYPE_VALUES)]),
    Model("slv_int_market__order_reviews", "silver_intermediate", int_order_reviews,
          checks=lambda ctx: _nn_unique("order_review_id")),
    Model("slv_int_market__sellers", "silver_intermediate", int_sellers, checks=lambda ctx: _nn_unique("seller_id")),
    # gold
    Model("dim_date", "gold", dim_date, "table",
          checks=lambda ctx: _nn_unique("date_id") + [
              NotNull("not_null_year", "year"), NotNull("not_null_is_weekend", "is_weekend"),
              AcceptedValues("accepted_is_weekend", "is_weekend", values=[True, False]),
              NotNull("not_null_is_holiday_brazil", "is_holiday_brazil"),
              AcceptedValues("accepted_is_holiday_brazil", "is_holiday_brazil", values=[True, False])]),
    Model("dim_states", "gold", dim_states, "table",
          checks=lambda ctx: _nn_unique("state_id") + [NotNull("not_null_state_name", "state_name"),
                                                       NotNull("not_null_capital", "capital")]),
    Model("dim_socio_economics", "gold", dim_socio_economics, "table",
          checks=lambda ctx: _nn_unique("state_id") + [_rel(ctx, "state_id", "dim_states")]),
    Model("dim_customers", "gold", dim_customers, "table",
          checks=lambda ctx: _nn_unique("customer_id") + [
              NotNull(f"not_null_{c}", c) for c in ("zip_code_prefix", "city", "state_id")] + [
              _rel(ctx, "state_id", "dim_states")]),
    Model("dim_sellers", "gold", dim_sellers, "table",
          checks=lambda ctx: _nn_unique("seller_id") + [
              NotNull(f"not_null_{c}", c) for c in ("zip_code_prefix", "state_id")] + [
              _rel(ctx, "state_id", "dim_states")]),
    Model("dim_products", "gold", dim_products, "table", checks=lambda ctx: _nn_unique("product_id")),
    # facts are partitioned by the month of their date key, so an incremental
    # run rewrites only the months it touches (old versions of a key's row are
    # found wherever they are).
    Model("fct_orders", "gold", fct_orders, "incremental", unique_key="order_id", lookback_col="approved_at",
          checks=_fct_orders_checks, partition_by=["order_month"],
          partition_cols={"order_month": lambda: F.date_format("order_date_id", "yyyy-MM")}),
    Model("fct_order_items", "gold", fct_order_items, "incremental", unique_key="order_item_id",
          lookback_col="shipping_date_id", checks=_fct_items_checks, partition_by=["shipping_month"],
          partition_cols={"shipping_month": lambda: F.date_format("shipping_date_id", "yyyy-MM")}),
]

MODEL_INDEX = {m.name: m for m in MODELS}
