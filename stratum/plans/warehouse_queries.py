"""Gold models of the warehouse, run on marketplace sources derived from the
test tables (:mod:`stratum.plans.marketplace_views`), with SQL oracles.

The Spark side is the real model code (``plans/warehouse.py``) resolved as one
lazy plan per output.  The oracles are reasoned from what each output means
and from the plain test tables where the derivation allows it; they share no
text with the models: corrections are CASE maps, picks are ordered aggregates,
sums are filtered aggregates.  Sums and means of doubles are compared with
their finished results rounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.functions.keys import NULL_TOKEN
from stratum.plans.marketplace_views import SEED_ROWS, SOURCE_SQL, derived_seed, derived_source, source_sql
from stratum.plans.runner import LazyContext
from stratum.plans.testdata import replace_sql, rounded
from stratum.plans.warehouse import CATEGORY_NAME_OVERRIDES, PAYMENT_TYPES


def lazy_warehouse(spark: SparkSession, sf_dir: str) -> LazyContext:
    return LazyContext(spark, lambda n: derived_source(spark, sf_dir, n),
                       lambda n: derived_seed(spark, n) if n in SEED_ROWS else None)


def _model(name: str, *doubles: str):
    """The model's rows; ``doubles``: its sums and means, rounded for comparison."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(lazy_warehouse(spark, sf_dir).ref(name), *doubles)
    q.__name__ = f"warehouse_{name}"
    return q


# ------------------------------------------------------------------ oracle
def _norm(c: str) -> str:
    return f"regexp_replace(strip_accents(upper(trim({c}))), '[^A-Z0-9 ]', '', 'g')"


def _city(name: str, postcode: str) -> str:
    """The corrected name: the postcode's rule beats the typo map, and the
    municipality of what comes out of them is taken."""
    typo, zips, muni = (SEED_ROWS[n][0] for n in ("typo_cure", "zip_code_fix", "municipality_map"))
    placed = replace_sql(postcode, zips, replace_sql(_norm(name), typo))
    return replace_sql(f"({placed})", muni)


def _from(name: str) -> str:
    return f"({source_sql(name, 'sql')})"


_PLACES = f"""
places AS (
  SELECT geolocation_zip_code_prefix AS postcode, round(avg(geolocation_lat), 6) AS latitude,
         round(avg(geolocation_lng), 6) AS longitude
  FROM {_from('geolocation')} GROUP BY ALL
)"""

# one row per order straight from the plain tables: an order is its own
# basket, its lines are its payments and (shipped ones) its reviews
FCT_ORDERS_SQL = f"""
WITH money AS (
  SELECT l_orderkey AS k, 1 + max(CAST(l_quantity AS INT) % 12) AS installments_count, round(sum(l_extendedprice), 6) AS total,
         {', '.join(f"round(coalesce(sum(l_extendedprice) FILTER (kind = '{t}'), 0), 6) AS {t}_value" for t in PAYMENT_TYPES)}
  FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'R' THEN 'boleto'
                  ELSE if(l_linestatus = 'O', 'voucher', NULL) END AS kind FROM lineitem)
  WHERE kind IS NOT NULL GROUP BY l_orderkey
), opinion AS (
  -- shipped later, then the greater review id (text order), then the score
  SELECT l_orderkey AS k, max(l_shipdate) AS ship,
         first(CAST(l_quantity AS INT) % 5 + 1 ORDER BY l_shipdate DESC, l_linenumber::VARCHAR DESC,
               CAST(l_quantity AS INT) % 5 DESC) AS review_score
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey
), trip AS (
  SELECT l_orderkey AS k, min(l_shipdate) AS departure, max(l_shipdate) AS arrival FROM lineitem GROUP BY l_orderkey
)
SELECT 'o' || o_orderkey AS order_id, 'c' || o_custkey AS customer_id, o_orderdate::DATE AS order_date_id,
       CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'SHIPPED' ELSE 'CANCELLED' END AS status,
       if(o_orderstatus <> 'P', o_orderdate + INTERVAL 1 HOUR, NULL) AS approved_at,
       departure AS delivered_carrier_date, if(o_orderstatus = 'F', arrival, NULL) AS delivered_customer_date,
       o_orderdate + INTERVAL 30 DAY AS estimated_delivery_date,
       CAST(if(o_orderstatus = 'F', arrival::DATE - o_orderdate::DATE, NULL) AS INTEGER) AS days_to_deliver,
       CAST(if(o_orderstatus = 'F', arrival::DATE - o_orderdate::DATE - 30, NULL) AS INTEGER) AS delivery_delay_days,
       installments_count, {', '.join(f'{t}_value' for t in PAYMENT_TYPES)}, total AS total_payment_value,
       review_score, CAST(ship + INTERVAL 2 DAY AS DATE) AS review_creation_date,
       ship + INTERVAL 3 DAY AS review_answer_timestamp
FROM orders
LEFT JOIN money ON money.k = o_orderkey
LEFT JOIN opinion ON opinion.k = o_orderkey
LEFT JOIN trip ON trip.k = o_orderkey
WHERE o_custkey IN (SELECT c_custkey FROM customer)
"""

FCT_ORDER_ITEMS_SQL = f"""
SELECT md5('o' || l_orderkey || '-' || coalesce(l_linenumber::VARCHAR, '{NULL_TOKEN}')) AS order_item_id,
       'o' || l_orderkey AS order_id, 'p' || l_partkey AS product_id, 's' || l_suppkey AS seller_id,
       l_shipdate::DATE AS shipping_date_id, l_linenumber AS item_sequence_number, l_extendedprice AS price,
       l_extendedprice * l_tax AS freight_value, l_extendedprice + l_extendedprice * l_tax AS total_item_value
FROM lineitem
"""

DIM_CUSTOMERS_SQL = f"""
WITH {_PLACES}, who AS (
  SELECT customer_unique_id AS customer_id, count(*) AS total_orders,
         first(customer_zip_code_prefix ORDER BY o_orderdate DESC, customer_id DESC) AS zip_code_prefix,
         first(customer_city ORDER BY o_orderdate DESC, customer_id DESC) AS town,
         first(upper(customer_state) ORDER BY o_orderdate DESC, customer_id DESC) AS state_id
  FROM {_from('customers')} b JOIN orders ON customer_id = 'b' || o_orderkey
  GROUP BY customer_unique_id
)
SELECT customer_id, zip_code_prefix, {_city('town', 'zip_code_prefix')} AS city, state_id, latitude, longitude, total_orders
FROM who LEFT JOIN places ON postcode = zip_code_prefix
"""

DIM_SELLERS_SQL = f"""
WITH {_PLACES}
SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix, {_city('seller_city', 'seller_zip_code_prefix')} AS city,
       upper(seller_state) AS state_id, latitude, longitude
FROM {_from('sellers')} LEFT JOIN places ON postcode = seller_zip_code_prefix
"""

_AREAS = SEED_ROWS["category_map"][0]

# a product's category is its lower-case type: known if the seed lists it,
# named unless the translation misses it (PROMO) and no override helps
DIM_PRODUCTS_SQL = f"""
SELECT 'p' || p_partkey AS product_id,
       CASE WHEN kind NOT IN ({', '.join(f"'{a}'" for a, _ in _AREAS)}) THEN NULL
            {' '.join(f"WHEN kind = '{k}' THEN '{v}'" for k, v in CATEGORY_NAME_OVERRIDES)}
            WHEN kind = 'promo' THEN NULL ELSE kind || '_en' END AS category_name,
       CASE kind {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in _AREAS)} END AS business_area,
       CAST(round_even(p_size + 0.5, 0) AS INTEGER) AS name_lenght,
       CAST(round_even(p_retailprice / 10, 0) AS INTEGER) AS description_lenght,
       CAST(p_size % 5 AS INTEGER) AS photos_qty, p_retailprice AS weight_g,
       p_size::DOUBLE AS length_cm, p_size::DOUBLE AS height_cm, p_size::DOUBLE AS width_cm
FROM (SELECT *, lower(p_type) AS kind FROM part)
"""

_REGION = "CASE Region WHEN 'Northeast' THEN 'north-east' WHEN 'Southeast' THEN 'south-east' ELSE lower(Region) END"

DIM_STATES_SQL = f"""
SELECT UF AS state_id, {_norm('State')} AS state_name, {_norm('Capital')} AS capital, {_REGION} AS region,
       Area AS area_km2, Cities_count AS cities_number, Latitude AS latitude, Longitude AS longitude
FROM {_from('states')}
"""

# each figure is looked up for its state by itself
DIM_SOCIO_SQL = f"""
SELECT UF AS state_id, Population AS population, GDP AS gdp, GDP_rate AS gdp_world_share,
       (SELECT HDI_Education_2017 FROM {_from('hdi')} x WHERE x.UF = st.UF) AS education_index,
       (SELECT HDI_Wealth_2017 FROM {_from('hdi')} x WHERE x.UF = st.UF) AS wealth_index,
       (SELECT HDI_Health_2017 FROM {_from('hdi')} x WHERE x.UF = st.UF) AS health_index,
       Poverty AS poverty_index,
       (SELECT Passengers_rate FROM {_from('airports')} x WHERE x.UF = st.UF) AS airports_passengers_rate,
       (SELECT Public_beds FROM {_from('icu_beds')} x WHERE x.UF = st.UF) AS public_icu_beds,
       (SELECT Private_beds FROM {_from('icu_beds')} x WHERE x.UF = st.UF) AS private_icu_beds
FROM {_from('states')} st
"""

# the index falls by 0.05 a census and rises by region: all four years
INT_HDI_SQL = """
SELECT md5(uf || '-' || y) AS hdi_id, uf AS state_id, v AS education_index, v AS wealth_index, v AS health_index, y AS year
FROM (SELECT upper(substr(r_name, 1, 2)) AS uf, y, round(CAST(0.5 + r_regionkey / 20.0 - k * 0.05 AS DOUBLE), 2) AS v
      FROM region, (VALUES (0, 2017), (1, 2010), (2, 2000), (3, 1991)) AS c(k, y))
"""

INT_REVIEWS_SQL = f"""
SELECT md5('r' || l_orderkey || '_' || l_linenumber || '-o' || l_orderkey) AS order_review_id,
       'r' || l_orderkey || '_' || l_linenumber AS review_group_id, 'o' || l_orderkey AS order_id,
       CAST(l_quantity AS INT) % 5 + 1 AS score, if(l_discount > 0.05, 'ótimo', NULL) AS comment_title,
       CAST(NULL AS VARCHAR) AS comment_text, CAST(l_shipdate + INTERVAL 2 DAY AS DATE) AS creation_date,
       l_shipdate + INTERVAL 3 DAY AS answer_timestamp
FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL
"""

_PAID = [f"{t}_value" for t in PAYMENT_TYPES]

QUERIES = {
    "warehouse_fct_orders": _model("fct_orders", *_PAID, "total_payment_value"),
    "warehouse_fct_order_items": _model("fct_order_items"),
    "warehouse_dim_customers": _model("dim_customers", "latitude", "longitude"),
    "warehouse_dim_sellers": _model("dim_sellers", "latitude", "longitude"),
    "warehouse_dim_products": _model("dim_products"),
    "warehouse_dim_states": _model("dim_states"),
    "warehouse_dim_socio_economics": _model("dim_socio_economics"),
    "warehouse_int_hdi": _model("slv_int_ibge__human_development_index"),
    "warehouse_int_order_reviews": _model("slv_int_market__order_reviews"),
}

ORACLE = {
    "warehouse_fct_orders": FCT_ORDERS_SQL,
    "warehouse_fct_order_items": FCT_ORDER_ITEMS_SQL,
    "warehouse_dim_customers": DIM_CUSTOMERS_SQL,
    "warehouse_dim_sellers": DIM_SELLERS_SQL,
    "warehouse_dim_products": DIM_PRODUCTS_SQL,
    "warehouse_dim_states": DIM_STATES_SQL,
    "warehouse_dim_socio_economics": DIM_SOCIO_SQL,
    "warehouse_int_hdi": INT_HDI_SQL,
    "warehouse_int_order_reviews": INT_REVIEWS_SQL,
}

assert set(SOURCE_SQL) >= {"orders", "customers"}
