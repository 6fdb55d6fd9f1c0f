"""Marketplace-shaped raw sources derived from the TPC-H-like test tables.

The warehouse models expect the marketplace's raw tables.  These views
derive them with Spark from the given tables (every order becomes a basket,
every line an item, a payment and - when shipped - a review; nations become
cities, regions states), so the 45 real models run over data that grows with
the test tables.  The derivations are written once as SQL that both Spark
and the oracle engine accept; the models themselves are DataFrame code and
their oracle (:mod:`stratum.plans.warehouse_queries`) is independent SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.plans.testdata import table
from stratum.sources.seeds import seed_frame
from stratum.sources.specs import ALL_SOURCES

_REGION_STATE = "upper(substr(r.r_name, 1, 2))"
_ZIP = "lpad(CAST({k} AS STRING), 5, '0')"

SOURCE_SQL = {
    "customers": f"""
SELECT concat('b', CAST(o.o_orderkey AS STRING)) AS customer_id,
       concat('c', CAST(o.o_custkey AS STRING)) AS customer_unique_id,
       {_ZIP.format(k='c.c_nationkey')} AS customer_zip_code_prefix,
       CASE WHEN c.c_mktsegment = 'BUILDING' THEN concat(' são ', lower(n.n_name))
            ELSE lower(n.n_name) END AS customer_city,
       {_REGION_STATE} AS customer_state
FROM {{orders}} o
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
JOIN {{region}} r ON n.n_regionkey = r.r_regionkey""",
    "orders": """
SELECT concat('o', CAST(o.o_orderkey AS STRING)) AS order_id,
       concat('b', CAST(o.o_orderkey AS STRING)) AS customer_id,
       CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END AS order_status,
       o.o_orderdate AS order_purchase_timestamp,
       CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_orderdate + INTERVAL 1 HOUR END AS order_approved_at,
       s.first_ship AS order_delivered_carrier_date,
       CASE WHEN o.o_orderstatus = 'F' THEN s.last_ship END AS order_delivered_customer_date,
       o.o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
FROM {orders} o
LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
           FROM {lineitem} GROUP BY l_orderkey) s ON o.o_orderkey = s.l_orderkey""",
    "order_items": """
SELECT concat('o', CAST(l_orderkey AS STRING)) AS order_id, l_linenumber AS order_item_id,
       concat('p', CAST(l_partkey AS STRING)) AS product_id, concat('s', CAST(l_suppkey AS STRING)) AS seller_id,
       l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_extendedprice * l_tax AS freight_value
FROM {lineitem}""",
    "order_payments": """
SELECT concat('o', CAST(l_orderkey AS STRING)) AS order_id, l_linenumber AS payment_sequential,
       CASE WHEN l_returnflag = 'A' THEN 'credit_card' WHEN l_returnflag = 'R' THEN 'boleto'
            WHEN l_linestatus = 'O' THEN 'voucher' ELSE 'not_defined' END AS payment_type,
       CAST(l_quantity AS INT) % 12 + 1 AS payment_installments,
       l_extendedprice AS payment_value
FROM {lineitem}""",
    "order_reviews": """
SELECT concat('r', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS review_id,
       concat('o', CAST(l_orderkey AS STRING)) AS order_id,
       CAST(l_quantity AS INT) % 5 + 1 AS review_score,
       CASE WHEN l_discount > 0.05 THEN ' Ótimo ' END AS review_comment_title,
       CAST(NULL AS STRING) AS review_comment_message,
       l_shipdate + INTERVAL 2 DAY AS review_creation_date,
       l_shipdate + INTERVAL 3 DAY AS review_answer_timestamp
FROM {lineitem} WHERE l_linestatus = 'F'""",
    "products": """
SELECT concat('p', CAST(p_partkey AS STRING)) AS product_id, lower(p_type) AS product_category_name,
       CAST(p_size + 0.5 AS DOUBLE) AS product_name_lenght, CAST(p_retailprice / 10 AS DOUBLE) AS product_description_lenght,
       CAST(p_size % 5 AS DOUBLE) AS product_photos_qty, p_retailprice AS product_weight_g,
       CAST(p_size AS DOUBLE) AS product_length_cm, CAST(p_size AS DOUBLE) AS product_height_cm,
       CAST(p_size AS DOUBLE) AS product_width_cm
FROM {part}""",
    "sellers": f"""
SELECT concat('s', CAST(s.s_suppkey AS STRING)) AS seller_id, {_ZIP.format(k='s.s_nationkey')} AS seller_zip_code_prefix,
       lower(n.n_name) AS seller_city, {_REGION_STATE} AS seller_state
FROM {{supplier}} s JOIN {{nation}} n ON s.s_nationkey = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey""",
    "geolocation": f"""
SELECT {_ZIP.format(k='c.c_nationkey')} AS geolocation_zip_code_prefix, c.c_acctbal / 1000.0 AS geolocation_lat,
       0.0 - c.c_acctbal / 2000.0 AS geolocation_lng, lower(n.n_name) AS geolocation_city,
       {_REGION_STATE} AS geolocation_state
FROM {{customer}} c JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey""",
    "category_translation": """
SELECT DISTINCT lower(p_type) AS product_category_name, concat(lower(p_type), '_en') AS product_category_name_english
FROM {part} WHERE p_type <> 'PROMO'""",
    "states": f"""
SELECT {_REGION_STATE} AS UF, r.r_name AS State, min(n.n_name) AS Capital,
       CASE r.r_name WHEN 'AMERICA' THEN 'Southeast' WHEN 'ASIA' THEN 'Northeast' ELSE 'Central' END AS Region,
       CAST(count(*) * 1000 AS DOUBLE) AS Area, CAST(count(*) * 100000 AS BIGINT) AS Population,
       CAST(100.0 AS DOUBLE) AS Demographic_Density, CAST(count(*) AS BIGINT) AS Cities_count, CAST(count(*) AS DOUBLE) AS GDP,
       CAST(0.2 AS DOUBLE) AS GDP_rate, CAST(0.1 AS DOUBLE) AS Poverty, CAST(min(n.n_nationkey) AS DOUBLE) AS Latitude,
       CAST(max(n.n_nationkey) AS DOUBLE) AS Longitude
FROM {{region}} r JOIN {{nation}} n ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name""",
    "airports": f"""
SELECT {_REGION_STATE} AS UF, CAST(count(*) AS DOUBLE) / 100.0 AS Passengers_rate
FROM {{supplier}} s JOIN {{nation}} n ON s.s_nationkey = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name""",
    "icu_beds": f"""
SELECT {_REGION_STATE} AS UF, CAST(count(*) AS BIGINT) AS ICU_beds,
       CAST(sum(CASE WHEN c.c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) AS BIGINT) AS Public_beds,
       CAST(sum(CASE WHEN c.c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END) AS BIGINT) AS Private_beds,
       CAST(0.1 AS DOUBLE) AS Public_beds_per_citizen, CAST(0.4 AS DOUBLE) AS Private_beds_per_citizen
FROM {{customer}} c JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name""",
    "hdi": f"""
SELECT {_REGION_STATE} AS UF, {{hdi_cols}}
FROM {{region}} r""",
}

_HDI_COLS = ", ".join(
    f"CAST(0.5 + r.r_regionkey / 20.0 - {k} * 0.05 AS DOUBLE) AS HDI{part.replace(' ', '_')}_{y}"
    for k, y in enumerate((2017, 2010, 2000, 1991)) for part in ("", " Education", " Wealth", " Health"))

TABLES = ["orders", "lineitem", "customer", "nation", "region", "part", "supplier"]

# Fixed seed rows for the derived data (cities are nation names).
SEED_ROWS = {
    "typo_cure": ([("NATION1", "NATION ONE"), ("SAO NATION2", "SAO NATION TWO"), ("NATION_5", "NEVER")],
                  "original_city string, fixed_city string", "original_city"),
    "zip_code_fix": ([("00003", "NATION THREE")], "zip_code_prefix string, city_associated string", "zip_code_prefix"),
    "municipality_map": ([("NATION ONE", "MUNICIPALITY ONE"), ("NATION THREE", "MUNICIPALITY THREE"),
                          ("NATION4", "NATION4"), ("SAO NATION TWO", "MUNICIPALITY TWO")],
                         "locality string, municipality string", "locality"),
    "category_map": ([("economy", "Value"), ("promo", "Marketing"), ("standard", "Core"), ("pc_gamer", "Electronics")],
                     "raw_category string, business_area string", "raw_category"),
}


def source_sql(name: str, dialect: str = "spark") -> str:
    """The derivation of one raw table; ``dialect='sql'`` names the plain
    tables (``{orders}`` -> ``orders``) for the oracle engine."""
    sql = SOURCE_SQL[name].replace("{hdi_cols}", _HDI_COLS) if name == "hdi" else SOURCE_SQL[name]
    if dialect == "sql":
        for t in TABLES:
            sql = sql.replace("{" + t + "}", t)
    return sql


def derived_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One marketplace raw table, derived by Spark from the test tables, with
    the declared column names and types of its source spec."""
    frames = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in SOURCE_SQL[name]}
    sql = SOURCE_SQL[name].replace("{hdi_cols}", _HDI_COLS) if name == "hdi" else SOURCE_SQL[name]
    df = spark.sql(sql, **frames)
    spec = ALL_SOURCES[name]
    # derived names use '_' where the declared names have spaces
    return df.select(*[df[c].cast(f.dataType).alias(f.name)
                       for c, f in zip(df.columns, spec.schema.fields)])


def derived_seed(spark: SparkSession, name: str) -> DataFrame:
    rows, schema, key = SEED_ROWS[name]
    return seed_frame(spark, rows, schema, key)


def materialize(spark: SparkSession, sf_dir: str, cfg) -> None:
    """Write every derived raw table under ``cfg.source_base`` and the seed
    rows as CSV under ``cfg.seeds_dir``, so :func:`stratum.plans.runner.run`
    can build the warehouse from them like from ingested files."""
    from stratum.sources.specs import ALL_SOURCES as specs

    for name in SOURCE_SQL:
        derived_source(spark, sf_dir, name).write.mode("overwrite").parquet(
            cfg.source_path(specs[name].namespace, name))
    for name in SEED_ROWS:
        derived_seed(spark, name).coalesce(1).write.mode("overwrite").option("header", "true") \
            .csv(f"{cfg.seeds_dir.rstrip('/')}/{name}.csv")
