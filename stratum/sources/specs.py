"""Declared raw sources: logical name -> file, declared schema, freshness.

Schemas are declared, never inferred: identifiers and postcodes stay text
(``01307`` keeps its leading zero), lifecycle timestamps are read as
timestamps without zone.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

from stratum.operators.freshness import FreshnessPolicy

S, D, I, L, TS, DT = StringType(), DoubleType(), IntegerType(), LongType(), TimestampNTZType(), DateType()


def _schema(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


@dataclass(frozen=True)
class SourceSpec:
    """A raw table: where it comes from and what it looks like."""
    name: str
    filename: str
    schema: StructType
    namespace: str
    loaded_at: str | None = None
    freshness: FreshnessPolicy | None = None
    options: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


DAILY = FreshnessPolicy(warn_after=dt.timedelta(hours=24), error_after=dt.timedelta(days=2))

# Marketplace sources.  File names default to ``{name}.csv``; a raw drop
# with other names is read through the ``filenames`` mapping of ingestion.
MARKETPLACE = [
    SourceSpec("orders", "orders.csv", _schema(
        ("order_id", S), ("customer_id", S), ("order_status", S), ("order_purchase_timestamp", TS),
        ("order_approved_at", TS), ("order_delivered_carrier_date", TS),
        ("order_delivered_customer_date", TS), ("order_estimated_delivery_date", TS)),
        "raw_market", loaded_at="order_purchase_timestamp", freshness=DAILY),
    SourceSpec("order_items", "order_items.csv", _schema(
        ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", TS), ("price", D), ("freight_value", D)), "raw_market"),
    SourceSpec("order_payments", "order_payments.csv", _schema(
        ("order_id", S), ("payment_sequential", I), ("payment_type", S), ("payment_installments", I),
        ("payment_value", D)), "raw_market"),
    SourceSpec("order_reviews", "order_reviews.csv", _schema(
        ("review_id", S), ("order_id", S), ("review_score", I), ("review_comment_title", S),
        ("review_comment_message", S), ("review_creation_date", TS), ("review_answer_timestamp", TS)),
        "raw_market", loaded_at="review_creation_date", freshness=DAILY,
        options={"multiLine": "true"}),  # comments hold line breaks
    SourceSpec("customers", "customers.csv", _schema(
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
        ("customer_city", S), ("customer_state", S)), "raw_market"),
    SourceSpec("sellers", "sellers.csv", _schema(
        ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S)),
        "raw_market"),
    SourceSpec("products", "products.csv", _schema(
        ("product_id", S), ("product_category_name", S), ("product_name_lenght", D),
        ("product_description_lenght", D), ("product_photos_qty", D), ("product_weight_g", D),
        ("product_length_cm", D), ("product_height_cm", D), ("product_width_cm", D)), "raw_market"),
    SourceSpec("geolocation", "geolocation.csv", _schema(
        ("geolocation_zip_code_prefix", S), ("geolocation_lat", D), ("geolocation_lng", D),
        ("geolocation_city", S), ("geolocation_state", S)), "raw_market"),
    SourceSpec("category_translation", "category_translation.csv", _schema(
        ("product_category_name", S), ("product_category_name_english", S)), "raw_market"),
]

HDI_YEARS = (2017, 2010, 2000, 1991)

# State statistics sources; column names contain spaces.
STATE_STATS = [
    SourceSpec("airports", "airports.csv", _schema(("UF", S), ("Passengers rate", D)), "raw_ibge"),
    SourceSpec("hdi", "hdi.csv", _schema(("UF", S), *[
        (f"HDI{part} {y}", D) for y in HDI_YEARS for part in ("", " Education", " Wealth", " Health")]),
        "raw_ibge"),
    SourceSpec("icu_beds", "icu-beds.csv", _schema(
        ("UF", S), ("ICU beds", L), ("Public beds", L), ("Private beds", L),
        ("Public beds per citizen", D), ("Private beds per citizen", D)), "raw_ibge"),
    SourceSpec("states", "states.csv", _schema(
        ("UF", S), ("State", S), ("Capital", S), ("Region", S), ("Area", D), ("Population", L),
        ("Demographic Density", D), ("Cities count", L), ("GDP", D), ("GDP rate", D), ("Poverty", D),
        ("Latitude", D), ("Longitude", D)), "raw_ibge"),
]

ALL_SOURCES = {s.name: s for s in MARKETPLACE + STATE_STATS}
