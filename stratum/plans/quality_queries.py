"""The warehouse's declared checks over its gold models, with faults planted.

The models are the real ones over sources derived from the test tables
(:mod:`stratum.plans.marketplace_views`); a fixed rule per table then breaks some
of their rows, so that every kind of check has something to find.  The checks are
the declared ones (``Model.checks``), made as a build makes them: row-level
counts while the table is written, orphans in one pass per parent.  The oracle
counts each violation by itself, over the models' own oracle SQL.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.quality import (REPORT_SCHEMA, Relationships, evaluate, observed, observed_report, orphan_report,
                                       row_level)
from stratum.plans.runner import LazyContext
from stratum.plans.warehouse import DATE_END, DATE_START, MODEL_INDEX
from stratum.plans.warehouse_queries import ORACLE as MODEL_SQL
from stratum.plans.warehouse_queries import lazy_warehouse
from stratum.session import delete_path, scratch_path

CHECKED = ["dim_states", "dim_socio_economics", "dim_customers", "dim_sellers", "dim_products", "fct_orders",
           "fct_order_items"]

# Planted faults, per table: a row's number, columns as they become where the
# number is a multiple of something, and the multiple whose rows come twice.
_N = "CAST(substr({}, 2) AS BIGINT)"
PLANTED = {
    "dim_states": ("ascii(substr(state_id, 1, 1))", {"capital": (5, "NULL"), "state_name": (3, "NULL")}, 7),
    "dim_customers": (_N.format("customer_id"), {"city": (61, "NULL"), "state_id": (67, "'XX'"),
                                                 "zip_code_prefix": (59, "NULL")}, 71),
    "dim_sellers": (_N.format("seller_id"), {"state_id": (13, "NULL"), "zip_code_prefix": (11, "NULL")}, 17),
    "dim_products": (_N.format("product_id"), {}, 89),
    "fct_orders": (_N.format("order_id"), {
        "customer_id": (101, "'nobody'"), "status": (103, "NULL"), "days_to_deliver": (107, "-1"),
        "credit_card_value": (109, "credit_card_value + 5"), "order_date_id": (113, "NULL"),
        "delivered_customer_date": (127, "TIMESTAMP_NTZ '1990-01-01 00:00:00'")}, 131),
    "fct_order_items": (_N.format("order_id"), {
        "total_item_value": (101, "total_item_value + 1"), "product_id": (103, "'none'"), "seller_id": (107, "NULL"),
        "price": (109, "NULL"), "order_id": (113, "'lost'"), "shipping_date_id": (137, "NULL")}, 127),
}


def _cells(name: str, columns: list[str]) -> list[str]:
    number, changes, _ = PLANTED[name]
    return [f"CASE WHEN {number} % {changes[c][0]} = 0 THEN {changes[c][1]} ELSE {c} END AS {c}" if c in changes else c
            for c in columns]


def planted(df: DataFrame, name: str) -> DataFrame:
    """The table with its planted faults.  A row that comes twice is repeated
    where it is made: the table's plan is in the plan once, not once more for
    the second copies."""
    number, _, twice = PLANTED[name]
    copies = f"array_repeat(0, CASE WHEN {number} % {twice} = 0 THEN 2 ELSE 1 END)"
    # the outer explode of an array that is never empty: no filter on the copies is pushed to the sources
    return df.selectExpr(*_cells(name, df.columns), f"{copies} AS __copies").select(*df.columns, F.explode_outer("__copies")) \
             .select(*df.columns)


def planted_sql(name: str, source: str, columns: list[str]) -> str:
    """The same table in SQL."""
    number, _, twice = PLANTED[name]
    cells = _cells(name, columns)
    return (f"SELECT {', '.join(cells)} FROM {source} UNION ALL "
            f"SELECT {', '.join(cells)} FROM {source} WHERE {number} % {twice} = 0")


class _Planted(LazyContext):
    """Models with their planted faults, each written once and its row-level
    checks counted meanwhile."""

    def __init__(self, spark: SparkSession, plain: LazyContext):
        super().__init__(spark, plain.source, plain.seed)
        self.plain = plain

    def ref(self, name: str) -> DataFrame:
        if name not in self.frames:
            df = self.plain.ref(name)
            if name in PLANTED:
                df = planted(df, name)
            checks = row_level(MODEL_INDEX[name].checks(self)) if name in CHECKED else []
            counted, seen = observed(df, checks)
            path = scratch_path(self.spark, f"quality-{name}")
            self.scratch.append(path)
            counted.write.parquet(path)
            if seen is not None:
                self.seen[name] = (seen, checks)
            self.frames[name] = self.spark.read.schema(df.schema).parquet(path)
        return self.frames[name]


def warehouse_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared check of the gold models: violations and status.  The
    report is a row per check, so it is held on the driver."""
    ctx = _Planted(spark, lazy_warehouse(spark, sf_dir))
    try:
        orphans, report = [], None
        for name in CHECKED:
            df, checks = ctx.ref(name), MODEL_INDEX[name].checks(ctx)
            orphans += [(name, df, replace(c, parent=c.parent())) for c in checks if isinstance(c, Relationships)]
            rest = evaluate(df, [c for c in checks if c not in row_level(checks) and not isinstance(c, Relationships)], name)
            report = rest if report is None else report.unionByName(rest)
        rows = report.unionByName(orphan_report(orphans)).collect()  # one job of independent stages
        for name, (seen, flat) in ctx.seen.items():
            rows += observed_report(spark, seen, flat, name).collect()
        return spark.createDataFrame(rows, REPORT_SCHEMA)
    finally:
        ctx.close()


# ------------------------------------------------------------------ oracle
_COLUMNS = {
    "dim_states": "state_id state_name capital region area_km2 cities_number latitude longitude",
    "dim_customers": "customer_id zip_code_prefix city state_id latitude longitude total_orders",
    "dim_sellers": "seller_id zip_code_prefix city state_id latitude longitude",
    "dim_products": "product_id category_name business_area",
    "fct_orders": "order_id customer_id order_date_id status delivered_customer_date days_to_deliver credit_card_value "
                  "boleto_value voucher_value debit_card_value total_payment_value",
    "fct_order_items": "order_item_id order_id product_id seller_id shipping_date_id item_sequence_number price "
                       "freight_value total_item_value",
}


def _tables() -> str:
    out = []
    for name in CHECKED:
        plain = MODEL_SQL[f"warehouse_{name}"]
        out.append(f"plain_{name} AS ({plain})")
        body = planted_sql(name, f"plain_{name}", _COLUMNS[name].split()).replace("TIMESTAMP_NTZ", "TIMESTAMP") \
            if name in PLANTED else f"SELECT * FROM plain_{name}"
        out.append(f"{name} AS MATERIALIZED ({body})")
    return ",\n".join(out)


def _missing(table: str, *columns: str) -> list[str]:
    return [f"SELECT '{table}', 'not_null_{c}', '{c}', (SELECT count(*) - count({c}) FROM {table})" for c in columns]


def _twice(table: str, c: str) -> list[str]:
    return [f"SELECT '{table}', 'unique_{c}', '{c}', (SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL "
            f"GROUP BY {c} HAVING count(*) >= 2))", *_missing(table, c)]


def _lost(table: str, c: str, parent: str, to: str | None = None) -> list[str]:
    known = f"SELECT {to or c} FROM {parent} WHERE {to or c} IS NOT NULL" if parent != "dim_date" else \
        f"SELECT CAST(d AS DATE) FROM range(DATE '{DATE_START}', DATE '{DATE_END}', INTERVAL 1 DAY) AS days(d)"
    return [f"SELECT '{table}', 'relationships_{c}_{parent}', '{c}', "
            f"(SELECT count(*) FROM {table} WHERE {c} IS NOT NULL AND {c} NOT IN ({known}))"]


def _rule(table: str, name: str, column: str, violation: str) -> list[str]:
    return [f"SELECT '{table}', '{name}', '{column}', (SELECT count(*) FROM {table} WHERE {violation})"]


_ROWS = [
    *_twice("dim_states", "state_id"), *_missing("dim_states", "state_name", "capital"),
    *_twice("dim_socio_economics", "state_id"), *_lost("dim_socio_economics", "state_id", "dim_states"),
    *_twice("dim_customers", "customer_id"), *_missing("dim_customers", "zip_code_prefix", "city", "state_id"),
    *_lost("dim_customers", "state_id", "dim_states"),
    *_twice("dim_sellers", "seller_id"), *_missing("dim_sellers", "zip_code_prefix", "state_id"),
    *_lost("dim_sellers", "state_id", "dim_states"),
    *_twice("dim_products", "product_id"),
    *_twice("fct_orders", "order_id"), *_missing("fct_orders", "customer_id", "order_date_id", "status"),
    *_lost("fct_orders", "customer_id", "dim_customers"), *_lost("fct_orders", "order_date_id", "dim_date"),
    *_rule("fct_orders", "range_days_to_deliver", "days_to_deliver", "days_to_deliver < 0"),
    *_rule("fct_orders", "payment_breakdown_matches_total", "total_payment_value",
           "total_payment_value IS NOT NULL AND abs(total_payment_value - "
           "(credit_card_value + boleto_value + voucher_value + debit_card_value)) > 0.01"),
    *_rule("fct_orders", "delivery_date_after_purchase", "delivered_customer_date", "delivered_customer_date < order_date_id"),
    *_twice("fct_order_items", "order_item_id"),
    *_missing("fct_order_items", "order_id", "product_id", "seller_id", "shipping_date_id", "item_sequence_number", "price",
              "freight_value", "total_item_value"),
    *_lost("fct_order_items", "order_id", "fct_orders"), *_lost("fct_order_items", "product_id", "dim_products"),
    *_lost("fct_order_items", "seller_id", "dim_sellers"), *_lost("fct_order_items", "shipping_date_id", "dim_date"),
    *_rule("fct_order_items", "total_item_value_is_price_plus_freight", "total_item_value",
           "abs(total_item_value - (price + freight_value)) > 0.01"),
]

REPORT_SQL = f"""
WITH {_tables()}
SELECT table_name, check_name, column_name, violations, if(violations = 0, 'pass', 'error') AS status
FROM ({' UNION ALL '.join(_ROWS)}) AS counted(table_name, check_name, column_name, violations)
"""

QUERIES = {"warehouse_quality_report": warehouse_quality_report}
ORACLE = {"warehouse_quality_report": REPORT_SQL}
