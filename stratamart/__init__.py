"""Retail medallion analytics on Spark: Bronze, Silver and Gold layers with a quality report."""

from stratamart.operators.checks import (
    check_between_0_1,
    check_fk,
    check_keys_unique,
    check_no_negative,
    check_nulls,
)
from stratamart.operators.facts import build_fact_last_3m, build_fact_order_line
from stratamart.plans.bronze import (
    ingest_customers,
    ingest_orders_detail,
    ingest_orders_header,
    ingest_products,
    run_bronze,
)
from stratamart.plans.gold import build_dim_features, build_gold_sales_by_customer, run_gold
from stratamart.plans.medallion import run_medallion
from stratamart.plans.quality import quality_report, run_quality_report
from stratamart.plans.silver import (
    build_dim_customer,
    build_dim_date,
    build_dim_product,
    run_silver,
)

__all__ = [
    "build_dim_customer",
    "build_dim_date",
    "build_dim_features",
    "build_dim_product",
    "build_fact_last_3m",
    "build_fact_order_line",
    "build_gold_sales_by_customer",
    "check_between_0_1",
    "check_fk",
    "check_keys_unique",
    "check_no_negative",
    "check_nulls",
    "ingest_customers",
    "ingest_orders_detail",
    "ingest_orders_header",
    "ingest_products",
    "quality_report",
    "run_bronze",
    "run_gold",
    "run_medallion",
    "run_quality_report",
    "run_silver",
]
