"""The complete quality report over the tables of all layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from stratamart import contracts
from stratamart.operators import checks
from stratamart.plans.gold import active_customers
from stratamart.sources.tables import read_fact, read_table, table_path

FACT_AMOUNTS = ["qty_units", "order_net_amount", "line_net_amount"]
OPTIONAL_FEATURES = ["ticket_promedio_3m", "dias_promedio_entre_pedidos"]
SHARE_FEATURES = ["porcentaje_pedidos_promo_3m", "mix_credito_vs_contado_3m"]
NON_NEGATIVE_FEATURES = [
    name
    for name in contracts.DIM_FEATURES.fieldNames()
    if name != "customer_id" and name not in SHARE_FEATURES
]


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Every check of every layer as report rows.

    Expects the four Bronze tables, ``rejects``, ``dim_customer``, ``dim_product``, ``fact_order_line``,
    ``gold_sales_customer_3m`` and ``dim_features``. Column checks take one aggregation per table.
    """
    dim_customer, dim_product = tables["dim_customer"], tables["dim_product"]
    fact = tables["fact_order_line"]
    sales, features = tables["gold_sales_customer_3m"], tables["dim_features"]
    rejects = [
        checks.check_rejects(
            tables["rejects"], [c for c in contract.fieldNames() if c in tables[name].columns], name
        )
        for name, contract in contracts.BRONZE.items()
    ]
    parts = [
        *rejects,
        checks.profile(tables["customers"], "customers", nulls_except=(), row_count=True),
        checks.profile(tables["products"], "products", nulls_except=(), row_count=True),
        checks.profile(tables["orders_header"], "orders_header", row_count=True),
        checks.profile(tables["orders_detail"], "orders_detail", row_count=True),
        checks.profile(dim_customer, "dim_customer", nulls_except=(), row_count=True),
        checks.profile(dim_product, "dim_product", nulls_except=(), row_count=True),
        checks.profile(
            fact,
            "fact_order_line",
            nulls_except=["promo_flag"],
            non_negative=FACT_AMOUNTS,
            row_count=True,
        ),
        checks.check_keys_unique(dim_customer, "customer_id", "dim_customer"),
        checks.check_keys_unique(dim_product, "product_id", "dim_product"),
        checks.check_fk(dim_customer, fact, "customer_id", "dim_customer", "fact_order_line"),
        checks.check_fk(dim_product, fact, "product_id", "dim_product", "fact_order_line"),
        checks.profile(sales, "gold_sales_customer_3m", row_count=True),
        checks.features_contract(features),
        checks.check_keys_unique(features, "customer_id", "dim_features"),
        checks.profile(
            features,
            "dim_features",
            nulls_except=OPTIONAL_FEATURES,
            non_negative=NON_NEGATIVE_FEATURES,
            unit_range=SHARE_FEATURES,
            row_count=True,
        ),
        checks.check_eligible(features, active_customers(dim_customer), "dim_features"),
        checks.check_in_sales(features, sales, "dim_features"),
        checks.check_reconciled(features, sales, "dim_features"),
    ]
    return reduce(DataFrame.unionByName, parts)


def read_all_layers(spark: SparkSession, base_dir: str) -> dict[str, DataFrame]:
    """The nine tables of the report and the rejects, as stored."""
    tables = {
        name: read_table(spark, table_path(base_dir, layer, name))
        for layer, names in {
            "bronze": list(contracts.BRONZE),
            "silver": ["rejects", "dim_customer", "dim_product"],
            "gold": ["gold_sales_customer_3m", "dim_features"],
        }.items()
        for name in names
    }
    tables["fact_order_line"] = read_fact(spark, table_path(base_dir, "silver", "fact_order_line"))
    return tables


def run_quality_report(spark: SparkSession, base_dir: str) -> DataFrame:
    return quality_report(read_all_layers(spark, base_dir))


def fact_summary(spark: SparkSession, base_dir: str) -> DataFrame:
    """Numeric summary of the stored fact."""
    fact = read_fact(spark, table_path(base_dir, "silver", "fact_order_line"))
    return checks.numeric_summary(fact, FACT_AMOUNTS)
