"""Gold: 90-day sales summary and behaviour features per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart import contracts
from stratamart.operators.facts import newest_date
from stratamart.operators.features import all_features
from stratamart.operators.rollups import customer_rollup, sales_totals
from stratamart.session import tuned
from stratamart.sources.tables import (
    newest_order_bound,
    read_fact_since,
    read_table,
    table_path,
    write_compacted,
)


def active_customers(
    dim_customer: DataFrame,
    channel: str = contracts.CHANNEL_TRADITIONAL,
    state: str = contracts.STATE_ACTIVE,
) -> DataFrame:
    """Keys of the active customers of a channel; values are compared exactly."""
    return dim_customer.filter((F.col("canal") == channel) & (F.col("estado") == state)).select(
        "customer_id"
    )


def build_gold_sales_by_customer(fact_3m: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Sales totals per customer with the customer's attributes; unknown customers stay."""
    return sales_totals(fact_3m).join(dim_customer, "customer_id", "left")


def build_customer_features(
    fact_3m: DataFrame, reference: Column | None = None, credit: str = contracts.PAYMENT_CREDIT
) -> DataFrame:
    """The eight features for every customer of the window.

    ``reference`` may name the newest date where it is known more cheaply than from ``fact_3m``.
    """
    reference = newest_date(fact_3m) if reference is None else reference
    return customer_rollup(fact_3m, credit).select("customer_id", *all_features(reference))


def build_dim_features(
    fact_3m: DataFrame,
    dim_customer: DataFrame,
    reference: Column | None = None,
    channel: str = contracts.CHANNEL_TRADITIONAL,
    state: str = contracts.STATE_ACTIVE,
    credit: str = contracts.PAYMENT_CREDIT,
) -> DataFrame:
    """Features of the active customers of the channel with at least one order in the window."""
    features = build_customer_features(fact_3m, reference, credit)
    return (
        features.filter(F.col("frecuencia_pedidos_3m") >= 1)
        .join(active_customers(dim_customer, channel, state), "customer_id")
        .select(*contracts.DIM_FEATURES.fieldNames())
    )


def run_gold(spark: SparkSession, base_dir: str, days: int = contracts.WINDOW_DAYS) -> None:
    """Build the Gold tables from Silver; only the window's bound visits the driver."""
    with tuned(spark):
        _run_gold(spark, base_dir, days)


def _run_gold(spark: SparkSession, base_dir: str, days: int) -> None:
    def path(layer: str, table: str) -> str:
        return table_path(base_dir, layer, table)

    fact_path = path("silver", "fact_order_line")
    bound = newest_order_bound(spark, fact_path, days)
    fact_3m = read_fact_since(spark, fact_path, bound.bound, bound.month)
    dim_customer = read_table(spark, path("silver", "dim_customer"))
    write_compacted(
        build_gold_sales_by_customer(fact_3m, dim_customer), path("gold", "gold_sales_customer_3m")
    )
    write_compacted(build_dim_features(fact_3m, dim_customer), path("gold", "dim_features"))
