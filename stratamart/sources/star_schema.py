"""The four retail source tables, derived from an order/line-item star schema.

Amounts and quantities are shifted so that the quality filters have something to remove; see
``FIXTURES.md``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratamart import contracts

# Columns read from the base tables. A declared schema saves the job that reads the footers.
BASE_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE",
}


def base_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    return spark.read.schema(BASE_SCHEMAS[table]).parquet(path)


def _conform(df: DataFrame, contract: StructType, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(
        *[
            f"CAST({columns[field.name]} AS {field.dataType.simpleString()}) AS {field.name}"
            for field in contract
        ]
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conform(
        base_table(spark, sf_dir, "customer"),
        contracts.CUSTOMERS,
        {
            "customer_id": "c_custkey",
            "customer_name": "c_name",
            "canal": "CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'tradicional' "
            "ELSE 'moderno' END",
            "estado": "CASE WHEN c_acctbal > 0 THEN 'activo' ELSE 'inactivo' END",
        },
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conform(
        base_table(spark, sf_dir, "part"),
        contracts.PRODUCTS,
        {
            "product_id": "p_partkey",
            "product_name": "p_name",
            "product_category": "p_type",
            "brand": "p_brand",
        },
    )


def orders_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conform(
        base_table(spark, sf_dir, "orders"),
        contracts.ORDERS_HEADER,
        {
            "order_id": "o_orderkey",
            "customer_id": "o_custkey",
            "order_date": "o_orderdate",
            "order_net_amount": "CAST(o_totalprice AS DECIMAL(18,2)) - 20000",
            "tipo_pago": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'credito' "
            "ELSE 'contado' END",
        },
    )


def orders_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = base_table(spark, sf_dir, "lineitem")
    parts = base_table(spark, sf_dir, "part")
    return _conform(
        lines.join(parts, F.expr("l_partkey = p_partkey")),
        contracts.ORDERS_DETAIL,
        {
            "order_id": "l_orderkey",
            "line_id": "l_linenumber",
            "product_id": "l_partkey",
            "qty_units": "CAST(l_quantity AS BIGINT) - 3",
            "line_net_amount": "CAST(l_extendedprice AS DECIMAL(18,2)) * "
            "(1 - CAST(l_discount AS DECIMAL(4,2)))",
            "promo_flag": "CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END",
            "product_category": "p_type",
        },
    )


SOURCES = {
    "customers": customers,
    "products": products,
    "orders_header": orders_header,
    "orders_detail": orders_detail,
}

BUSINESS_KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders_header": ["order_id"],
    "orders_detail": ["order_id", "line_id"],
}
