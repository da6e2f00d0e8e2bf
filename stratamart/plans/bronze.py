"""Bronze: CSV extracts as Parquet, unchanged but for load time and source file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stratamart import contracts
from stratamart.functions.columns import standardise_columns
from stratamart.sources.csv_extracts import read_csv_glob
from stratamart.sources.tables import table_path, write_table


def bronze_scan(
    spark: SparkSession, base_dir: str, table: str, schema: StructType | None = None
) -> DataFrame:
    """All extracts ``raw/<table>*.csv`` with load metadata; types are inferred without a schema.

    Extracts may differ in the order and number of their columns.
    """
    pattern = table_path(base_dir, "raw", f"{table}*.csv")
    scan = read_csv_glob(spark, pattern, schema, mixed_headers=True, metadata=True)
    return standardise_columns(scan)


def ingest(
    spark: SparkSession, base_dir: str, table: str, schema: StructType | None = None
) -> None:
    """Load one source table into ``bronze/<table>``."""
    write_table(bronze_scan(spark, base_dir, table, schema), table_path(base_dir, "bronze", table))


def ingest_customers(spark: SparkSession, base_dir: str, schema=contracts.CUSTOMERS) -> None:
    ingest(spark, base_dir, "customers", schema)


def ingest_products(spark: SparkSession, base_dir: str, schema=contracts.PRODUCTS) -> None:
    ingest(spark, base_dir, "products", schema)


def ingest_orders_header(
    spark: SparkSession, base_dir: str, schema=contracts.ORDERS_HEADER
) -> None:
    ingest(spark, base_dir, "orders_header", schema)


def ingest_orders_detail(
    spark: SparkSession, base_dir: str, schema=contracts.ORDERS_DETAIL
) -> None:
    ingest(spark, base_dir, "orders_detail", schema)


def run_bronze(
    spark: SparkSession,
    base_dir: str,
    schemas: dict[str, StructType | None] = contracts.BRONZE,
) -> None:
    """Load the four source tables. The types of a table without a schema are inferred."""
    for table in contracts.BRONZE:
        ingest(spark, base_dir, table, schemas.get(table))
