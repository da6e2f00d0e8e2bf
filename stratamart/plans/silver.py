"""Silver: typed, deduplicated dimensions and the order-line fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stratamart import contracts
from stratamart.functions.columns import calendar_columns
from stratamart.functions.typing import Types, apply_contract, measured_types, rejected_values
from stratamart.operators.dedup import keep_one_per_key
from stratamart.operators.facts import build_fact_order_line
from stratamart.session import tuned
from stratamart.sources.tables import read_table, table_path, write_fact, write_table


def build_dim_customer(customers: DataFrame) -> DataFrame:
    """One row per customer, all columns."""
    return keep_one_per_key(customers, ["customer_id"])


def build_dim_product(products: DataFrame) -> DataFrame:
    """One row per product, all columns."""
    return keep_one_per_key(products, ["product_id"])


def build_dim_date(dated: DataFrame) -> DataFrame:
    """One row per calendar date of ``order_date``; NULL dates give one row of NULLs.

    Takes the fact or, since a left join keeps every order, the valid order headers.
    """
    dates = dated.selectExpr("CAST(order_date AS DATE) AS date").distinct()
    return dates.selectExpr(*calendar_columns("date"))


Source = tuple[DataFrame, StructType, Types]


def silver_source(spark: SparkSession, base_dir: str, table: str) -> Source:
    """A Bronze table, the part of its contract that it has columns for, and its measured types."""
    rows = read_table(spark, table_path(base_dir, "bronze", table))
    known = StructType([field for field in contracts.BRONZE[table] if field.name in rows.columns])
    return rows, known, measured_types(rows, known)


def silver_input(source: Source) -> DataFrame:
    """A Bronze table with its measured types; columns outside the contract are carried along.

    Sources may lack descriptive columns of the contract; the columns an operator needs are named by
    that operator.
    """
    rows, contract, types = source
    return apply_contract(rows, contract, types=types)


def silver_rejects(sources: dict[str, Source]) -> DataFrame:
    """Values of Bronze tables that are no number, date or flag, with table, column and source file."""
    found = [
        rejected_values(rows, contract, table, types)
        for table, (rows, contract, types) in sources.items()
    ]
    return reduce(DataFrame.unionByName, found)


def run_silver(spark: SparkSession, base_dir: str) -> None:
    """Build the Silver tables. The fact is computed once; the calendar reads it back.

    ``rejects`` keeps every value that became NULL because it is none of its column's kind.
    """
    with tuned(spark):
        _run_silver(spark, base_dir)


def _run_silver(spark: SparkSession, base_dir: str) -> None:
    def silver(table: str) -> str:
        return table_path(base_dir, "silver", table)

    sources = {table: silver_source(spark, base_dir, table) for table in contracts.BRONZE}
    typed = {table: silver_input(source) for table, source in sources.items()}
    write_table(silver_rejects(sources), silver("rejects"))
    write_table(build_dim_customer(typed["customers"]), silver("dim_customer"))
    write_table(build_dim_product(typed["products"]), silver("dim_product"))
    fact = build_fact_order_line(typed["orders_header"], typed["orders_detail"])
    write_fact(fact, silver("fact_order_line"))
    write_table(build_dim_date(read_table(spark, silver("fact_order_line"))), silver("dim_date"))
