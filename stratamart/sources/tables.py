"""Parquet tables of the Bronze, Silver and Gold layers: one directory per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stratamart.contracts import FACT_PARTITION
from stratamart.functions.columns import interval_days


def table_path(base_dir: str, layer: str, table: str) -> str:
    return f"{base_dir.rstrip('/')}/{layer}/{table}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``; running twice leaves the same rows."""
    df.write.mode("overwrite").parquet(path)


def write_compacted(df: DataFrame, path: str) -> None:
    """Replace the table at ``path`` by as few files as its size allows.

    For Gold tables: a small result becomes one file, a large one is still written in parallel.
    Adaptive execution merges the partitions of the rebalance up to the advisory size and splits
    those above it. The upstream stages keep their own parallelism.
    """
    df.hint("rebalance").write.mode("overwrite").parquet(path)


def write_fact(fact: DataFrame, path: str) -> None:
    """Replace the fact at ``path``, partitioned by order month.

    The 90-day slice then reads four months instead of the whole history. Rows are brought together
    by month first, otherwise each task would open a file per month; the rebalance splits a month
    that is too large for one task.
    """
    (
        fact.withColumn(FACT_PARTITION, F.date_format("order_date", "yyyyMM").cast("int"))
        .hint("rebalance", FACT_PARTITION)
        .write.mode("overwrite")
        .partitionBy(FACT_PARTITION)
        .parquet(path)
    )


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The logical fact: the physical partition column is left out."""
    return spark.read.parquet(path).drop(FACT_PARTITION)


def newest_order_bound(spark: SparkSession, fact_path: str, days: int) -> Row:
    """First moment of the trailing window as one row ``(bound, month)``; both NULL without dates.

    The newest month is the fact's own newest partition, and only that month is scanned for the
    date. The bound is text, which keeps it independent of the time zone of the Python process.
    """
    months = spark.read.parquet(fact_path).agg(F.max(FACT_PARTITION).alias("month"))
    newest_month = months.scalar()
    bound = F.max("order_date") - interval_days(days)
    return (
        spark.read.parquet(fact_path)
        .filter(F.col(FACT_PARTITION) == newest_month)
        .agg(
            bound.cast("string").alias("bound"),
            F.date_format(bound, "yyyyMM").cast("int").alias("month"),
        )
        .head()
    )


def read_fact_since(spark: SparkSession, path: str, bound: str | None, month: int | None) -> DataFrame:
    """Fact rows with ``order_date >= bound``; no rows where the bound is NULL.

    As literals the bounds select month directories at planning time and row groups in the scan.
    """
    rows = spark.read.parquet(path)
    moment = F.lit(bound).cast(rows.schema["order_date"].dataType)
    return rows.filter((F.col(FACT_PARTITION) >= F.lit(month)) & (F.col("order_date") >= moment)).drop(
        FACT_PARTITION
    )
