"""The whole chain: raw CSV to Bronze to Silver to Gold."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from stratamart import contracts
from stratamart.plans.bronze import run_bronze
from stratamart.plans.gold import run_gold
from stratamart.plans.silver import run_silver


def run_medallion(
    spark: SparkSession,
    base_dir: str,
    schemas: dict[str, StructType | None] = contracts.BRONZE,
) -> None:
    """Rebuild all layers under ``base_dir`` from ``base_dir/raw``.

    ``schemas`` are those of the CSV extracts; types of tables not in it are inferred.
    """
    run_bronze(spark, base_dir, schemas)
    run_silver(spark, base_dir)
    run_gold(spark, base_dir)
