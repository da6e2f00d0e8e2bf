"""Command line: ``python -m stratamart build DIR`` and ``python -m stratamart report DIR``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from stratamart import contracts
from stratamart.operators.checks import preview
from stratamart.plans.medallion import run_medallion
from stratamart.plans.quality import fact_summary, read_all_layers, run_quality_report
from stratamart.session import tune
from stratamart.sources.tables import read_table, table_path, write_compacted

PREVIEWS = {
    "customers": "customer_id",
    "products": "product_id",
    "gold_sales_customer_3m": "customer_id",
    "dim_features": "customer_id",
}


def main() -> None:
    parser = argparse.ArgumentParser(prog="stratamart")
    parser.add_argument("action", choices=["build", "report"])
    parser.add_argument("base_dir", help="directory with raw/, bronze/, silver/ and gold/")
    parser.add_argument(
        "--infer", action="store_true", help="infer the types of the extracts (reads them twice)"
    )
    parser.add_argument(
        "--typed", action="store_true", help="stop at a value that the type of its column cannot hold"
    )
    args = parser.parse_args()

    spark = (
        SparkSession.builder.appName("stratamart")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    try:
        if args.action == "build":
            # By default any value is loaded; Silver measures the types and keeps what is no number.
            schemas = {name: contracts.as_text(kind) for name, kind in contracts.BRONZE.items()}
            if args.infer:
                schemas = {}
            elif args.typed:
                schemas = contracts.BRONZE
            run_medallion(spark, args.base_dir, schemas)
        else:
            tune(spark)
            tables = read_all_layers(spark, args.base_dir)
            for name, key in PREVIEWS.items():
                preview(tables[name], key).show(truncate=False)
            fact_summary(spark, args.base_dir).show(truncate=False)
            path = table_path(args.base_dir, "quality", "report")
            write_compacted(run_quality_report(spark, args.base_dir), path)
            report = read_table(spark, path)
            report.show(report.count(), truncate=False)  # a few rows per column of the tables
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
