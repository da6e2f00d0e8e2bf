"""Registered queries: each runs one operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from stratamart import contracts
from stratamart.functions.columns import standardise_columns
from stratamart.functions.typing import apply_contract, reject_counts
from stratamart.operators import checks, features, rollups
from stratamart.operators.facts import (
    attach_lines,
    build_fact_last_3m,
    build_fact_order_line,
    build_recent_activity,
    build_recent_fact,
    clean_lines,
    clean_orders,
    newest_date,
    positive,
)
from stratamart.operators.dedup import keep_one_per_key
from stratamart.plans.bronze import ingest
from stratamart.plans.gold import (
    active_customers,
    build_customer_features,
    build_dim_features,
    build_gold_sales_by_customer,
    run_gold,
)
from stratamart.plans.medallion import run_medallion
from stratamart.plans.quality import FACT_AMOUNTS, read_all_layers, run_quality_report
from stratamart.plans.silver import build_dim_customer, build_dim_date, build_dim_product, run_silver
from stratamart.session import scratch_dir, tune
from stratamart.sources.csv_extracts import read_csv_glob, with_ingest_metadata, write_csv_extracts
from stratamart.sources.star_schema import (
    BUSINESS_KEYS,
    SOURCES,
    customers,
    orders_detail,
    orders_header,
    products,
)
from stratamart.sources.tables import read_table, table_path, write_compacted, write_table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = build.__doc__
        _QUERIES[name] = run
        return run

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _published(df: DataFrame) -> DataFrame:
    """Amounts as doubles."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact_order_line(orders_header(spark, sf_dir), orders_detail(spark, sf_dir))


def _recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of the window."""
    headers = orders_header(spark, sf_dir)
    return build_recent_fact(clean_orders(headers), orders_detail(spark, sf_dir), headers=headers)


def _activity(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column]:
    """Rows of the window for order and customer rollups, and the newest order date."""
    headers = orders_header(spark, sf_dir)
    orders = clean_orders(headers)
    newest = newest_date(orders)
    lines = orders_detail(spark, sf_dir)
    return build_recent_activity(orders, lines, newest=newest, headers=headers), newest


def _customer_stats(fact_3m: DataFrame) -> DataFrame:
    return rollups.customer_order_stats(rollups.order_rollup(fact_3m))


# Sources and sinks


def _raw_extracts(spark: SparkSession, sf_dir: str, tables: list[str], purpose: str) -> str:
    """A new base directory whose raw layer holds the tables as CSV extracts."""
    base_dir = scratch_dir(spark, purpose)
    for table in tables:
        write_csv_extracts(
            SOURCES[table](spark, sf_dir), f"{base_dir}/raw", table, BUSINESS_KEYS[table][0]
        )
    return base_dir


def _stored_layers(spark: SparkSession, sf_dir: str, purpose: str) -> str:
    """A new base directory with Bronze from the test tables, and Silver and Gold built from it."""
    base_dir = scratch_dir(spark, purpose)
    for table, source in SOURCES.items():
        write_table(source(spark, sf_dir), table_path(base_dir, "bronze", table))
    run_silver(spark, base_dir)
    run_gold(spark, base_dir)
    return base_dir


@_query("csv_glob_scan")
def csv_glob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base_dir = _raw_extracts(spark, sf_dir, ["customers"], "csv")
    return read_csv_glob(spark, f"{base_dir}/raw/customers*.csv", contracts.CUSTOMERS)


@_query("csv_glob_mixed_headers")
def csv_glob_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts of which half have their columns in another order, under other names, and one more."""
    base_dir = scratch_dir(spark, "mixed")
    rows = customers(spark, sf_dir)
    odd = rows.where("customer_id % 2 = 1").select(
        "estado",
        F.substring("customer_name", 1, 3).alias("Región"),
        F.col("customer_id").alias("Customer ID"),
        "canal",
        "customer_name",
    )
    write_csv_extracts(rows.where("customer_id % 2 = 0"), f"{base_dir}/raw", "customers", "customer_id")
    write_csv_extracts(odd, f"{base_dir}/raw", "customers", "Customer ID")
    pattern = f"{base_dir}/raw/customers*.csv"
    return read_csv_glob(spark, pattern, contracts.CUSTOMERS, mixed_headers=True)


@_query("ingest_metadata")
def ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    base_dir = _raw_extracts(spark, sf_dir, ["customers"], "metadata")
    rows = with_ingest_metadata(
        read_csv_glob(spark, f"{base_dir}/raw/customers*.csv", contracts.CUSTOMERS)
    )
    extract = F.regexp_extract(contracts.SOURCE_FILE, r"customers_part(?:=|%3D)(\d+)\.csv", 1)
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(contracts.INGESTION_TIMESTAMP).alias("rows_with_load_time"),
        F.count_distinct(extract).alias("extracts"),
    )


def _bronze(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        base_dir = _raw_extracts(spark, sf_dir, [table], "bronze")
        ingest(spark, base_dir, table, contracts.BRONZE[table])
        stored = read_table(spark, table_path(base_dir, "bronze", table))
        return _published(stored.drop(*contracts.METADATA_COLUMNS))

    return run


for _table in contracts.BRONZE:
    _query(f"bronze_{_table}")(_bronze(_table))


@_query("standardise_columns")
def standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    untidy = customers(spark, sf_dir).toDF(" Customer ID ", "Customer-Name", "CANAL", "estado ")
    return standardise_columns(untidy)


def _headers_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers as text, with unreadable amounts and dates, text keys and amounts that are finer
    than the contract put in."""
    headers = orders_header(spark, sf_dir)
    amount = F.col("order_net_amount").cast("string")
    return headers.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.concat(F.lit("C"), F.col("customer_id").cast("string")).alias("customer_id"),
        F.when(F.col("order_net_amount") <= 0, "unknown")
        .otherwise(F.date_format("order_date", "yyyy-MM-dd HH:mm:ss"))
        .alias("order_date"),
        F.when(F.col("tipo_pago") == "credito", "x")
        .when(F.col("order_id") % 7 == 0, F.concat(amount, F.lit("0000000001")))
        .otherwise(amount)
        .alias("order_net_amount"),
        "tipo_pago",
    )


@_query("typed_silver")
def typed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(apply_contract(_headers_as_text(spark, sf_dir), contracts.ORDERS_HEADER))


@_query("typed_silver_rejects")
def typed_silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(_headers_as_text(spark, sf_dir), contracts.ORDERS_HEADER)


def _loose_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with half units and as floating point, as an inferred load has them."""
    lines = orders_detail(spark, sf_dir)
    half = F.when(F.col("line_id") == 2, 0.5).otherwise(0.0)
    fine = F.when(F.col("line_id") == 3, 1e-13).otherwise(0.0)
    return lines.withColumns(
        {
            "qty_units": F.col("qty_units").cast("double") + half,
            "line_net_amount": F.when(F.col("line_id") == 3, fine).otherwise(
                F.col("line_net_amount").cast("double")
            ),
        }
    )


@_query("typed_silver_lines")
def typed_silver_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(apply_contract(_loose_details(spark, sf_dir), contracts.ORDERS_DETAIL))


@_query("typed_silver_lines_rejects")
def typed_silver_lines_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_counts(_loose_details(spark, sf_dir), contracts.ORDERS_DETAIL)


@_query("typed_silver_noisy_headers")
def typed_silver_noisy_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts with floating-point noise and of twenty digits, as an inferred load has them."""
    headers = orders_header(spark, sf_dir)
    amount = F.col("order_net_amount").cast("double")
    noisy = (
        F.when(F.col("order_id") % 3 == 0, amount / 3)
        .when(F.col("order_id") % 3 == 1, amount * 1e15)
        .otherwise(amount + 0.1 + 0.2)
    )
    typed = apply_contract(headers.withColumn("order_net_amount", noisy), contracts.ORDERS_HEADER)
    return _published(positive(typed, "order_net_amount"))


@_query("bronze_customers_more_columns")
def bronze_customers_more_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed load of extracts with one column more than the contract."""
    base_dir = scratch_dir(spark, "more")
    rows = customers(spark, sf_dir).withColumn("region", F.substring("customer_name", 1, 3))
    write_csv_extracts(rows, f"{base_dir}/raw", "customers", "customer_id")
    ingest(spark, base_dir, "customers", contracts.CUSTOMERS)
    stored = read_table(spark, table_path(base_dir, "bronze", "customers"))
    return stored.drop(*contracts.METADATA_COLUMNS)


@_query("parquet_scan")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/orders.parquet")


@_query("parquet_overwrite")
def parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "overwrite")
    for _ in range(2):
        write_table(orders_header(spark, sf_dir), path)
    return read_table(spark, path).agg(F.count(F.lit(1)).alias("rows"))


@_query("gold_single_file_sink")
def gold_single_file_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "gold")
    write_compacted(gold_sales_customer_3m(spark, sf_dir), path)
    return read_table(spark, path)


# Deduplication, filters, joins


@_query("dim_customer")
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customers(spark, sf_dir)
    flipped = F.when(F.col("estado") == "activo", "inactivo").otherwise("activo")
    return build_dim_customer(rows.unionByName(rows.withColumn("estado", flipped)))


@_query("dim_product")
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = products(spark, sf_dir)
    return build_dim_product(rows.unionByName(rows.withColumn("brand", F.lit("Brand#30"))))


@_query("dedup_orders_header")
def dedup_orders_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders_header(spark, sf_dir)
    negated = rows.withColumn("order_net_amount", -F.col("order_net_amount"))
    return _published(keep_one_per_key(rows.unionByName(negated), ["order_id"]))


@_query("dedup_orders_detail")
def dedup_orders_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(keep_one_per_key(orders_detail(spark, sf_dir), ["order_id", "line_id"]))


@_query("filter_positive_orders")
def filter_positive_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(positive(orders_header(spark, sf_dir), "order_net_amount"))


@_query("filter_positive_lines")
def filter_positive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(positive(orders_detail(spark, sf_dir), "qty_units"))


@_query("join_without_duplicate_columns")
def join_without_duplicate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = orders_detail(spark, sf_dir).withColumn("customer_id", F.lit(-1).cast("bigint"))
    fact = attach_lines(clean_orders(orders_header(spark, sf_dir)), clean_lines(lines))
    return fact.select("order_id", "customer_id", "line_id", "product_id")


@_query("fact_order_line")
def fact_order_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(_fact(spark, sf_dir))


@_query("fact_key_is_unique")
def fact_key_is_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.fact_key_checks(_fact(spark, sf_dir), orders_detail(spark, sf_dir))


@_query("dim_date")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_dim_date(clean_orders(orders_header(spark, sf_dir)))


@_query("max_order_date")
def max_order_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_orders(orders_header(spark, sf_dir)).agg(
        F.max("order_date").alias("max_order_date")
    )


@_query("fact_last_90d")
def fact_last_90d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window cut from the complete fact."""
    orders = clean_orders(orders_header(spark, sf_dir))
    fact = attach_lines(orders, clean_lines(orders_detail(spark, sf_dir)))
    return _published(build_fact_last_3m(fact, newest=newest_date(orders)))


@_query("recent_fact")
def recent_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, built for the orders of the window only."""
    return _published(_recent(spark, sf_dir))


# Order and customer level


@_query("orders_3m")
def orders_3m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(rollups.order_rollup(_activity(spark, sf_dir)[0]))


@_query("orders_3m_shared_columns")
def orders_3m_shared_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup where headers carry two columns of the lines; the header's values win."""
    headers = orders_header(spark, sf_dir).withColumns(
        {
            "line_net_amount": F.lit(7).cast(contracts.LINE_AMOUNT),
            "promo_flag": (F.col("order_id") % 2).cast("int"),
        }
    )
    activity = build_recent_activity(clean_orders(headers), orders_detail(spark, sf_dir))
    return _published(rollups.order_rollup(activity))


@_query("customer_order_stats_3m")
def customer_order_stats_3m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(_customer_stats(_activity(spark, sf_dir)[0]))


def _feature(name: str, expression: Callable) -> None:
    @_query(name)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _customer_stats(_activity(spark, sf_dir)[0]).select("customer_id", expression())


_feature("total_sales_3m", features.total_sales)
_feature("order_frequency_3m", features.order_frequency)
_feature("avg_ticket_3m", features.average_ticket)
_feature("promo_order_share_3m", features.promo_order_share)
_feature("credit_share_3m", features.credit_share)


@_query("recency_days")
def recency_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity, newest = _activity(spark, sf_dir)
    return _customer_stats(activity).select("customer_id", features.recency_days(newest))


@_query("category_variety_3m")
def category_variety_3m(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = rollups.category_variety(_activity(spark, sf_dir)[0])
    return counts.select("customer_id", features.category_variety())


@_query("order_gaps")
def order_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.order_gaps(rollups.order_rollup(_activity(spark, sf_dir)[0]))


@_query("avg_days_between_orders")
def avg_days_between_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = rollups.order_gaps(rollups.order_rollup(_activity(spark, sf_dir)[0]))
    return rollups.average_gap(gaps)


@_query("active_traditional_customers")
def active_traditional_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_customers(build_dim_customer(customers(spark, sf_dir)))


@_query("features_join_customer")
def features_join_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = build_dim_customer(customers(spark, sf_dir)).select(
        "customer_id", "canal", "estado"
    )
    stats = _customer_stats(_activity(spark, sf_dir)[0]).select("customer_id", "sales", "orders")
    return _published(stats.join(attributes, "customer_id"))


@_query("gold_sales_customer_3m")
def gold_sales_customer_3m(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = build_dim_customer(customers(spark, sf_dir))
    return _published(build_gold_sales_by_customer(_recent(spark, sf_dir), dimension))


@_query("dim_features")
def dim_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity, newest = _activity(spark, sf_dir)
    return build_dim_features(activity, build_dim_customer(customers(spark, sf_dir)), newest)


@_query("medallion_end_to_end")
def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    base_dir = _raw_extracts(spark, sf_dir, list(SOURCES), "medallion")
    run_medallion(spark, base_dir)
    return read_table(spark, table_path(base_dir, "gold", "dim_features"))


# Data quality


@_query("null_counts")
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.check_nulls(_fact(spark, sf_dir), "fact_order_line")


@_query("negative_counts")
def negative_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    balances = read_table(spark, f"{sf_dir}/customer.parquet")
    return checks.check_no_negative(balances, ["c_acctbal"], "customer").unionByName(
        checks.check_no_negative(_fact(spark, sf_dir), FACT_AMOUNTS, "fact_order_line")
    )


@_query("unit_range_violations")
def unit_range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, f"{sf_dir}/lineitem.parquet")
    return checks.check_between_0_1(lines, ["l_discount", "l_quantity"], "lineitem")


@_query("duplicate_keys")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, f"{sf_dir}/lineitem.parquet")
    parts = [
        checks.check_keys_unique(lines, ["l_orderkey", "l_linenumber"], "lineitem"),
        checks.check_keys_unique(customers(spark, sf_dir), "customer_id", "customers"),
        checks.check_keys_unique(products(spark, sf_dir), "product_id", "products"),
    ]
    return reduce(DataFrame.unionByName, parts)


@_query("fk_violations")
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, people = clean_orders(orders_header(spark, sf_dir)), customers(spark, sf_dir)
    fact = attach_lines(orders, clean_lines(orders_detail(spark, sf_dir)))
    traditional = people.filter(F.col("canal") == contracts.CHANNEL_TRADITIONAL)
    parents = [
        (traditional, "traditional_customers", "customer_id"),
        (people, "dim_customer", "customer_id"),
        (products(spark, sf_dir), "dim_product", "product_id"),
    ]
    return checks.check_dense_fks(fact, parents, "fact_order_line")


@_query("features_not_eligible")
def features_not_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    eligible = active_customers(build_dim_customer(customers(spark, sf_dir)))
    return checks.check_eligible(_recent(spark, sf_dir), eligible, "fact_3m")


@_query("features_not_in_sales")
def features_not_in_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = rollups.sales_totals(_recent(spark, sf_dir))
    return checks.check_in_sales(customers(spark, sf_dir), sales, "customers")


@_query("reconcile_features_vs_sales")
def reconcile_features_vs_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity, newest = _activity(spark, sf_dir)
    calculated = build_customer_features(activity, newest)
    return checks.reconcile(calculated, rollups.sales_totals(_recent(spark, sf_dir)))


@_query("layer_row_counts")
def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = read_all_layers(spark, _stored_layers(spark, sf_dir, "counts"))
    del tables["rejects"]
    return checks.row_counts(tables)


@_query("describe_fact")
def describe_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.numeric_summary(_fact(spark, sf_dir), FACT_AMOUNTS)


@_query("preview_first_5")
def preview_first_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.preview(customers(spark, sf_dir), "customer_id")


@_query("quality_report")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_quality_report(spark, _stored_layers(spark, sf_dir, "report"))
