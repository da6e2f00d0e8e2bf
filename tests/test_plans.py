"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA, final_plan
from stratamart import contracts
from stratamart import queries as registry
from stratamart.functions.typing import apply_contract
from stratamart.operators import rollups
from stratamart.operators.dedup import keep_one_per_key
from stratamart.operators.facts import (
    attach_lines,
    build_fact_order_line,
    build_recent_activity,
    build_recent_fact,
    clean_orders,
)
from stratamart.plans.silver import build_dim_date
from stratamart.sources.star_schema import orders_detail, orders_header
from stratamart.sources.tables import newest_order_bound, read_fact_since, write_fact, write_table


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = sorted(
    set(registry.queries())
    - {"csv_glob_scan", "ingest_metadata", "parquet_overwrite", "gold_single_file_sink"}
    - {"medallion_end_to_end", "layer_row_counts", "quality_report"}
    - {f"bronze_{table}" for table in contracts.BRONZE}
)


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cartesian_product(spark, name):
    plan = planned(registry.queries()[name](spark, TESTDATA))
    assert not re.search(r"Python|Cartesian|BroadcastNestedLoop", plan)


def test_copies_of_a_key_are_reduced_before_the_shuffle(spark):
    plan = planned(keep_one_per_key(orders_detail(spark, TESTDATA), ["order_id", "line_id"]))
    final, shuffle, partial = (
        plan.index(text) for text in ("row_number(), 1, Final", "Exchange hashpart", "row_number(), 1, Partial")
    )
    assert final < shuffle < partial


def test_rollup_combines_before_each_shuffle(spark):
    fact = orders_header(spark, TESTDATA).join(orders_detail(spark, TESTDATA), "order_id")
    plan = planned(rollups.customer_rollup(fact))
    shuffles = plan.split("Exchange hashpart")
    assert len(shuffles) == 3
    assert all(re.match(r"[^\n]*\n[^\n]*HashAggregate.*partial_sum", below) for below in shuffles[1:])
    assert "SortAggregate" not in plan


def test_headers_and_lines_are_scanned_once(spark):
    plan = final_plan(registry.queries()["fact_order_line"](spark, TESTDATA)).split("Initial Plan")[0]
    assert len(re.findall(r"FileScan.*lineitem", plan)) == 1
    assert len(re.findall(r"FileScan.*orders", plan)) == 1
    assert "ReusedExchange" in plan


def test_scan_reads_needed_columns_and_filters(spark):
    plan = planned(registry.queries()["filter_positive_lines"](spark, TESTDATA))
    assert "l_tax" not in plan and "l_shipdate" not in plan
    assert re.search(r"PushedFilters: \[[^]]*IsNotNull\(l_partkey\)", plan)


def test_hot_order_is_split_in_the_join(spark):
    """One order with a third of the lines: adaptive execution splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    previous = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        headers = spark.range(3000).selectExpr(
            "id AS order_id", "id % 50 AS customer_id", "1 AS order_net_amount"
        )
        orders = clean_orders(headers.unionByName(headers))
        lines = spark.range(0, 90000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2900).alias("order_id"),
            F.col("id").alias("line_id"),
            F.xxhash64("id").alias("line_net_amount"),
        )
        fact = attach_lines(orders, lines)
        assert "skew=true" in final_plan(fact)
        assert fact.count() == 90000 + 100
        # The split also holds below a rollup on a key that contains the join key.
        by_order = fact.groupBy("customer_id", "order_id").count()
        assert "skew=true" in final_plan(by_order)
        assert by_order.filter("order_id = 7").collect()[0]["count"] == 30000 + len(
            [i for i in range(90000) if i % 3 and i % 2900 == 7]
        )
    finally:
        for key, value in previous.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_customer_is_not_sorted_in_one_task(spark):
    """Order gaps: rows are spread by customer and day; only days are ordered per customer."""
    orders = orders_header(spark, TESTDATA)
    plan = planned(rollups.order_gaps(orders))
    for window in re.findall(r"Window \[(.*?)\], \[", plan):
        if "order_id" in window:
            assert "day" in window


def test_a_day_with_very_many_times_is_cut_into_slices(spark, monkeypatch):
    """Half of all orders are of one customer and day, at different and unevenly spread times."""
    monkeypatch.setattr(rollups, "SLICES", 16)
    hot = "CAST(timestamp_micros(1700000000000000 + CAST(pow(1.004, id) * 1000 AS BIGINT) + id) AS TIMESTAMP_NTZ)"
    orders = spark.range(6000).selectExpr(
        "CASE WHEN id < 3000 THEN 1 WHEN id < 3010 THEN NULL ELSE id % 50 END AS customer_id",
        "id AS order_id",
        f"CASE WHEN id < 3000 THEN {hot} WHEN id % 97 = 0 THEN NULL "
        "ELSE timestamp_ntz '2023-01-01 00:00:00' + make_dt_interval(CAST(id % 700 AS INT), CAST(id % 5 AS INT)) END AS order_date",
    )
    again = orders.unionByName(orders.where("order_id % 10 = 0").withColumn("order_id", F.col("order_id") + 100_000))
    sliced, plain = rollups.order_gaps(again, hot_day=100), rollups.order_gaps(again)
    assert sliced.count() == plain.count() == again.count()
    assert sliced.exceptAll(plain).count() == 0
    dated = orders.where("customer_id = 1 AND order_id < 3000").selectExpr(
        "customer_id", "CAST(order_date AS DATE) AS day", "order_date", "order_id AS first_order",
        "CAST(NULL AS TIMESTAMP_NTZ) AS previous_day_end",
    )
    plan = final_plan(rollups._linked_in_slices(dated))
    assert re.search(r"Window \[.*row_number.*\], \[customer_id#\w+, day#\w+, slice#\w+\]", plan)


def test_window_slice_reads_only_its_months(spark, tmp_path):
    fact_path, calendar_path = str(tmp_path / "fact"), str(tmp_path / "calendar")
    headers = orders_header(spark, TESTDATA)
    write_fact(headers, fact_path)
    write_table(build_dim_date(headers), calendar_path)
    bound = newest_order_bound(spark, fact_path, 90)
    recent = read_fact_since(spark, fact_path, bound.bound, bound.month)
    plan = planned(recent)
    assert re.search(r"PartitionFilters: \[[^]]*order_month#\d+ >= 200105", plan)
    assert "GreaterThanOrEqual(order_date" in plan
    expected = headers.filter(f"order_date >= timestamp_ntz '{bound.bound}'").count()
    assert recent.count() == expected > 0


def test_window_slice_of_a_fact_without_dates(spark, tmp_path):
    fact_path, calendar_path = str(tmp_path / "fact"), str(tmp_path / "calendar")
    headers = orders_header(spark, TESTDATA).limit(3).withColumn("order_date", F.lit(None).cast("timestamp_ntz"))
    write_fact(headers, fact_path)
    write_table(build_dim_date(headers), calendar_path)
    bound = newest_order_bound(spark, fact_path, 90)
    assert tuple(bound) == (None, None)
    assert read_fact_since(spark, fact_path, *bound).count() == 0


WINDOW_QUERIES = """
fact_last_90d recent_fact orders_3m customer_order_stats_3m total_sales_3m order_frequency_3m
avg_ticket_3m promo_order_share_3m credit_share_3m recency_days category_variety_3m order_gaps
avg_days_between_orders features_join_customer gold_sales_customer_3m dim_features
features_not_eligible features_not_in_sales reconcile_features_vs_sales
""".split()


@pytest.fixture
def large_tables(spark):
    """As for tables that are too large to broadcast, and large enough for a runtime filter."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("name", ["dim_features", "orders_3m", "gold_sales_customer_3m", "order_gaps"])
def test_lines_outside_the_window_are_left_out_before_the_shuffle(spark, large_tables, name):
    plan = planned(registry.queries()[name](spark, TESTDATA))
    lines = [i for i, text in enumerate(plan.splitlines()) if "l_orderkey" in text and "FileScan" in text]
    filters = [i for i, text in enumerate(plan.splitlines()) if "might_contain" in text]
    shuffles = [i for i, text in enumerate(plan.splitlines()) if "Exchange hashpartitioning(order_id" in text]
    assert lines and filters
    # The filter stands between the scan of the lines and the first shuffle above it.
    assert any(max(s for s in shuffles if s < i) < f <= i for i in lines for f in filters)


def test_filtered_lines_give_the_same_window(spark, large_tables):
    headers, details = orders_header(spark, TESTDATA), orders_detail(spark, TESTDATA)
    # A doubled order whose survivor is old, and one whose survivor is new.
    old = headers.withColumns({"order_date": F.lit("1990-01-01").cast("timestamp_ntz"), "order_net_amount": F.lit(-1).cast(contracts.HEADER_AMOUNT)})
    headers = headers.unionByName(old.where("order_id % 3 = 0"))
    orders = clean_orders(headers)
    for build in (build_recent_fact, build_recent_activity):
        plain = build(orders, details)
        filtered = build(orders, details, headers=headers)
        assert plain.columns == filtered.columns
        assert plain.exceptAll(filtered).count() == filtered.exceptAll(plain).count() == 0
        assert filtered.count() > 100


@pytest.mark.parametrize("name", WINDOW_QUERIES)
def test_window_queries_read_the_orders_once(spark, name):
    """In the plan without adaptive execution, which prints what is read again only once.

    The filter of the lines reads the order ids and dates once more.
    """
    query = registry.queries()[name](spark, TESTDATA)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = planned(query)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    scans = re.findall(r"FileScan parquet \[([^]]*o_orderkey[^]]*)\]", plan)
    narrow = [scan for scan in scans if set(re.findall(r"o_\w+", scan)) == {"o_orderkey", "o_orderdate"}]
    # Only the variety needs no order id beside its lines, and so a shuffle of fewer columns.
    expected = 2 if name == "category_variety_3m" else 1
    assert len(scans) - len(narrow) <= expected
    assert len(narrow) <= 1


def test_typed_fact_reads_its_sources_once(spark, tmp_path):
    """Columns that keep their type are no new columns: both parts of the fact share the shuffles."""
    loaded = {}
    for table, source in {"orders_header": orders_header, "orders_detail": orders_detail}.items():
        rows = source(spark, TESTDATA).selectExpr(
            "*", "current_timestamp() AS ingestion_timestamp", f"'{table}.csv' AS source_file"
        )
        write_table(rows, str(tmp_path / table))
        contract = contracts.BRONZE[table]
        loaded[table] = apply_contract(spark.read.parquet(str(tmp_path / table)), contract)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = build_fact_order_line(loaded["orders_header"], loaded["orders_detail"])
        plan = final_plan(fact).split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(re.findall(r"ReusedExchange", plan)) == 2
    assert len(re.findall(r"FileScan", plan)) == 2
    # The file of a line is no part of the fact and is not shuffled.
    scan = re.search(r"FileScan parquet \[([^]]*line_id[^]]*)\]", plan).group(1)
    assert "source_file" not in scan and "ingestion_timestamp" in scan
    assert [row.source_file for row in fact.select("source_file").distinct().collect()] == ["orders_header.csv"]


def test_last_columns_of_the_order_choose_no_other_line(spark):
    """The survivor of a line is the same with and without the columns that the order replaces."""
    orders = spark.sql("SELECT 1L AS order_id, 5.0 AS order_net_amount, 'h' AS source_file, 'n' AS note")
    lines = spark.sql(
        "SELECT * FROM VALUES (1L, 1L, 2L, 'b', 'z', 7), (1L, 1L, 2L, 'c', 'a', 6), (1L, 2L, 3L, 'b', 'z', 5)"
        " AS t(order_id, line_id, qty_units, source_file, note, extra)"
    )
    kept = build_fact_order_line(orders, lines).select("line_id", "extra", "source_file").collect()
    assert sorted(map(tuple, kept)) == [(1, 7, "h"), (2, 5, "h")]
    last = lines.select("order_id", "line_id", "qty_units", "extra", "source_file", "note")
    kept = build_fact_order_line(orders, last).select("line_id", "extra", "note").collect()
    assert sorted(map(tuple, kept)) == [(1, 6, "n"), (2, 5, "n")]
