import datetime as dt

from pyspark.sql import functions as F

from conftest import day, values
from stratamart.functions.typing import apply_contract, reject_counts
from stratamart import contracts
from stratamart.operators.checks import check_keys_unique
from stratamart.operators.dedup import keep_one_per_key
from stratamart.operators.facts import (
    attach_lines,
    build_fact_last_3m,
    build_fact_order_line,
    clean_orders,
)
from stratamart.plans.silver import build_dim_customer, build_dim_date

HEADER = (1, 10, "2024-01-01", 100, "contado")
LINE = (1, 1, 5, 2, 40, 0, "a")


def test_newest_row_survives_then_smallest(spark):
    rows = spark.createDataFrame(
        [(1, "b", 1), (1, "a", 2), (1, "c", 2), (2, None, None), (2, "z", None), (None, "x", 1), (None, "x", 1)],
        "id int, name string, ingestion_timestamp int",
    )
    assert values(keep_one_per_key(rows, ["id"])) == [(1, "a", 2), (2, "z", None), (None, "x", 1)]


def test_rows_with_key_columns_only(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert values(keep_one_per_key(rows, ["id"])) == [(1,), (2,)]


def test_map_columns_are_kept_but_not_compared(spark):
    rows = spark.range(2).select(F.lit(1).alias("id"), F.create_map(F.lit("k"), F.lit("v")).alias("m"), F.col("id").alias("n"))
    assert [r["n"] for r in keep_one_per_key(rows, ["id"]).collect()] == [0]


def test_dimension_keeps_all_columns(people):
    rows = people((1, "tradicional", "inactivo"), (1, "tradicional", "activo"), (2, "moderno", "activo"))
    assert values(build_dim_customer(rows), "customer_id", "estado") == [(1, "activo"), (2, "activo")]


def test_duplicate_header_is_resolved_before_the_filter(headers, details):
    copies = headers(HEADER, (1, 10, "2024-01-01", -5, "contado"))
    assert build_fact_order_line(copies, details(LINE)).count() == 0


def test_quality_filters_drop_zero_negative_and_null(headers, details):
    orders = headers(HEADER, (2, 10, "2024-01-01", 0, "x"), (3, 10, "2024-01-01", None, "x"), (4, 10, "2024-01-01", -1, "x"))
    lines = details(LINE, (1, 2, 5, 0, 40, 0, "a"), (1, 3, 5, None, 40, 0, "a"), (1, 4, 5, -2, 40, 0, "a"))
    assert values(build_fact_order_line(orders, lines), "order_id", "line_id") == [(1, 1)]


def test_order_without_valid_lines_stays_once(headers, details):
    fact = build_fact_order_line(
        headers(HEADER, (2, 11, "2024-01-02", 50, "credito"), (3, 12, "2024-01-03", 50, "credito")),
        details(LINE, (2, 1, 5, 0, 40, 0, "a"), (2, 2, 5, -1, 40, 0, "a")),
    )
    assert values(fact, "order_id", "line_id", "line_net_amount", "customer_id")[1:] == [
        (2, None, None, 11),
        (3, None, None, 12),
    ]


def test_null_keys(headers, details):
    """An order without id keeps its row; lines without id never match; NULL line ids are equal."""
    fact = build_fact_order_line(
        headers(HEADER, (None, 11, "2024-01-02", 50, "x"), (None, 11, "2024-01-02", 60, "x")),
        details((1, None, 5, 2, 40, 0, "a"), (1, None, 6, 2, 41, 0, "a"), (None, 1, 5, 2, 40, 0, "a"), (9, 1, 5, 2, 40, 0, "a")),
    )
    assert values(fact, "order_id", "order_net_amount", "product_id") == [(1, 100, 5), (None, 50, None)]
    assert values(check_keys_unique(fact, ["order_id", "line_id"], "fact"), "violations") == [(0,)]


def test_header_wins_on_shared_columns(headers, details):
    lines = details(LINE).withColumn("customer_id", F.lit(-1)).withColumn("note", F.lit("n"))
    fact = attach_lines(clean_orders(headers(HEADER)), lines)
    assert fact.columns.count("customer_id") == 1
    assert values(fact, "customer_id", "note") == [(10, "n")]


def test_calendar(headers):
    rows = headers(HEADER, (2, 10, "2024-01-01T13:00:00", 1, "x"), (3, 10, "2023-12-31", 1, "x"), (4, 10, None, 1, "x"))
    assert values(build_dim_date(rows)) == [
        ("20231231", dt.date(2023, 12, 31), 2023, 12, 31, 1),
        ("20240101", dt.date(2024, 1, 1), 2024, 1, 1, 2),
        (None, None, None, None, None, None),
    ]


def test_window_edge_is_kept(headers):
    rows = headers(
        (1, 10, "2024-03-31T12:00:00", 1, "x"),
        (2, 10, "2024-01-01T12:00:00", 1, "x"),
        (3, 10, "2024-01-01T11:59:59", 1, "x"),
        (4, 10, None, 1, "x"),
    )
    assert values(build_fact_last_3m(rows), "order_id") == [(1,), (2,)]
    assert values(build_fact_last_3m(rows, days=0), "order_id") == [(1,)]


def test_window_of_date_column(headers):
    rows = headers((1, 10, "2024-03-31", 1, "x"), (2, 10, "2024-01-01", 1, "x"), (3, 10, "2023-12-31", 1, "x"))
    dates = rows.withColumn("order_date", F.col("order_date").cast("date"))
    assert values(build_fact_last_3m(dates), "order_id") == [(1,), (2,)]


def test_window_without_dates_is_empty_with_the_same_schema(headers):
    rows = headers((1, 10, None, 1, "x"))
    for empty in (rows, rows.limit(0)):
        cut = build_fact_last_3m(empty)
        assert cut.schema == rows.schema and cut.count() == 0


def test_contract_casts_and_counts_rejects(spark):
    raw = spark.createDataFrame(
        [
            ("1", "1", "p", " 4 ", "1.5", "true", "a", "extra"),
            ("x", "2", None, "2.5.1", "n/a", "0", None, "extra"),
            ("3", "3", "7", "5", "1", "maybe", "b", "extra"),
        ],
        "order_id string, line_id string, product_id string, qty_units string, "
        "line_net_amount string, promo_flag string, product_category string, other string",
    )
    typed = apply_contract(raw, contracts.ORDERS_DETAIL)
    assert typed.schema["promo_flag"].dataType == contracts.ORDERS_DETAIL["promo_flag"].dataType
    assert typed.columns == raw.columns
    assert values(typed, "line_id", "order_id", "qty_units", "promo_flag") == [
        ("1", "1", 4, 1),  # text keys stay as they come
        ("2", "x", None, 0),
        ("3", "3", 5, None),
    ]
    assert dict(values(reject_counts(raw, contracts.ORDERS_DETAIL))) == {
        "order_id": 0,
        "line_id": 0,
        "product_id": 0,
        "qty_units": 1,
        "line_net_amount": 1,
        "promo_flag": 1,
        "product_category": 0,
    }


def test_contract_casts_boolean_flags(spark):
    raw = spark.createDataFrame([(True,), (False,), (None,)], "promo_flag boolean")
    flags = contracts.ORDERS_DETAIL["promo_flag"]
    typed = apply_contract(raw, type(contracts.ORDERS_DETAIL)([flags]))
    assert values(typed) == [(0,), (1,), (None,)]


def test_day_helper():
    assert day(None) is None
