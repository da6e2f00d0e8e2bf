import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

import brute_force
from conftest import values
from stratamart import contracts
from stratamart.operators import features, rollups
from stratamart.operators.facts import (
    build_fact_last_3m,
    build_fact_order_line,
    build_recent_activity,
    build_recent_fact,
    clean_orders,
    newest_date,
)
from stratamart.plans.gold import (
    build_customer_features,
    build_dim_features,
    build_gold_sales_by_customer,
)

FEATURES = contracts.DIM_FEATURES.fieldNames()


def random_rows(seed, hot):
    """Headers and lines with NULLs, duplicates, bad amounts; ``hot`` takes a third of the rows."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)

    def maybe(value, share=0.05):
        return None if rng.random() < share else value

    def hour():
        return rng.choice([0, 0, 9, 17])

    headers = []
    for order in range(240):
        customer = 1 if hot == "customer" and order % 3 == 0 else rng.randrange(1, 25)
        date = start + timedelta(days=rng.randrange(0, 140), hours=hour())
        row = (
            maybe(order, 0.03),
            maybe(customer),
            maybe(date),
            maybe(Decimal(rng.randrange(-300, 2000)) / 10),
            maybe(rng.choice(["credito", "contado"])),
        )
        headers.append(row)
        if rng.random() < 0.1:
            headers.append((row[0], rng.randrange(1, 25), row[2], Decimal(rng.randrange(-9, 90)), "credito"))
    lines = []
    for number in range(900):
        if hot == "order" and number % 3 == 0:
            order, line = 7, number
        elif hot == "copies" and number % 3 == 0:
            order, line = 8, 1
        else:
            order, line = rng.randrange(0, 260), rng.randrange(1, 5)
        lines.append(
            (
                maybe(order, 0.02),
                maybe(line, 0.02),
                maybe(rng.randrange(1, 40)),
                maybe(rng.randrange(-2, 9)),
                maybe(Decimal(rng.randrange(-500, 9000)) / 100),
                maybe(rng.randrange(0, 2)),
                maybe(rng.choice("abcdef")),
            )
        )
    return headers, lines


@pytest.mark.parametrize("seed, hot", list(enumerate(["none", "customer", "order", "copies"])))
def test_chain_against_brute_force(spark, people, seed, hot):
    header_rows, line_rows = random_rows(seed, hot)
    headers = spark.createDataFrame(header_rows, contracts.ORDERS_HEADER)
    lines = spark.createDataFrame(line_rows, contracts.ORDERS_DETAIL)
    header_columns, line_columns = headers.columns, lines.columns
    expected = brute_force.fact(
        [dict(zip(header_columns, r)) for r in header_rows],
        [dict(zip(line_columns, r)) for r in line_rows],
        header_columns,
        line_columns,
    )

    fact = build_fact_order_line(headers, lines)

    def as_rows(dicts):
        rows = [tuple(d[c] for c in fact.columns) for d in dicts]
        return sorted(rows, key=lambda row: [(v is None, v if v is not None else 0) for v in row])

    assert values(fact) == as_rows(expected)

    recent = brute_force.window(expected)
    orders = clean_orders(headers)
    fact_3m = build_fact_last_3m(fact)
    recent_fact = build_recent_fact(orders, lines)
    assert values(fact_3m) == as_rows(recent)
    assert values(recent_fact.select(fact.columns)) == as_rows(recent)

    wanted = brute_force.features(recent)
    activity = build_recent_activity(orders, lines)
    for source in (fact_3m, activity):
        found = {r[0]: tuple(r)[1:] for r in build_customer_features(source, newest_date(orders)).collect()}
        assert found.keys() == wanted.keys()
        for customer, row in wanted.items():
            assert found[customer] == row, customer

    eligible = people(*[(c, "tradicional", "activo" if c % 2 else "inactivo") for c in range(1, 25)])
    table = build_dim_features(fact_3m, eligible)
    assert table.columns == FEATURES
    assert {r[0] for r in table.collect()} == {
        c for c, row in wanted.items() if c is not None and c % 2 and row[2] >= 1
    }


def test_single_pass_equals_separate_aggregations(spark):
    header_rows, line_rows = random_rows(11, "customer")
    orders = clean_orders(spark.createDataFrame(header_rows, contracts.ORDERS_HEADER))
    fact = build_recent_fact(orders, spark.createDataFrame(line_rows, contracts.ORDERS_DETAIL))
    reduced = rollups.order_rollup(fact)
    stats = rollups.customer_order_stats(reduced)
    variety = rollups.category_variety(fact)
    apart = {r[0]: tuple(r)[1:] for r in stats.collect()}
    categories = dict(tuple(r) for r in variety.collect())
    for row in rollups.customer_rollup(fact).collect():
        assert tuple(row)[1:-1] == apart[row[0]]
        assert row[-1] == categories[row[0]]

    gaps = rollups.order_gaps(reduced)
    average = dict(tuple(r) for r in rollups.average_gap(gaps).collect())
    telescoped = stats.select("customer_id", features.average_days_between_orders()).collect()
    assert {r[0]: r[1] for r in telescoped if r[1] is not None} == average


def test_gaps_follow_date_then_order_id(spark):
    rows = spark.createDataFrame(
        [
            (1, 3, datetime(2024, 1, 1, 9)),
            (1, 1, datetime(2024, 1, 1, 9)),
            (1, 2, datetime(2024, 1, 1, 8)),
            (1, 4, datetime(2024, 1, 5)),
            (None, 5, datetime(2024, 1, 1)),
            (None, 6, datetime(2024, 1, 3)),
            (2, 7, None),
            (2, 8, datetime(2024, 1, 1)),
        ],
        "customer_id int, order_id int, order_date timestamp_ntz",
    )
    found = {r.order_id: (r.prev_order_date, r.diff_days) for r in rollups.order_gaps(rows).collect()}
    assert found == {
        2: (None, None),
        1: (datetime(2024, 1, 1, 8), 0),
        3: (datetime(2024, 1, 1, 9), 0),
        4: (datetime(2024, 1, 1, 9), 4),
        5: (None, None),
        6: (datetime(2024, 1, 1), 2),
        7: (None, None),
        8: (None, None),
    }


def test_customer_with_line_less_orders_only(headers, details, people):
    fact = build_fact_order_line(
        headers((1, 10, "2024-01-01", 5, "credito"), (2, 10, "2024-01-01", 5, "credito")),
        details(),
    )
    table = build_dim_features(fact, people((10, "tradicional", "activo")))
    assert values(table) == [(10, None, 0, 2, None, 0.0, 0, 0.0, 0.0)]


def test_eligibility_is_exact_and_needs_the_dimension(headers, details, people):
    fact = build_fact_order_line(
        headers(*[(i, i, "2024-01-01", 5, "contado") for i in (1, 2, 3, 4, 5)], (6, None, "2024-01-01", 5, "x")),
        details(),
    )
    dimension = people(
        (1, "tradicional", "activo"),
        (2, "Tradicional", "activo"),
        (3, "tradicional", "inactivo"),
        (4, "moderno", "activo"),
        (None, "tradicional", "activo"),
    )
    assert values(build_dim_features(fact, dimension), "customer_id") == [(1,)]
    other = build_dim_features(fact, dimension, channel="moderno")
    assert values(other, "customer_id") == [(4,)]


def test_sales_summary_keeps_unknown_and_null_customers_and_fans_out(headers, details, people):
    fact = build_fact_order_line(
        headers((1, 10, "2024-01-01", 100, "x"), (2, None, "2024-01-01", 30, "x"), (3, 99, "2024-01-01", 7, "x")),
        details((1, 1, 5, 2, 40, 0, "a"), (1, 2, 5, 3, 50, 0, "a")),
    )
    summary = build_gold_sales_by_customer(fact, people((10, "moderno", "activo")))
    assert values(
        summary,
        "customer_id",
        "total_order_net_amount_3m",
        "total_line_net_amount_3m",
        "total_qty_units_3m",
        "canal",
    ) == [(10, 200, 90, 5, "moderno"), (99, 7, None, None, None), (None, 30, None, None, None)]


def test_credit_label_with_a_quote(headers, details):
    fact = build_fact_order_line(headers((1, 10, "2024-01-01", 5, "it's")), details((1, 1, 5, 2, 40, 1, "a")))
    found = build_customer_features(fact, credit="it's").collect()[0]
    assert found.mix_credito_vs_contado_3m == 1.0 and found.porcentaje_pedidos_promo_3m == 1.0


def test_double_amounts_and_boolean_flags_work(headers, details, people):
    fact = build_fact_order_line(headers((1, 10, "2024-01-01", 5, "credito")), details((1, 1, 5, 2, 40, 1, "a")))
    loose = fact.selectExpr(
        "* EXCEPT (line_net_amount, promo_flag)",
        "CAST(line_net_amount AS DOUBLE) AS line_net_amount",
        "CAST(promo_flag AS BOOLEAN) AS promo_flag",
    )
    table = build_dim_features(loose, people((10, "tradicional", "activo")))
    assert values(table) == [(10, 40.0, 0, 1, 40.0, None, 1, 1.0, 1.0)]


def test_empty_fact(headers, details, people):
    fact = build_fact_order_line(headers(), details())
    assert build_dim_features(build_fact_last_3m(fact), people()).collect() == []


def test_recent_fact_with_shared_columns(headers, details):
    """Lines are compared by their own load time and values; the order's values are published."""
    orders = headers((1, 10, "2024-03-01", 5, "x"), (2, 11, "2023-01-01", 5, "x")).selectExpr(
        "*", "1 AS ingestion_timestamp", "'header' AS source_file"
    )
    older, newer = (
        details((1, 1, product, 2, 40, 0, "a"), (2, 1, 9, 2, 40, 0, "a")).selectExpr(
            "*", f"{load} AS ingestion_timestamp", "'detail' AS source_file"
        )
        for product, load in ((5, 7), (6, 8))
    )
    lines = older.unionByName(newer)
    recent = build_recent_fact(clean_orders(orders), lines)
    columns = ["order_id", "product_id", "ingestion_timestamp", "source_file"]
    assert values(recent, *columns) == [(1, 6, 1, "header")]
    assert values(recent) == values(
        build_fact_last_3m(build_fact_order_line(orders, lines)).select(recent.columns)
    )
