"""Aggregations of the fact by order and by customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.contracts import PAYMENT_CREDIT
from stratamart.functions.columns import text_literal


def _aggregates(**expressions: str) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in expressions.items()]


def _order_aggregates() -> list[Column]:
    """Date, amount and promotion flag of one order over its lines."""
    return _aggregates(
        order_date="min(order_date)",
        order_amount="sum(line_net_amount)",
        has_promo="max(CAST(promo_flag AS INT))",
    )


def _customer_aggregates(is_credit: str, rows: str = "true") -> list[Column]:
    """Customer statistics over those order-level rows for which ``rows`` holds."""
    return _aggregates(
        sales=f"sum(order_amount) FILTER (WHERE {rows})",
        orders=f"count(order_id) FILTER (WHERE {rows})",
        dated_orders=f"count(order_date) FILTER (WHERE {rows})",
        first_order_date=f"min(order_date) FILTER (WHERE {rows})",
        last_order_date=f"max(order_date) FILTER (WHERE {rows})",
        promo_orders=f"count_if(has_promo = 1) FILTER (WHERE {rows})",
        credit_sales=f"sum(CASE WHEN {is_credit} THEN order_amount ELSE 0 END) FILTER (WHERE {rows})",
    )


def order_rollup(fact: DataFrame) -> DataFrame:
    """One row per (customer, order): date, amount of its lines, promotion flag, payment type.

    An order without lines has a NULL amount and a NULL flag. The payment type is constant within an
    order; ``max`` picks it without depending on row order.
    """
    return fact.groupBy("customer_id", "order_id").agg(
        *_order_aggregates(), F.max("tipo_pago").alias("tipo_pago")
    )


def customer_order_stats(orders: DataFrame, credit: str = PAYMENT_CREDIT) -> DataFrame:
    """Per customer, from ``order_rollup`` rows: sales, orders, first and last date, orders with a
    promoted line, credit sales.

    The rollup is unique per order, so distinct orders are a plain count.
    """
    is_credit = f"tipo_pago = {text_literal(credit)}"
    return orders.groupBy("customer_id").agg(*_customer_aggregates(is_credit))


def category_variety(fact: DataFrame) -> DataFrame:
    """Distinct product categories per customer; NULL is not a category."""
    return fact.groupBy("customer_id").agg(
        F.count_distinct("product_category").alias("categories")
    )


def customer_rollup(fact: DataFrame, credit: str = PAYMENT_CREDIT) -> DataFrame:
    """``customer_order_stats`` and ``category_variety`` in one pass over the fact.

    One grouping-set aggregation reduces the lines to (customer, order) and (customer, category)
    rows; a second one reduces those to customers. Each combines before its shuffle, so a customer
    with a large share of the lines costs one row per order and category, then one row per task.
    The payment type enters as a flag: numeric buffers keep the aggregation hashed instead of sorted.
    """
    on_credit = f"max(CASE WHEN tipo_pago = {text_literal(credit)} THEN 1 ELSE 0 END)"
    reduced = fact.groupingSets(
        [["customer_id", "order_id"], ["customer_id", "product_category"]],
        "customer_id",
        "order_id",
        "product_category",
    ).agg(F.expr("grouping_id()").alias("level"), *_order_aggregates(), *_aggregates(on_credit=on_credit))
    by_order, by_category = "level = 1", "level = 2"
    return reduced.groupBy("customer_id").agg(
        *_customer_aggregates("on_credit = 1", by_order),
        *_aggregates(categories=f"count(product_category) FILTER (WHERE {by_category})"),
    )


def sales_totals(fact: DataFrame) -> DataFrame:
    """Per customer totals over fact rows.

    The order amount is a header value that stands on each line of its order, so its total counts it
    once per line; reports rely on that definition.
    """
    return fact.groupBy("customer_id").agg(
        *_aggregates(
            total_order_net_amount_3m="sum(order_net_amount)",
            total_line_net_amount_3m="sum(line_net_amount)",
            total_qty_units_3m="sum(qty_units)",
        )
    )


#: Distinct times of a customer's day that are put in order in one task, and the slices of a longer one.
HOT_DAY = 1_000_000
SLICES = 256


def order_gaps(orders: DataFrame, hot_day: int = HOT_DAY) -> DataFrame:
    """Per order the previous order date of the same customer and the gap in days.

    Orders of one date are ranked by order id. All of them but the first have that same date before
    them, so only the distinct dates of a customer are put in order: they are combined before the
    shuffle, and no window runs over the orders. Dates are compared within (customer, day), the
    first of a day with the newest of the customer's previous day; a day with more than ``hot_day``
    different times is cut into slices (``_linked_in_slices``). The orders meet the dates in an
    inner join, which adaptive execution splits where a customer and date have many of them.
    """
    rows = orders.select("customer_id", "order_id", "order_date")
    dates = (
        rows.groupBy("customer_id", "order_date")
        .agg(F.min("order_id").alias("least"), F.count_if(F.expr("order_id IS NULL")).alias("nulls"))
        .selectExpr(
            "customer_id",
            "order_date",
            "CAST(order_date AS DATE) AS day",
            "CASE WHEN nulls = 0 THEN least END AS first_order",
        )
    )
    days = (
        dates.groupBy("customer_id", "day")
        .agg(F.max("order_date").alias("day_end"), F.count(F.lit(1)).alias("times"))
        .selectExpr(
            "customer_id AS d_customer",
            "day AS d_day",
            "times",
            "lag(day_end) OVER (PARTITION BY customer_id ORDER BY day) AS previous_day_end",
        )
    )
    dated = dates.join(days, F.expr("customer_id <=> d_customer AND day <=> d_day"))
    linked = _linked_in_day(dated.filter(F.col("times") <= hot_day)).union(
        _linked_in_slices(dated.filter(F.col("times") > hot_day))
    )
    return (
        rows.join(linked, F.expr("customer_id <=> l_customer AND order_date <=> l_date"))
        .selectExpr(
            "customer_id",
            "order_id",
            "order_date",
            "CASE WHEN order_id <=> first_order THEN previous ELSE order_date END AS prev_order_date",
        )
        .selectExpr("*", "CAST(datediff(order_date, prev_order_date) AS BIGINT) AS diff_days")
    )


def _linked_in_day(dated: DataFrame) -> DataFrame:
    """Each date of a customer with the one before it."""
    within_day = "(PARTITION BY customer_id, day ORDER BY order_date)"
    return dated.selectExpr(
        "*",
        f"row_number() OVER {within_day} AS rank_in_day",
        f"lag(order_date) OVER {within_day} AS previous_in_day",
    ).selectExpr(
        "customer_id AS l_customer",
        "order_date AS l_date",
        "first_order",
        "CASE WHEN rank_in_day = 1 THEN previous_day_end ELSE previous_in_day END AS previous",
    )


def _linked_in_slices(dated: DataFrame) -> DataFrame:
    """``_linked_in_day`` for days with very many times.

    Approximate quantiles, which merge, cut each day into slices of about equally many times,
    however unevenly these lie. Times are compared within a slice; between slices only the last one
    of each is carried on.
    """
    shares = ", ".join(f"{i / SLICES!r}D" for i in range(1, SLICES))
    edges = (
        dated.groupBy("customer_id", "day")
        .agg(F.expr(f"percentile_approx(order_date, array({shares}))").alias("edges"))
        .toDF("e_customer", "e_day", "edges")
    )
    sliced = dated.join(edges, F.expr("customer_id <=> e_customer AND day <=> e_day")).selectExpr(
        "customer_id",
        "day",
        "order_date",
        "first_order",
        "previous_day_end",
        "size(filter(edges, e -> e < order_date)) AS slice",
    )
    ends = (
        sliced.groupBy("customer_id", "day", "slice")
        .agg(F.max("order_date").alias("slice_end"))
        .selectExpr(
            "customer_id AS s_customer",
            "day AS s_day",
            "slice AS s_slice",
            "lag(slice_end) OVER (PARTITION BY customer_id, day ORDER BY slice) AS previous_slice_end",
        )
    )
    within = "(PARTITION BY customer_id, day, slice ORDER BY order_date)"
    ranked = sliced.selectExpr(
        "*",
        f"row_number() OVER {within} AS rank_in_slice",
        f"lag(order_date) OVER {within} AS previous_in_slice",
    )
    met = ranked.join(
        ends, F.expr("customer_id <=> s_customer AND day <=> s_day AND slice = s_slice")
    )
    before = "coalesce(previous_slice_end, previous_day_end)"
    return met.selectExpr(
        "customer_id AS l_customer",
        "order_date AS l_date",
        "first_order",
        f"CASE WHEN rank_in_slice = 1 THEN {before} ELSE previous_in_slice END AS previous",
    )


def average_gap(gaps: DataFrame) -> DataFrame:
    """Mean gap per customer with at least one gap, from ``order_gaps`` rows."""
    return (
        gaps.filter("prev_order_date IS NOT NULL")
        .groupBy("customer_id")
        .agg(F.avg("diff_days").alias("dias_promedio_entre_pedidos"))
    )
