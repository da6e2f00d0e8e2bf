"""The eight behaviour features of a customer, as columns over ``customer_rollup`` statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratamart.functions.columns import guarded_ratio


def total_sales() -> Column:
    """Sales over all orders; NULL where no order has a line."""
    return F.expr("CAST(sales AS DOUBLE) AS ventas_total_3m")


def recency_days(reference: Column) -> Column:
    """Days from the customer's last order to the reference date, the time of day ignored."""
    return F.datediff(reference, "last_order_date").cast("bigint").alias("recencia_dias")


def order_frequency() -> Column:
    """Number of orders, those without lines included."""
    return F.expr("orders AS frecuencia_pedidos_3m")


def average_ticket() -> Column:
    """Sales per order."""
    return F.expr(f"{guarded_ratio('sales', 'orders')} AS ticket_promedio_3m")


def average_days_between_orders() -> Column:
    """Mean gap between consecutive orders; NULL with fewer than two.

    Consecutive gaps add up to the span from the first to the last order, so neither a sort nor a
    window is needed.
    """
    span, gaps = "datediff(last_order_date, first_order_date)", "(dated_orders - 1)"
    return F.expr(f"{guarded_ratio(span, gaps)} AS dias_promedio_entre_pedidos")


def category_variety() -> Column:
    """Distinct product categories; 0 without any."""
    return F.expr("categories AS variedad_categorias_3m")


def promo_order_share() -> Column:
    """Share of the orders with a promoted line, from 0 to 1."""
    return F.expr(f"{guarded_ratio('promo_orders', 'orders', '0')} AS porcentaje_pedidos_promo_3m")


def credit_share() -> Column:
    """Share of the sales paid on credit; 0 where sales are not positive or unknown."""
    return F.expr(f"{guarded_ratio('credit_sales', 'sales', '0')} AS mix_credito_vs_contado_3m")


def all_features(reference: Column) -> list[Column]:
    """Features in the order of the published table."""
    return [
        total_sales(),
        recency_days(reference),
        order_frequency(),
        average_ticket(),
        average_days_between_orders(),
        category_variety(),
        promo_order_share(),
        credit_share(),
    ]
