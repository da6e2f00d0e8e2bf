"""Order-line fact: quality filters, header with lines, trailing window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.contracts import INGESTION_TIMESTAMP, METADATA_COLUMNS, WINDOW_DAYS
from stratamart.functions.columns import interval_days, quoted
from stratamart.operators.dedup import keep_one_per_key


def positive(df: DataFrame, column: str) -> DataFrame:
    """Rows with a value above zero; NULL is dropped."""
    return df.filter(f"{quoted(column)} > 0")


def clean_orders(orders_header: DataFrame) -> DataFrame:
    """One header per order, then only those with a positive amount.

    Made for joins with lines, of which one order may have a large share.
    """
    unique = keep_one_per_key(orders_header, ["order_id"], own_partitioning=False)
    return positive(unique, "order_net_amount")


def clean_lines(orders_detail: DataFrame) -> DataFrame:
    """One row per (order, line), then only those with a positive quantity.

    Lines without an order id never reach the fact and are left out before the shuffle.
    """
    identified = orders_detail.filter("order_id IS NOT NULL")
    return positive(keep_one_per_key(identified, ["order_id", "line_id"]), "qty_units")


def without_shared_columns(right: DataFrame, left: DataFrame, key: str) -> DataFrame:
    """Drop from ``right`` the columns ``left`` has too, except the key: the left value wins."""
    return right.select(*[c for c in right.columns if c == key or c not in left.columns])


def _with_line_less(matched: DataFrame, orders: DataFrame) -> DataFrame:
    """Order-line rows and, with NULL line columns, the given orders."""
    no_line = [
        f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
        for f in matched.schema
        if f.name not in orders.columns
    ]
    return matched.unionByName(orders.selectExpr("*", *no_line))


def attach_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Left outer join of unique ``orders`` with their ``lines``; columns of ``orders`` win.

    Written as the matched rows plus the orders without lines. Adaptive execution splits a hot key
    on the many side of an inner join, but never on the nullable side of an outer join; the second
    part compares distinct keys only. Both parts read the same shuffle of the deduplicated inputs.
    """
    lines = without_shared_columns(lines, orders, "order_id")
    matched = orders.join(lines, "order_id")
    without_lines = orders.join(lines.select("order_id").distinct(), "order_id", "left_anti")
    return _with_line_less(matched, without_lines)


def build_fact_order_line(orders_header: DataFrame, orders_detail: DataFrame) -> DataFrame:
    """The fact: every valid order with its valid lines, unique on (order_id, line_id).

    Uniqueness follows from the unique inputs, so no deduplication is run after the join.
    """
    lines = _without_last_shared(orders_detail, orders_header)
    return attach_lines(clean_orders(orders_header), clean_lines(lines))


def _without_last_shared(orders_detail: DataFrame, orders_header: DataFrame) -> DataFrame:
    """Lines without those last columns that the fact takes from the order, such as the source file.

    The survivor of a deduplication is chosen by the load time and then by the columns in order. So
    the last ones only choose among rows that are equal in all columns the fact keeps of a line.
    """
    names = orders_detail.columns
    own = {"order_id", "line_id", "qty_units", INGESTION_TIMESTAMP}
    shared = set(orders_header.columns) - own
    last = len(names)
    while last and names[last - 1] in shared | {INGESTION_TIMESTAMP}:
        last -= 1
    return orders_detail.drop(*[name for name in names[last:] if name in shared])


def newest_date(dated: DataFrame) -> Column:
    """The newest ``order_date`` as a scalar subquery: no driver round trip.

    The order id goes along where there is one, so that the subquery needs the same columns of the
    deduplicated orders as the query around it and reads the same shuffle.
    """
    columns = [c for c in ("order_date", "order_id") if c in dated.columns]
    newest = dated.agg(F.max(F.struct(*columns)).alias("newest"))
    return newest.select("newest.order_date").scalar()


def build_fact_last_3m(
    fact: DataFrame, days: int = WINDOW_DAYS, newest: Column | None = None
) -> DataFrame:
    """Rows with ``order_date >= newest - days``, the edge included. NULL dates drop; an input
    without dates gives no rows.

    ``newest`` may name the newest date where it is known more cheaply than from ``fact``.
    """
    newest = newest_date(fact) if newest is None else newest
    return fact.filter(F.col("order_date") >= newest - interval_days(days))


def lines_in_window(
    orders_detail: DataFrame, headers: DataFrame, days: int, newest: Column
) -> DataFrame:
    """Lines of orders of which some raw header lies in the window, others left out before a shuffle.

    The raw headers hold every header that deduplication can choose, so no line of the window is
    lost. They are a filtered scan: Spark broadcasts their keys where they are few, and otherwise
    makes a Bloom filter of them that it applies in the scan of the lines (``might_contain`` in the
    plan). Deduplicated orders would be too far from their scan for that.
    """
    window = build_fact_last_3m(headers.select("order_id", "order_date"), days, newest)
    return orders_detail.join(window.select("order_id"), "order_id", "left_semi")


def _recent_lines(recent: DataFrame, orders_detail: DataFrame) -> DataFrame:
    """Valid lines of the ``recent`` orders, with the columns of the order.

    The order is joined first, so that only lines of the window are deduplicated. Columns of the
    order are constant per key; they are set aside while the lines are compared by their own.
    """
    own = orders_detail.columns
    aside = {c: f"_order_{c}" if c in own else c for c in recent.columns if c != "order_id"}
    renamed = recent.selectExpr(
        "order_id", *[f"{quoted(c)} AS {quoted(name)}" for c, name in aside.items()]
    )
    lines = clean_lines(orders_detail.join(renamed, "order_id"))
    return lines.selectExpr(
        "order_id",
        *[f"{quoted(name)} AS {quoted(c)}" for c, name in aside.items()],
        *[quoted(c) for c in own if c not in recent.columns],
    )


def build_recent_fact(
    orders: DataFrame,
    orders_detail: DataFrame,
    days: int = WINDOW_DAYS,
    newest: Column | None = None,
    headers: DataFrame | None = None,
) -> DataFrame:
    """``build_fact_last_3m`` of the fact of ``clean_orders`` rows and raw lines, without building
    the older history.

    A left join keeps every order, so the newest date and the window can be taken from the orders,
    and only lines of those orders are deduplicated and joined. With the raw ``headers`` that the
    orders come from, other lines are left out where they are read (``lines_in_window``).
    """
    newest = newest_date(orders) if newest is None else newest
    if headers is not None:
        orders_detail = lines_in_window(orders_detail, headers, days, newest)
    recent = build_fact_last_3m(orders, days, newest)
    matched = _recent_lines(recent, orders_detail)
    without_lines = recent.join(matched.select("order_id").distinct(), "order_id", "left_anti")
    return _with_line_less(matched, without_lines)


def build_recent_activity(
    orders: DataFrame,
    orders_detail: DataFrame,
    days: int = WINDOW_DAYS,
    newest: Column | None = None,
    headers: DataFrame | None = None,
) -> DataFrame:
    """``build_recent_fact`` with one more row without line for every order.

    Sums and maxima per order ignore NULL lines, so order and customer rollups of both are equal;
    finding the orders without lines, a join of its own, is not needed for them. Row counts and
    sums of header columns over lines (the sales summary) do need ``build_recent_fact``, and so does
    any rollup where headers and lines share a column: its header value stands in every row. Load
    metadata, which every stored table has, is left aside: no rollup reads it.
    """
    orders = orders.drop(*METADATA_COLUMNS)
    if set(orders.columns) & set(orders_detail.columns) - {"order_id"}:
        return build_recent_fact(orders, orders_detail, days, newest, headers)
    newest = newest_date(orders) if newest is None else newest
    if headers is not None:
        orders_detail = lines_in_window(orders_detail, headers, days, newest)
    recent = build_fact_last_3m(orders, days, newest)
    return _with_line_less(_recent_lines(recent, orders_detail), recent)
