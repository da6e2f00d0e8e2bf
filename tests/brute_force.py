"""Plain Python evaluation of the feature pipeline, row by row, for small inputs."""

from collections import defaultdict
from datetime import timedelta


def _rank(value):
    return (value is None, 0 if value is None else value)


def one_per_key(rows, columns, keys):
    others = [c for c in columns if c not in keys]
    best = {}
    for row in rows:
        key = tuple(row[k] for k in keys)
        rank = tuple(_rank(row[c]) for c in others)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, row)
    return [row for _, row in best.values()]


def fact(headers, lines, header_columns, line_columns):
    orders = [
        h
        for h in one_per_key(headers, header_columns, ["order_id"])
        if h["order_net_amount"] is not None and h["order_net_amount"] > 0
    ]
    kept = [
        n
        for n in one_per_key(lines, line_columns, ["order_id", "line_id"])
        if n["qty_units"] is not None and n["qty_units"] > 0
    ]
    by_order = defaultdict(list)
    for n in kept:
        if n["order_id"] is not None:
            by_order[n["order_id"]].append(n)
    empty = {c: None for c in line_columns}
    return [{**empty, **n, **h} for h in orders for n in by_order.get(h["order_id"]) or [empty]]


def window(rows, days=90):
    dates = [r["order_date"] for r in rows if r["order_date"] is not None]
    if not dates:
        return []
    start = max(dates) - timedelta(days=days)
    return [r for r in rows if r["order_date"] is not None and r["order_date"] >= start]


def features(rows):
    """Features per customer of the window rows."""
    if not rows:
        return {}
    reference = max(r["order_date"] for r in rows).date()
    customers = defaultdict(lambda: defaultdict(list))
    for r in rows:
        customers[r["customer_id"]][r["order_id"]].append(r)
    result = {}
    for customer, orders in customers.items():
        amounts, credit, promo, dates = [], 0, 0, []
        categories = set()
        for lines in orders.values():
            known = [n["line_net_amount"] for n in lines if n["line_net_amount"] is not None]
            amount = sum(known) if known else None
            amounts.append(amount)
            dates.append(lines[0]["order_date"])
            promo += any(n["promo_flag"] == 1 for n in lines)
            if lines[0]["tipo_pago"] == "credito" and amount is not None:
                credit += amount
            categories |= {n["product_category"] for n in lines} - {None}
        known = [a for a in amounts if a is not None]
        sales = float(sum(known)) if known else None
        count = len([o for o in orders if o is not None])
        dates.sort()
        gaps = [(b.date() - a.date()).days for a, b in zip(dates, dates[1:])]
        result[customer] = (
            sales,
            (reference - dates[-1].date()).days,
            count,
            sales / count if sales is not None and count else None,
            sum(gaps) / len(gaps) if gaps else None,
            len(categories),
            promo / count if count else 0.0,
            float(credit) / sales if sales is not None and sales > 0 else 0.0,
        )
    return result
