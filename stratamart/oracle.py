"""Reference SQL for every registered query, for DuckDB over the base tables.

The blocks are common table expressions in dependency order; ``_sql`` puts those a query needs in
front of its body.
"""

from __future__ import annotations

SOURCES = """
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'tradicional' ELSE 'moderno' END AS canal,
         CASE WHEN c_acctbal > 0 THEN 'activo' ELSE 'inactivo' END AS estado
  FROM customer),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_category, p_brand AS brand
  FROM part),
orders_header AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
         CAST(o_totalprice AS DECIMAL(18,2)) - 20000 AS order_net_amount,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'credito' ELSE 'contado' END AS tipo_pago
  FROM orders),
orders_detail AS (
  SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_id, l_partkey AS product_id,
         CAST(l_quantity AS BIGINT) - 3 AS qty_units,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS line_net_amount,
         CAST(CASE WHEN l_discount >= 0.08 THEN 1 ELSE 0 END AS INTEGER) AS promo_flag,
         p_type AS product_category
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""

SILVER = """
oh AS (SELECT * FROM orders_header WHERE order_net_amount > 0),
od_all AS (
  SELECT order_id, line_id, product_id, qty_units, line_net_amount, promo_flag, product_category
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, line_id
          ORDER BY product_id NULLS LAST, qty_units NULLS LAST, line_net_amount NULLS LAST,
                   promo_flag NULLS LAST, product_category NULLS LAST) AS rn
        FROM orders_detail) t
  WHERE rn = 1),
od AS (SELECT * FROM od_all WHERE qty_units > 0),
fact AS (
  SELECT oh.order_id, oh.customer_id, oh.order_date, oh.order_net_amount, oh.tipo_pago,
         od.line_id, od.product_id, od.qty_units, od.line_net_amount, od.promo_flag, od.product_category
  FROM oh LEFT JOIN od ON oh.order_id = od.order_id)"""

WINDOW = """
fact_3m AS (
  SELECT * FROM fact WHERE order_date >= (SELECT MAX(order_date) FROM fact) - INTERVAL '90' DAY),
ord AS (
  SELECT customer_id, order_id, MIN(order_date) AS order_date, SUM(line_net_amount) AS order_amount,
         MAX(promo_flag) AS has_promo, MAX(tipo_pago) AS tipo_pago
  FROM fact_3m GROUP BY customer_id, order_id)"""

FEATURES = """
agg AS (
  SELECT customer_id, SUM(order_amount) AS ventas, COUNT(DISTINCT order_id) AS freq,
         COUNT(order_date) AS dated, MIN(order_date) AS first_d, MAX(order_date) AS last_d,
         SUM(CASE WHEN has_promo = 1 THEN 1 ELSE 0 END) AS promo,
         SUM(CASE WHEN tipo_pago = 'credito' THEN order_amount ELSE 0 END) AS cred
  FROM ord GROUP BY customer_id),
prev AS (
  SELECT customer_id, order_id, order_date,
         LAG(order_date) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS prev_order_date
  FROM ord),
gaps AS (
  SELECT customer_id, AVG(CAST(order_date AS DATE) - CAST(prev_order_date AS DATE)) AS dias
  FROM prev WHERE prev_order_date IS NOT NULL GROUP BY customer_id),
cats AS (SELECT customer_id, COUNT(DISTINCT product_category) AS variedad FROM fact_3m GROUP BY customer_id),
features_all AS (
  SELECT a.customer_id,
         CAST(ventas AS DOUBLE) AS ventas_total_3m,
         CAST(CAST((SELECT MAX(order_date) FROM fact_3m) AS DATE) - CAST(last_d AS DATE) AS BIGINT) AS recencia_dias,
         CAST(freq AS BIGINT) AS frecuencia_pedidos_3m,
         CASE WHEN freq > 0 THEN CAST(ventas AS DOUBLE) / freq END AS ticket_promedio_3m,
         CAST(dias AS DOUBLE) AS dias_promedio_entre_pedidos,
         CAST(variedad AS BIGINT) AS variedad_categorias_3m,
         CASE WHEN freq > 0 THEN CAST(promo AS DOUBLE) / freq ELSE 0.0 END AS porcentaje_pedidos_promo_3m,
         CASE WHEN ventas > 0 THEN CAST(cred AS DOUBLE) / CAST(ventas AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
           AS mix_credito_vs_contado_3m
  FROM agg a
  LEFT JOIN gaps g ON g.customer_id = a.customer_id
  LEFT JOIN cats k ON k.customer_id = a.customer_id),
dim_features AS (
  SELECT f.* FROM features_all f JOIN customers c ON c.customer_id = f.customer_id
  WHERE canal = 'tradicional' AND estado = 'activo' AND frecuencia_pedidos_3m >= 1),
sales AS (
  SELECT customer_id, SUM(order_net_amount) AS total_order, SUM(line_net_amount) AS total_line,
         SUM(qty_units) AS total_qty
  FROM fact_3m GROUP BY customer_id),
gold_sales AS (
  SELECT s.customer_id, CAST(total_order AS DOUBLE) AS total_order_net_amount_3m,
         CAST(total_line AS DOUBLE) AS total_line_net_amount_3m,
         CAST(total_qty AS BIGINT) AS total_qty_units_3m, customer_name, canal, estado
  FROM sales s LEFT JOIN customers c ON c.customer_id = s.customer_id)"""


HEADER_COLUMNS = "order_id customer_id order_date order_net_amount tipo_pago".split()
DETAIL_COLUMNS = (
    "order_id line_id product_id qty_units line_net_amount promo_flag product_category".split()
)


def _sql(body: str, *blocks: str) -> str:
    return f"WITH {','.join(blocks)}\n{body}" if blocks else body


def _src(body: str) -> str:
    return _sql(body, SOURCES)


def _silver(body: str) -> str:
    return _sql(body, SOURCES, SILVER)


def _window(body: str) -> str:
    return _sql(body, SOURCES, SILVER, WINDOW)


def _gold(body: str) -> str:
    return _sql(body, SOURCES, SILVER, WINDOW, FEATURES)


_HEADER = """order_id, customer_id, order_date, CAST(order_net_amount AS DOUBLE) AS order_net_amount,
       tipo_pago"""
_DETAIL = """order_id, line_id, product_id, qty_units, CAST(line_net_amount AS DOUBLE) AS line_net_amount,
       promo_flag, product_category"""
_FACT = """order_id, customer_id, order_date, CAST(order_net_amount AS DOUBLE) AS order_net_amount, tipo_pago,
       line_id, product_id, qty_units, CAST(line_net_amount AS DOUBLE) AS line_net_amount, promo_flag,
       product_category"""


def _dedup(source: str, key: str, order: str, columns: str) -> str:
    """Survivors of a source table doubled by changed copies."""
    ranks = ", ".join(f"{c} NULLS LAST" for c in order.split(", "))
    return f"""SELECT {columns} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {ranks}) AS rn FROM ({source}) d) t
WHERE rn = 1"""


def _grade(violations: str, grade: str) -> str:
    if grade == "info":
        return "'info'"
    return f"CASE WHEN {violations} = 0 THEN 'ok' ELSE '{grade}' END"


def _check(table: str, check: str, column: str, violations: str, grade: str) -> str:
    """One report row; ``violations`` is a scalar query."""
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\", "
        f"CAST(v AS BIGINT) AS violations, {_grade('v', grade)} AS status FROM ({violations}) q(v)"
    )


def _count_where(source: str, condition: str) -> str:
    return f"SELECT COUNT(*) FROM {source} WHERE {condition}"


def _nulls(table: str, source: str, columns: list[str]) -> list[str]:
    return [
        _check(table, "nulls", c, _count_where(source, f"{c} IS NULL"), "warn") for c in columns
    ]


def _negatives(table: str, source: str, columns: list[str]) -> list[str]:
    return [
        _check(table, "negative", c, _count_where(source, f"{c} < 0"), "warn") for c in columns
    ]


def _unit_range(table: str, source: str, columns: list[str]) -> list[str]:
    rows = []
    for c in columns:
        rows.append(_check(table, "below_0", c, _count_where(source, f"{c} < 0"), "warn"))
        rows.append(_check(table, "above_1", c, _count_where(source, f"{c} > 1"), "warn"))
    return rows


def _rows(table: str, source: str) -> str:
    return _check(table, "row_count", "*", f"SELECT COUNT(*) FROM {source}", "info")


def _duplicates(table: str, source: str, key: str) -> str:
    repeated = f"SELECT COUNT(*) FROM (SELECT {key} FROM {source} GROUP BY {key} HAVING COUNT(*) > 1) k"
    return _check(table, "duplicate_keys", key.replace(" ", ""), repeated, "fail")


def _orphans(
    table: str, child: str, parent: str, key: str, check: str, grade: str = "fail"
) -> str:
    missing = (
        f"SELECT COUNT(*) FROM (SELECT DISTINCT {key} FROM {child}) c "
        f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key})"
    )
    return _check(table, check, key, missing, grade)


def _union(rows: list[str]) -> str:
    return "\nUNION ALL\n".join(rows)


CUSTOMER_COLUMNS = ["customer_id", "customer_name", "canal", "estado"]
PRODUCT_COLUMNS = ["product_id", "product_name", "product_category", "brand"]
FACT_COLUMNS = [
    "order_id",
    "customer_id",
    "order_date",
    "order_net_amount",
    "tipo_pago",
    "line_id",
    "product_id",
    "qty_units",
    "line_net_amount",
    "promo_flag",
    "product_category",
]
FACT_AMOUNTS = ["qty_units", "order_net_amount", "line_net_amount"]
FEATURE_COLUMNS = [
    "customer_id",
    "ventas_total_3m",
    "recencia_dias",
    "frecuencia_pedidos_3m",
    "ticket_promedio_3m",
    "dias_promedio_entre_pedidos",
    "variedad_categorias_3m",
    "porcentaje_pedidos_promo_3m",
    "mix_credito_vs_contado_3m",
]
SHARES = FEATURE_COLUMNS[7:]
OPTIONAL = ["ticket_promedio_3m", "dias_promedio_entre_pedidos"]

ELIGIBLE = "(SELECT customer_id FROM customers WHERE canal = 'tradicional' AND estado = 'activo')"

DOUBLED_CUSTOMERS = """SELECT * FROM customers UNION ALL
  SELECT customer_id, customer_name, canal,
         CASE WHEN estado = 'activo' THEN 'inactivo' ELSE 'activo' END FROM customers"""
DOUBLED_PRODUCTS = """SELECT * FROM products UNION ALL
  SELECT product_id, product_name, product_category, 'Brand#30' FROM products"""
DOUBLED_HEADERS = """SELECT * FROM orders_header UNION ALL
  SELECT order_id, customer_id, order_date, -order_net_amount, tipo_pago FROM orders_header"""


def _feature(column: str) -> str:
    return _gold(f"SELECT customer_id, {column} FROM features_all")


def _units(column: str) -> int:
    """Units of the last decimal in one."""
    return {"qty_units": 1, "order_net_amount": 100}.get(column, 10_000)


def _whole(column: str) -> str:
    return f"CAST({column} * {_units(column)} AS HUGEINT)"


def _statistics(columns: list[str]) -> str:
    return _union(
        [
            f"SELECT '{c}' AS \"column\", COUNT({c}) AS \"count\", "
            f"CAST(SUM({c}) AS DOUBLE) / COUNT({c}) AS mean, "
            f"SQRT(CAST(COUNT({c}) * SUM({_whole(c)} * {_whole(c)}) - SUM({_whole(c)}) * SUM({_whole(c)}) AS DOUBLE) "
            f"/ CAST(CAST(COUNT({c}) AS HUGEINT) * (COUNT({c}) - 1) AS DOUBLE)) / CAST({_units(c)} AS DOUBLE) AS stddev, "
            f"CAST(MIN({c}) AS DOUBLE) AS \"min\", CAST(MAX({c}) AS DOUBLE) AS \"max\" FROM fact"
            for c in columns
        ]
    )


# Order headers as text, with unreadable amounts and dates put in.
RAW_HEADERS = """
raw_headers AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, 'C' || CAST(customer_id AS VARCHAR) AS customer_id,
         CASE WHEN order_net_amount <= 0 THEN 'unknown'
              ELSE strftime(order_date, '%Y-%m-%d %H:%M:%S') END AS order_date,
         CASE WHEN tipo_pago = 'credito' THEN 'x'
              WHEN order_id % 7 = 0 THEN CAST(order_net_amount AS VARCHAR) || '0000000001'
              ELSE CAST(order_net_amount AS VARCHAR) END AS order_net_amount,
         tipo_pago
  FROM orders_header),
typed_headers AS (
  SELECT order_id, customer_id, TRY_CAST(order_date AS TIMESTAMP) AS order_date,
         TRY_CAST(order_net_amount AS DOUBLE) AS order_net_amount, tipo_pago
  FROM raw_headers)"""

# Order lines with half units and floating-point numbers of up to thirteen decimals: all are kept.
LOOSE_LINES = """
raw_lines AS (
  SELECT order_id, line_id, product_id,
         CAST(qty_units AS DOUBLE) + CASE WHEN line_id = 2 THEN 0.5 ELSE 0 END AS qty_units,
         CASE WHEN line_id = 3 THEN 1e-13 ELSE CAST(line_net_amount AS DOUBLE) END AS line_net_amount,
         promo_flag, product_category
  FROM orders_detail),
typed_lines AS (SELECT * FROM raw_lines)"""

# Header amounts with the noise of floating-point arithmetic, some of twenty digits.
NOISY_HEADERS = """
noisy_headers AS (
  SELECT * REPLACE (
    CASE order_id % 3 WHEN 0 THEN CAST(order_net_amount AS DOUBLE) / 3
                      WHEN 1 THEN CAST(order_net_amount AS DOUBLE) * 1e15
                      ELSE CAST(order_net_amount AS DOUBLE) + 0.1 + 0.2 END AS order_net_amount)
  FROM orders_header)"""


def _rejects(columns: list[str], of: str = "headers") -> str:
    return _union(
        [
            f"SELECT '{c}' AS \"column\", (SELECT COUNT({c}) FROM raw_{of}) - "
            f"(SELECT COUNT({c}) FROM typed_{of}) AS rejects"
            for c in columns
        ]
    )


def oracle_sql() -> dict[str, str]:
    flagship = _gold(f"SELECT {', '.join(FEATURE_COLUMNS)} FROM dim_features")
    gold_sales = _gold("SELECT * FROM gold_sales")
    window_fact = _window(f"SELECT {_FACT} FROM fact_3m")
    return {
        "dim_features": flagship,
        "medallion_end_to_end": flagship,
        # Sources and sinks
        "csv_glob_scan": _src("SELECT * FROM customers"),
        "csv_glob_mixed_headers": _src(
            "SELECT *, CASE WHEN customer_id % 2 = 1 THEN substr(customer_name, 1, 3) END AS region "
            "FROM customers"
        ),
        "ingest_metadata": _src(
            'SELECT COUNT(*) AS "rows", COUNT(*) AS rows_with_load_time, CAST(3 AS BIGINT) AS extracts '
            "FROM customers"
        ),
        "bronze_customers": _src("SELECT * FROM customers"),
        "bronze_products": _src("SELECT * FROM products"),
        "bronze_orders_header": _src(f"SELECT {_HEADER} FROM orders_header"),
        "bronze_orders_detail": _src(f"SELECT {_DETAIL} FROM orders_detail"),
        "standardise_columns": _src("SELECT * FROM customers"),
        "typed_silver": _sql(f"SELECT {_HEADER} FROM typed_headers", SOURCES, RAW_HEADERS),
        "typed_silver_noisy_headers": _sql(
            "SELECT * FROM noisy_headers WHERE order_net_amount > 0", SOURCES, NOISY_HEADERS
        ),
        "typed_silver_lines": _sql("SELECT * FROM typed_lines", SOURCES, LOOSE_LINES),
        "typed_silver_lines_rejects": _sql(_rejects(DETAIL_COLUMNS, "lines"), SOURCES, LOOSE_LINES),
        "bronze_customers_more_columns": _src(
            "SELECT *, substr(customer_name, 1, 3) AS region FROM customers"
        ),
        "orders_3m_shared_columns": _window(
            "SELECT customer_id, order_id, order_date, CAST(7 * line_rows AS DOUBLE) AS order_amount, "
            "CAST(order_id % 2 AS INTEGER) AS has_promo, tipo_pago FROM ord "
            "JOIN (SELECT order_id, COUNT(*) AS line_rows FROM fact_3m GROUP BY order_id) USING (order_id)"
        ),
        "typed_silver_rejects": _sql(
            _rejects(["order_id", "customer_id", "order_date", "order_net_amount", "tipo_pago"]),
            SOURCES,
            RAW_HEADERS,
        ),
        "parquet_scan": "SELECT * FROM orders",
        "parquet_overwrite": 'SELECT COUNT(*) AS "rows" FROM orders',
        "gold_single_file_sink": gold_sales,
        # Deduplication, filters, joins
        "dim_customer": _src(
            _dedup(
                DOUBLED_CUSTOMERS,
                "customer_id",
                "customer_name, canal, estado",
                ", ".join(CUSTOMER_COLUMNS),
            )
        ),
        "dim_product": _src(
            _dedup(
                DOUBLED_PRODUCTS,
                "product_id",
                "product_name, product_category, brand",
                ", ".join(PRODUCT_COLUMNS),
            )
        ),
        "dedup_orders_header": _src(
            _dedup(
                DOUBLED_HEADERS,
                "order_id",
                "customer_id, order_date, order_net_amount, tipo_pago",
                _HEADER,
            )
        ),
        "dedup_orders_detail": _silver(f"SELECT {_DETAIL} FROM od_all"),
        "filter_positive_orders": _src(
            f"SELECT {_HEADER} FROM orders_header WHERE order_net_amount > 0"
        ),
        "filter_positive_lines": _src(f"SELECT {_DETAIL} FROM orders_detail WHERE qty_units > 0"),
        "join_without_duplicate_columns": _silver(
            "SELECT order_id, customer_id, line_id, product_id FROM fact"
        ),
        "fact_order_line": _silver(f"SELECT {_FACT} FROM fact"),
        "fact_key_is_unique": _silver(
            _union(
                [
                    _duplicates("fact_order_line", "fact", "order_id, line_id"),
                    _duplicates("orders_detail", "orders_detail", "order_id, line_id"),
                ]
            )
        ),
        "dim_date": _silver(
            """SELECT strftime(d, '%Y%m%d') AS date_key, d AS "date", CAST(year(d) AS INTEGER) AS "year",
       CAST(month(d) AS INTEGER) AS "month", CAST(day(d) AS INTEGER) AS "day",
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week
FROM (SELECT DISTINCT CAST(order_date AS DATE) AS d FROM fact) t"""
        ),
        "max_order_date": _silver("SELECT MAX(order_date) AS max_order_date FROM fact"),
        "fact_last_90d": window_fact,
        "recent_fact": window_fact,
        # Order and customer level
        "orders_3m": _window(
            "SELECT customer_id, order_id, order_date, CAST(order_amount AS DOUBLE) AS order_amount, "
            "has_promo, tipo_pago FROM ord"
        ),
        "customer_order_stats_3m": _gold(
            "SELECT customer_id, CAST(ventas AS DOUBLE) AS sales, freq AS orders, dated AS dated_orders, "
            "first_d AS first_order_date, last_d AS last_order_date, CAST(promo AS BIGINT) AS promo_orders, "
            "CAST(cred AS DOUBLE) AS credit_sales FROM agg"
        ),
        "total_sales_3m": _feature("ventas_total_3m"),
        "recency_days": _feature("recencia_dias"),
        "order_frequency_3m": _feature("frecuencia_pedidos_3m"),
        "avg_ticket_3m": _feature("ticket_promedio_3m"),
        "category_variety_3m": _feature("variedad_categorias_3m"),
        "promo_order_share_3m": _feature("porcentaje_pedidos_promo_3m"),
        "credit_share_3m": _feature("mix_credito_vs_contado_3m"),
        "order_gaps": _gold(
            "SELECT customer_id, order_id, order_date, prev_order_date, "
            "CAST(CAST(order_date AS DATE) - CAST(prev_order_date AS DATE) AS BIGINT) AS diff_days FROM prev"
        ),
        "avg_days_between_orders": _gold(
            "SELECT customer_id, CAST(dias AS DOUBLE) AS dias_promedio_entre_pedidos FROM gaps"
        ),
        "active_traditional_customers": _src(f"SELECT customer_id FROM {ELIGIBLE} e"),
        "features_join_customer": _gold(
            "SELECT a.customer_id, CAST(ventas AS DOUBLE) AS sales, freq AS orders, canal, estado "
            "FROM agg a JOIN customers c ON c.customer_id = a.customer_id"
        ),
        "gold_sales_customer_3m": gold_sales,
        # Data quality
        "null_counts": _silver(_union(_nulls("fact_order_line", "fact", FACT_COLUMNS))),
        "negative_counts": _silver(
            _union(
                _negatives("customer", "customer", ["c_acctbal"])
                + _negatives("fact_order_line", "fact", FACT_AMOUNTS)
            )
        ),
        "unit_range_violations": _union(
            _unit_range("lineitem", "lineitem", ["l_discount", "l_quantity"])
        ),
        "duplicate_keys": _src(
            _union(
                [
                    _duplicates("lineitem", "lineitem", "l_orderkey, l_linenumber"),
                    _duplicates("customers", "customers", "customer_id"),
                    _duplicates("products", "products", "product_id"),
                ]
            )
        ),
        "fk_violations": _silver(
            _union(
                [
                    _orphans(
                        "fact_order_line",
                        "fact",
                        "(SELECT * FROM customers WHERE canal = 'tradicional')",
                        "customer_id",
                        "foreign_key_traditional_customers",
                    ),
                    _orphans(
                        "fact_order_line",
                        "fact",
                        "customers",
                        "customer_id",
                        "foreign_key_dim_customer",
                    ),
                    _orphans(
                        "fact_order_line",
                        "fact",
                        "products",
                        "product_id",
                        "foreign_key_dim_product",
                    ),
                ]
            )
        ),
        "features_not_eligible": _window(
            _orphans("fact_3m", "fact_3m", ELIGIBLE, "customer_id", "not_eligible", "warn")
        ),
        "features_not_in_sales": _window(
            _orphans("customers", "customers", "fact_3m", "customer_id", "not_in_sales", "warn")
        ),
        "reconcile_features_vs_sales": _gold(
            "SELECT f.customer_id, ventas_total_3m, total_line_net_amount_3m, total_order_net_amount_3m, "
            "total_qty_units_3m, frecuencia_pedidos_3m, variedad_categorias_3m, "
            "ventas_total_3m - total_line_net_amount_3m AS difference "
            "FROM features_all f JOIN gold_sales s ON s.customer_id = f.customer_id"
        ),
        "layer_row_counts": _gold(
            _union(
                [
                    f"SELECT '{table}' AS \"table\", (SELECT COUNT(*) FROM {source}) AS \"rows\""
                    for table, source in {
                        "customers": "customers",
                        "products": "products",
                        "orders_header": "orders_header",
                        "orders_detail": "orders_detail",
                        "dim_customer": "customers",
                        "dim_product": "products",
                        "fact_order_line": "fact",
                        "gold_sales_customer_3m": "gold_sales",
                        "dim_features": "dim_features",
                    }.items()
                ]
            )
        ),
        "describe_fact": _silver(_statistics(FACT_AMOUNTS)),
        "preview_first_5": _src("SELECT * FROM customers ORDER BY customer_id LIMIT 5"),
        "quality_report": _gold(
            _union(
                [
                    *[
                        _check(table, "rejects", c, "SELECT 0", "warn")
                        for table, columns in {
                            "customers": CUSTOMER_COLUMNS,
                            "products": PRODUCT_COLUMNS,
                            "orders_header": HEADER_COLUMNS,
                            "orders_detail": DETAIL_COLUMNS,
                        }.items()
                        for c in columns
                    ],
                    _rows("customers", "customers"),
                    *_nulls("customers", "customers", CUSTOMER_COLUMNS),
                    _rows("products", "products"),
                    *_nulls("products", "products", PRODUCT_COLUMNS),
                    _rows("orders_header", "orders_header"),
                    _rows("orders_detail", "orders_detail"),
                    _rows("dim_customer", "customers"),
                    *_nulls("dim_customer", "customers", CUSTOMER_COLUMNS),
                    _rows("dim_product", "products"),
                    *_nulls("dim_product", "products", PRODUCT_COLUMNS),
                    _rows("fact_order_line", "fact"),
                    *_nulls(
                        "fact_order_line", "fact", [c for c in FACT_COLUMNS if c != "promo_flag"]
                    ),
                    *_negatives("fact_order_line", "fact", FACT_AMOUNTS),
                    _duplicates("dim_customer", "customers", "customer_id"),
                    _duplicates("dim_product", "products", "product_id"),
                    _orphans(
                        "fact_order_line",
                        "fact",
                        "customers",
                        "customer_id",
                        "foreign_key_dim_customer",
                    ),
                    _orphans(
                        "fact_order_line",
                        "fact",
                        "products",
                        "product_id",
                        "foreign_key_dim_product",
                    ),
                    _rows("gold_sales_customer_3m", "gold_sales"),
                    _check("dim_features", "contract", "*", "SELECT 0", "fail"),
                    _duplicates("dim_features", "dim_features", "customer_id"),
                    _rows("dim_features", "dim_features"),
                    *_nulls(
                        "dim_features",
                        "dim_features",
                        [c for c in FEATURE_COLUMNS if c not in OPTIONAL],
                    ),
                    *_negatives("dim_features", "dim_features", FEATURE_COLUMNS[1:7]),
                    *_unit_range("dim_features", "dim_features", SHARES),
                    _orphans(
                        "dim_features",
                        "dim_features",
                        ELIGIBLE,
                        "customer_id",
                        "not_eligible",
                        "warn",
                    ),
                    _orphans(
                        "dim_features",
                        "dim_features",
                        "gold_sales",
                        "customer_id",
                        "not_in_sales",
                        "warn",
                    ),
                    _check(
                        "dim_features",
                        "sales_differ",
                        "ventas_total_3m",
                        "SELECT COUNT(*) FROM dim_features f JOIN gold_sales s "
                        "ON s.customer_id = f.customer_id "
                        "WHERE ventas_total_3m IS DISTINCT FROM total_line_net_amount_3m",
                        "info",
                    ),
                ]
            )
        ),
    }
