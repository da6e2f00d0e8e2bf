"""Table contracts: column names and types of every table in the three layers.

Amounts are decimals of at most 18 digits, which Spark keeps in a long: sums are exact and do
not depend on the order rows arrive in. Published Gold amounts are doubles.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the business rules.
WINDOW_DAYS = 90
CHANNEL_TRADITIONAL = "tradicional"
STATE_ACTIVE = "activo"
PAYMENT_CREDIT = "credito"

# Columns Bronze adds to every table.
INGESTION_TIMESTAMP = "ingestion_timestamp"
SOURCE_FILE = "source_file"
METADATA_COLUMNS = (INGESTION_TIMESTAMP, SOURCE_FILE)

# Physical partition column of the fact on disk; never part of the logical fact.
FACT_PARTITION = "order_month"

HEADER_AMOUNT = T.DecimalType(18, 2)
LINE_AMOUNT = T.DecimalType(18, 4)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CUSTOMERS = _struct(
    customer_id=T.LongType(),
    customer_name=T.StringType(),
    canal=T.StringType(),
    estado=T.StringType(),
)

PRODUCTS = _struct(
    product_id=T.LongType(),
    product_name=T.StringType(),
    product_category=T.StringType(),
    brand=T.StringType(),
)

ORDERS_HEADER = _struct(
    order_id=T.LongType(),
    customer_id=T.LongType(),
    order_date=T.TimestampNTZType(),
    order_net_amount=HEADER_AMOUNT,
    tipo_pago=T.StringType(),
)

ORDERS_DETAIL = _struct(
    order_id=T.LongType(),
    line_id=T.LongType(),
    product_id=T.LongType(),
    qty_units=T.LongType(),
    line_net_amount=LINE_AMOUNT,
    promo_flag=T.IntegerType(),
    product_category=T.StringType(),
)

BRONZE = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders_header": ORDERS_HEADER,
    "orders_detail": ORDERS_DETAIL,
}

# Identifiers: compared, never computed with, so they keep the type they come in where it is text.
KEY_COLUMNS = ("customer_id", "product_id", "order_id", "line_id")

# Columns that hold a yes/no value and are stored as 1/0.
FLAG_COLUMNS = ("promo_flag",)

DIM_FEATURES = _struct(
    customer_id=T.LongType(),
    ventas_total_3m=T.DoubleType(),
    recencia_dias=T.LongType(),
    frecuencia_pedidos_3m=T.LongType(),
    ticket_promedio_3m=T.DoubleType(),
    dias_promedio_entre_pedidos=T.DoubleType(),
    variedad_categorias_3m=T.LongType(),
    porcentaje_pedidos_promo_3m=T.DoubleType(),
    mix_credito_vs_contado_3m=T.DoubleType(),
)


def as_text(contract: T.StructType) -> T.StructType:
    """The same columns, all strings: for loads that must accept malformed values."""
    return T.StructType([T.StructField(field.name, T.StringType()) for field in contract])
