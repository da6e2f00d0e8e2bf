"""One row per business key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from stratamart.contracts import INGESTION_TIMESTAMP
from stratamart.functions.columns import quoted


def _sortable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_sortable(field.dataType) for field in kind)
    return not isinstance(kind, (MapType, VariantType))


def _order_key(name: str, kind: DataType) -> str:
    """The column, or a text of it where it holds a map or variant and so has no order."""
    if _sortable(kind):
        return quoted(name)
    if isinstance(kind, MapType) and _sortable(kind.keyType) and _sortable(kind.valueType):
        return f"array_sort(map_entries({quoted(name)}))"
    return f"to_json(struct({quoted(name)}))"


def keep_one_per_key(
    df: DataFrame,
    keys: list[str],
    newest_by: str | None = INGESTION_TIMESTAMP,
    own_partitioning: bool = True,
) -> DataFrame:
    """Keep one row per key; NULL keys are equal. The survivor is the newest row by ``newest_by``
    (where the column exists), then the smallest by the other columns in order, NULLs last.

    The rank filter becomes a group limit before the shuffle: each task sends at most one row per
    key, so a key with many copies does not pile up in one task.

    A join on ``keys`` reuses the partitioning of the result. Adaptive execution only splits hot keys
    of a join that shuffles both of its sides: for the unique side of a join with many rows per key
    pass ``own_partitioning=False``, which ranks by a copy of the keys and costs that shuffle.
    """
    columns = df.columns
    order = [f"{quoted(newest_by)} DESC NULLS LAST"] if newest_by in columns else []
    order += [
        f"{_order_key(field.name, field.dataType)} ASC NULLS LAST"
        for field in df.schema
        if field.name not in keys and field.name != newest_by
    ]
    if not order:
        return df.dropDuplicates(keys)
    by = {key: quoted(key if own_partitioning else f"_by_{key}") for key in keys}
    rank = f"row_number() OVER (PARTITION BY {', '.join(by.values())} ORDER BY {', '.join(order)})"
    if not own_partitioning:
        df = df.selectExpr("*", *[f"{quoted(key)} AS {copy}" for key, copy in by.items()])
    ranked = df.selectExpr("*", f"{rank} AS _rank").filter("_rank = 1")
    return ranked.select(columns)
