"""Conform loosely typed rows to a table contract without losing a number.

A column takes its contract type where all of the source's values fit it. Where they do not, one
aggregation over the source measures how many digits its numbers have before and after the point,
and the column becomes the narrowest decimal that holds every one of them exactly, or a double where
no decimal can that leaves room for sums. Text keys stay text. What is left as a reject is a value
that is no (finite) number, date or flag at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import DataType, StructField, StructType

from stratamart.contracts import FLAG_COLUMNS, KEY_COLUMNS, SOURCE_FILE
from stratamart.functions.columns import quoted, stacked, text_literal

REJECT_COLUMNS = ("table", "column", "value", "source_file")
#: Digits of the widest decimal. A sum takes ten more and must not pass 38.
MOST_DIGITS = 28
#: Digits of a whole number that a long surely holds.
LONG_DIGITS = 18
_FLOATING = (T.FloatType, T.DoubleType)
_NUMBER = "'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,5})?$'"

Types = dict[str, DataType]


def _holds(kind: DataType, source: DataType) -> bool:
    """Does a numeric contract type hold every value of the source type?"""
    if isinstance(source, T.IntegralType):
        return isinstance(kind, T.LongType) or _digits(kind)[0] >= LONG_DIGITS or source != T.LongType()
    if isinstance(source, T.DecimalType):
        whole, scale = _digits(kind)
        return source.precision - source.scale <= whole and source.scale <= scale
    return False


def _digits(kind: DataType) -> tuple[int, int]:
    """Digits before and after the point that a contract type holds."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return LONG_DIGITS, 0


def _as_text(name: str, source: DataType) -> str:
    column = quoted(name)
    return f"trim({column})" if isinstance(source, T.StringType) else f"CAST({column} AS STRING)"


def _to_measure(df: DataFrame, contract: StructType) -> list[StructField]:
    """Numeric columns whose contract type may be too narrow for their source."""
    found = []
    for field in contract:
        source = df.schema[field.name].dataType
        is_number = isinstance(field.dataType, (T.LongType, T.DecimalType))
        is_text_key = field.name in KEY_COLUMNS and isinstance(source, T.StringType)
        loose = isinstance(source, (T.StringType, T.DecimalType, T.LongType, *_FLOATING))
        if is_number and loose and not is_text_key and source != field.dataType:
            if not _holds(field.dataType, source):
                found.append(field)
    return found


def measured_types(df: DataFrame, contract: StructType) -> Types:
    """The type of each of the contract's columns that holds all its values; one pass at most.

    Only columns whose source type may hold more than the contract's are read.
    """
    types = {}
    for field in _present(df, contract).values():
        source = df.schema[field.name].dataType
        is_text_key = field.name in KEY_COLUMNS and isinstance(source, T.StringType)
        types[field.name] = source if is_text_key else field.dataType
    open_ = _to_measure(df, contract)
    if not open_:
        return types
    texts = [f"{_as_text(f.name, df.schema[f.name].dataType)} AS v{i}" for i, f in enumerate(open_)]
    measures = []
    for i in range(len(open_)):
        v = f"CASE WHEN v{i} RLIKE {_NUMBER} THEN v{i} END"
        exponent = f"coalesce(try_cast(regexp_extract({v}, '[eE]([+-]?[0-9]+)$', 1) AS INT), 0)"
        before = f"length(regexp_extract({v}, '^[+-]?0*([0-9]*)', 1))"
        after = f"length(regexp_extract({v}, '[.]([0-9]*?)0*([eE]|$)', 1))"
        measures.append(f"max(greatest(0, {before} + {exponent})) AS whole_{i}")
        measures.append(f"max(greatest(0, {after} - {exponent})) AS scale_{i}")
    row = df.selectExpr(*texts).selectExpr(*measures).head()
    for i, field in enumerate(open_):
        types[field.name] = _narrowest(field.dataType, row[f"whole_{i}"] or 0, row[f"scale_{i}"] or 0)
    return types


def _narrowest(kind: DataType, whole: int, scale: int) -> DataType:
    most_whole, most_scale = _digits(kind)
    if whole <= most_whole and scale <= most_scale:
        return kind
    if whole + scale <= MOST_DIGITS:
        return T.DecimalType(max(1, whole + scale), scale)
    return T.DoubleType()


def _cast(field: StructField, source: DataType, kind: DataType) -> tuple[str, str]:
    """SQL of a column in a type, and of whether it is a value of that type."""
    column = quoted(field.name)
    if source == kind:
        return column, "true"
    is_text = isinstance(source, T.StringType)
    value = f"trim({column})" if is_text else column
    typed = f"try_cast({value} AS {kind.simpleString()})"
    if field.name in FLAG_COLUMNS and is_text:
        # Text flags come as 1/0 or as true/false.
        typed = f"coalesce({typed}, CAST(try_cast({value} AS BOOLEAN) AS {kind.simpleString()}))"
        return typed, f"{typed} IS NOT NULL"
    if not isinstance(kind, T.NumericType) or isinstance(source, T.BooleanType):
        return typed, f"{typed} IS NOT NULL"
    if isinstance(kind, T.DoubleType):
        number = f"{value} RLIKE {_NUMBER} AND " if is_text else ""
        return typed, f"coalesce({number}abs({typed}) < CAST('Infinity' AS DOUBLE), false)"
    text = _as_text(field.name, source)
    if isinstance(kind, T.DecimalType):
        typed = f"try_cast({text} AS {kind.simpleString()})"
    elif is_text:
        typed = f"try_cast(try_cast({text} AS DECIMAL(38, 18)) AS {kind.simpleString()})"
    if is_text:
        scale = max(18, kind.scale if isinstance(kind, T.DecimalType) else 0)
        whole = f"try_cast({value} AS DECIMAL(38, {scale}))"
        exact = f"{value} RLIKE {_NUMBER} AND coalesce({whole} = {typed}, {typed} IS NOT NULL)"
    elif isinstance(source, _FLOATING):
        exact = f"CAST({typed} AS {source.simpleString()}) = {column}"
    else:
        exact = f"{typed} = {column}"
    return typed, f"coalesce({exact}, false)"


def _direct(field: StructField, typed: str, kind: DataType) -> tuple[str, str]:
    """SQL that reads a text by one cast, and of ``{once}``, its value, whether that is all to know.

    Nearly all numbers are written as Spark writes them. Such a text gives the value of its column
    exactly, without the pattern and the wider casts of ``_cast``, which are left for all others.
    """
    column = quoted(field.name)
    if field.name in FLAG_COLUMNS or not isinstance(kind, T.NumericType):
        return typed, "{once} IS NOT NULL"
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        read = f"try_cast({column} AS {kind.simpleString()})"
        return read, f"CAST({{once}} AS STRING) = {column}"
    return "", ""


def _present(df: DataFrame, contract: StructType) -> dict[str, StructField]:
    missing = [field.name for field in contract if field.name not in df.columns]
    if missing:
        raise ValueError(f"columns required by the contract are missing: {missing}")
    return {field.name: field for field in contract}


def apply_contract(
    df: DataFrame, contract: StructType, strict: bool = False, types: Types | None = None
) -> DataFrame:
    """Cast the contract's columns to ``types``, measured if not given; a reject becomes NULL.

    ``strict`` casts to exactly the contract's types and stops the job at a value that they cannot
    hold exactly. Columns outside the contract are kept unchanged.
    """
    fields = _present(df, contract)
    if strict:
        types = {field.name: field.dataType for field in contract}
    types = types or measured_types(df, contract)
    columns, direct = [], []
    for c in df.schema:
        name = quoted(c.name)
        typed, exact = name, "true"
        if c.name in fields:
            typed, exact = _cast(fields[c.name], c.dataType, types[c.name])
        if exact == "true":
            # Without an alias: plans that read the result twice then share their shuffles.
            columns.append(name if typed == name else f"{typed} AS {name}")
            continue
        cases = f"WHEN {exact} THEN {typed}"
        if isinstance(c.dataType, T.StringType):
            read, known = _direct(fields[c.name], typed, types[c.name])
            if read:
                once = quoted(f"_direct_{c.name}")
                direct.append(f"{read} AS {once}")
                known = known.format(once=once)
                cases = f"WHEN {known} THEN {once}" + (f" {cases}" if read != typed else "")
        if strict:
            said = text_literal(f"column {c.name} cannot hold the value ")
            cases = f"WHEN {name} IS NULL THEN NULL {cases} ELSE raise_error(concat({said}, {name}))"
        columns.append(f"CASE {cases} END AS {name}")
    # A projection of its own, so that the cast is evaluated once for all its uses.
    return (df.selectExpr("*", *direct) if direct else df).selectExpr(*columns)


def reject_counts(df: DataFrame, contract: StructType, types: Types | None = None) -> DataFrame:
    """Rejects per column of the contract: (column, rejects). One pass."""
    types = types or measured_types(df, contract)
    counts, rows = [], []
    for i, field in enumerate(_present(df, contract).values()):
        _, exact = _cast(field, df.schema[field.name].dataType, types[field.name])
        counts.append(f"count_if({quoted(field.name)} IS NOT NULL AND NOT {exact}) AS rejects_{i}")
        rows.append((text_literal(field.name), f"rejects_{i}"))
    return df.selectExpr(*counts).selectExpr(stacked(rows, ("column", "rejects")))


def rejected_values(
    df: DataFrame, contract: StructType, table: str, types: Types | None = None
) -> DataFrame:
    """One row per reject: (table, column, value, source_file), the value as text."""
    types = types or measured_types(df, contract)
    found = []
    for field in _present(df, contract).values():
        _, exact = _cast(field, df.schema[field.name].dataType, types[field.name])
        name = quoted(field.name)
        if exact != "true":
            value = f"CASE WHEN {name} IS NOT NULL AND NOT {exact} THEN CAST({name} AS STRING) END"
            found.append(f"struct({text_literal(field.name)} AS column, {value} AS value)")
    source = quoted(SOURCE_FILE) if SOURCE_FILE in df.columns else "CAST(NULL AS STRING)"
    if not found:
        nothing = "CAST(NULL AS STRING)"
        return df.selectExpr(
            f"{text_literal(table)} AS table", f"{nothing} AS column", f"{nothing} AS value",
            f"{source} AS source_file",
        ).where(F.lit(False))
    rows = df.selectExpr(
        f"{source} AS source_file",
        f"inline(filter(array({', '.join(found)}), x -> x.value IS NOT NULL))",
    )
    return rows.selectExpr(f"{text_literal(table)} AS table", "column", "value", "source_file")
