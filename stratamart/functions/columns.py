"""Column expressions and column-name helpers shared by the layers."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Expressions are written as SQL text where they are fixed: one call to the JVM each, while every
# operator of a Column tree is a call of its own.


def quoted(name: str) -> str:
    """A column name for use in SQL text."""
    return f"`{name.replace('`', '``')}`"


def text_literal(value: str) -> str:
    """A string constant for use in SQL text."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def stacked(rows: list[tuple[str, ...]], names: tuple[str, ...]) -> str:
    """SQL that turns one row into ``rows``, each given as SQL values for the columns ``names``."""
    values = ", ".join(value for row in rows for value in row)
    return f"stack({len(rows)}, {values}) AS ({', '.join(map(quoted, names))})"


def guarded_ratio(numerator: str, denominator: str, fallback: str = "NULL") -> str:
    """SQL for the ratio as a double where the denominator is positive, else ``fallback``."""
    ratio = f"CAST({numerator} AS DOUBLE) / CAST({denominator} AS DOUBLE)"
    return f"CASE WHEN {denominator} > 0 THEN {ratio} ELSE CAST({fallback} AS DOUBLE) END"


def interval_days(days: int) -> Column:
    return F.expr(f"INTERVAL '{int(days)}' DAY")


def calendar_columns(date: str = "date") -> list[str]:
    """SQL for the calendar attributes of a date column; ``day_of_week`` counts from 1 = Sunday."""
    day = quoted(date)
    return [
        f"date_format({day}, 'yyyyMMdd') AS date_key",
        f"{day} AS date",
        f"year({day}) AS year",
        f"month({day}) AS month",
        f"dayofmonth({day}) AS day",
        f"dayofweek({day}) AS day_of_week",
    ]


def standard_names(columns: list[str]) -> list[str]:
    """Trimmed lower-case names with underscores: `` Customer ID `` becomes ``customer_id``.

    Accents are taken off, so that ``Año`` becomes ``ano``; a name of which nothing is left is refused.
    """
    names = []
    for name in columns:
        apart = unicodedata.normalize("NFKD", name.strip().lower())
        plain = "".join(c for c in apart if not unicodedata.combining(c))
        names.append(re.sub(r"[^0-9a-z]+", "_", plain).strip("_"))
        if not names[-1]:
            raise ValueError(f"column without letters or digits in its name: {name!r}")
    clashes = sorted(name for name, uses in Counter(names).items() if uses > 1)
    if clashes:
        raise ValueError(f"columns with the same standardised name: {clashes}")
    return names


def standardise_columns(df: DataFrame) -> DataFrame:
    """The columns under their ``standard_names``."""
    return df.toDF(*standard_names(df.columns))
