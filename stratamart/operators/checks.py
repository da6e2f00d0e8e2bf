"""Data-quality checks. Each returns report rows (table, check, column, violations, status).

Status is ``ok`` without violations, else ``warn`` or ``fail`` by the kind of check; plain figures
are ``info``. All checks stay lazy; a report is the union of the checks it needs.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, StructType

from stratamart import contracts
from stratamart.functions.columns import guarded_ratio, quoted, stacked, text_literal

REPORT_COLUMNS = ("table", "check", "column", "violations", "status")


def _graded(violations: str, grade: str) -> str:
    if grade == "info":
        return "'info'"
    return f"CASE WHEN {violations} = 0 THEN 'ok' ELSE '{grade}' END"


def _report_rows(counts: DataFrame, table: str, rows: list[tuple[str, str, str, str]]) -> DataFrame:
    """Turn one row of counts into report rows, given (check, column, name of the count, grade)."""
    values = [
        (*map(text_literal, (table, check, column)), count, _graded(count, grade))
        for check, column, count, grade in rows
    ]
    return counts.selectExpr(stacked(values, REPORT_COLUMNS))


def profile(
    df: DataFrame,
    table: str,
    nulls_except: Iterable[str] | None = None,
    non_negative: Iterable[str] = (),
    unit_range: Iterable[str] = (),
    row_count: bool = False,
) -> DataFrame:
    """All column checks of one table in one aggregation.

    ``nulls_except`` turns on the NULL check for every other column. NULL passes the value checks.
    """
    checks: list[tuple[str, str, str, str]] = []
    if row_count:
        checks.append(("row_count", "*", "count(1)", "info"))
    if nulls_except is not None:
        skipped = set(nulls_except)
        checks += [
            ("nulls", c, f"count_if({quoted(c)} IS NULL)", "warn")
            for c in df.columns
            if c not in skipped
        ]
    checks += [("negative", c, f"count_if({quoted(c)} < 0)", "warn") for c in non_negative]
    for c in unit_range:
        checks.append(("below_0", c, f"count_if({quoted(c)} < 0)", "warn"))
        checks.append(("above_1", c, f"count_if({quoted(c)} > 1)", "warn"))
    if not checks:
        raise ValueError("no checks requested")
    counts = df.selectExpr(*[f"{sql} AS count_{i}" for i, (_, _, sql, _) in enumerate(checks)])
    return _report_rows(
        counts,
        table,
        [(check, c, f"count_{i}", grade) for i, (check, c, _, grade) in enumerate(checks)],
    )


def check_nulls(df: DataFrame, name: str, exclude: Iterable[str] | None = None) -> DataFrame:
    """NULLs per column."""
    return profile(df, name, nulls_except=exclude or ())


def check_no_negative(df: DataFrame, cols: Iterable[str], name: str) -> DataFrame:
    """Negative values per column."""
    return profile(df, name, non_negative=cols)


def check_between_0_1(df: DataFrame, cols: Iterable[str], name: str) -> DataFrame:
    """Values below 0 and above 1 per column."""
    return profile(df, name, unit_range=cols)


def check_keys_unique(df: DataFrame, key: str | list[str], name: str) -> DataFrame:
    """Number of keys (not rows) that occur more than once; NULL counts as a key value."""
    keys = [key] if isinstance(key, str) else list(key)
    repeated = df.groupBy(*keys).agg(F.expr("count(1) AS uses")).filter("uses > 1")
    return _report_rows(
        repeated.selectExpr("count(1) AS keys"),
        name,
        [("duplicate_keys", ",".join(keys), "keys", "fail")],
    )


def keys_without_parent(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct child keys absent from the parent; a NULL child key is one of them.

    The child is reduced to distinct keys before the join. The parent is not: an anti join only
    looks for a match.
    """
    return child.select(key).distinct().join(parent.select(key), key, "left_anti")


def _missing_keys_report(
    child: DataFrame, parent: DataFrame, key: str, table: str, check: str, grade: str
) -> DataFrame:
    missing = keys_without_parent(child, parent, key).selectExpr("count(1) AS keys")
    return _report_rows(missing, table, [(check, key, "keys", grade)])


def check_fk(
    parent_df: DataFrame, child_df: DataFrame, key: str, parent_name: str, child_name: str
) -> DataFrame:
    """Referential integrity: child keys that the parent does not have."""
    return _missing_keys_report(
        child_df, parent_df, key, child_name, f"foreign_key_{parent_name}", "fail"
    )


Parent = tuple[DataFrame, str, str]


def check_dense_fks(child: DataFrame, parents: list[Parent], child_name: str) -> DataFrame:
    """``check_fk`` against several ``parents`` (frame, name, key) with one pass over the child.

    For integer keys without large gaps, such as numbered customers: keys are bits of longs that hold
    64 consecutive numbers each, combined in each task by a hash aggregation, so no rows are sorted and
    the shuffles carry a bit for a key however often it occurs. A child key without parent is a bit that
    the parent's long lacks. Sparse or random keys would take a long each; text and other keys have none
    at all: use ``check_fk`` for those.
    """
    for parent, _, key in parents:
        for frame in (child, parent):
            if not isinstance(frame.schema[key].dataType, IntegralType):
                raise ValueError(f"key {key} is not an integer")
    keys = sorted({key for _, _, key in parents})
    checks_of = " ".join(
        f"WHEN {text_literal(k)} THEN array({', '.join(str(i) for i, p in enumerate(parents) if p[2] == k)})"
        for k in keys
    )
    named = [(text_literal(k), f"CAST({quoted(k)} AS BIGINT)") for k in keys]
    children = _bitmaps(child.selectExpr(stacked(named, ("of", "key"))), "of").selectExpr(
        f"explode(CASE of {checks_of} END) AS check", "bucket", "bits", "false AS parent"
    )
    parts = [children]
    for i, (parent, _, key) in enumerate(parents):
        bits = _bitmaps(parent.selectExpr(f"{i} AS check", f"CAST({quoted(key)} AS BIGINT) AS key"), "check")
        parts.append(bits.selectExpr("check", "bucket", "bits", "true AS parent"))
    every = "bit_count(bit_or(bits))"
    known = "coalesce(bit_count(bit_or(CASE WHEN parent THEN bits END)), 0)"
    missing = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("check", "bucket")
        .agg(F.expr(f"CAST(CASE WHEN bucket IS NULL THEN CAST(bool_or(NOT parent) AS INT) ELSE {every} - {known} END AS BIGINT) AS keys"))
    )
    found = [F.expr(f"coalesce(sum(keys) FILTER (WHERE check = {i}), 0) AS keys_{i}") for i in range(len(parents))]
    rows = [(f"foreign_key_{name}", key, f"keys_{i}", "fail") for i, (_, name, key) in enumerate(parents)]
    return _report_rows(missing.agg(*found), child_name, rows)


def _bitmaps(keys: DataFrame, by: str) -> DataFrame:
    """64 bits of ``key`` per group and bucket; the bucket of NULL keys is NULL."""
    buckets = keys.selectExpr(by, "shiftright(key, 6) AS bucket", "shiftleft(1L, CAST(key & 63 AS INT)) AS bit")
    return buckets.groupBy(by, "bucket").agg(F.expr("bit_or(bit) AS bits"))


def check_eligible(features: DataFrame, eligible: DataFrame, name: str) -> DataFrame:
    """Customers of the feature table that are not active customers of the channel."""
    return _missing_keys_report(features, eligible, "customer_id", name, "not_eligible", "warn")


def check_in_sales(features: DataFrame, sales: DataFrame, name: str) -> DataFrame:
    """Customers of the feature table without a row in the sales summary."""
    return _missing_keys_report(features, sales, "customer_id", name, "not_in_sales", "warn")


def check_contract(df: DataFrame, contract: StructType, name: str) -> DataFrame:
    """Column names against the contract: a missing one fails, an extra one warns."""
    expected = contract.fieldNames()
    rows = [
        (name, "missing_column", c, 1, "fail") for c in expected if c not in df.columns
    ] + [(name, "extra_column", c, 1, "warn") for c in df.columns if c not in expected]
    if not rows:
        rows = [(name, "contract", "*", 0, "ok")]
    schema = "table string, check string, column string, violations bigint, status string"
    return df.sparkSession.createDataFrame(rows, schema)


def reconcile(features: DataFrame, sales: DataFrame) -> DataFrame:
    """Feature sales next to the sales summary for every customer, with their difference.

    ``difference`` compares with the line total, which defines the feature.
    """
    return features.join(sales, "customer_id").selectExpr(
        "customer_id",
        "CAST(ventas_total_3m AS DOUBLE) AS ventas_total_3m",
        "CAST(total_line_net_amount_3m AS DOUBLE) AS total_line_net_amount_3m",
        "CAST(total_order_net_amount_3m AS DOUBLE) AS total_order_net_amount_3m",
        "total_qty_units_3m",
        "frecuencia_pedidos_3m",
        "variedad_categorias_3m",
        "CAST(ventas_total_3m AS DOUBLE) - CAST(total_line_net_amount_3m AS DOUBLE) AS difference",
    )


def check_reconciled(features: DataFrame, sales: DataFrame, name: str) -> DataFrame:
    """Customers whose feature sales differ from the sales summary; one side NULL is a difference."""
    differs = "count_if(NOT (ventas_total_3m <=> total_line_net_amount_3m)) AS customers"
    counts = reconcile(features, sales).selectExpr(differs)
    return _report_rows(counts, name, [("sales_differ", "ventas_total_3m", "customers", "info")])


def check_rejects(rejects: DataFrame, columns: Iterable[str], table: str) -> DataFrame:
    """Values per column that typing could not keep, from the stored ``rejects`` of all tables."""
    checks = [
        ("rejects", c, f"count_if(column = {text_literal(c)})", "warn") for c in columns
    ]
    counts = rejects.where(F.col("table") == table).selectExpr(
        *[f"{count} AS count_{i}" for i, (_, _, count, _) in enumerate(checks)]
    )
    named = [(check, c, f"count_{i}", grade) for i, (check, c, _, grade) in enumerate(checks)]
    return _report_rows(counts, table, named)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table: (table, rows)."""
    counts = [
        df.selectExpr(f"{text_literal(name)} AS table", "count(1) AS rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


#: Limbs of a scaled value are below this; sums of their products stay exact for 5e11 rows.
_LIMB = 10_000_000
_LIMB_DIGITS = 7


class _ExactMoments:
    """SQL of the sample standard deviation of a fixed-point column, from exact whole-number sums.

    A value in units of its last decimal is cut into limbs of seven digits. The square of a value is
    a polynomial in the limb base; its coefficients are summed in two longs each, the limbs in one.
    From these n * sum(x^2) - sum(x)^2 follows exactly, coefficient by coefficient and carried to
    non-negative digits, so that nothing cancels in floating point. The only roundings are those of
    that whole number, of n (n - 1), of their quotient, its root and the scaling.
    """

    def __init__(self, i: int, column: str, digits: int, scale: int) -> None:
        self.i, self.scale = i, scale
        self.limbs = -(-digits // _LIMB_DIGITS)
        self.powers = 2 * self.limbs - 1
        unit = f"CAST({'1' + '0' * scale} AS DECIMAL({scale + 1}, 0))"
        whole = f"CAST({column} * {unit} AS DECIMAL({digits}, 0))" if scale else column
        base = f"{_LIMB}L"
        if digits <= 19:
            x = f"CAST({whole} AS BIGINT)"
            parts = [(x, k) for k in range(self.limbs)]
        else:  # two longs of 14 digits each
            split = f"CAST({10**14} AS DECIMAL(15, 0))"
            low = f"({whole} % {split})"
            high = f"CAST(CAST(({whole} - {low}) / {split} AS DECIMAL(38, 0)) AS BIGINT)"
            low = f"CAST({low} AS BIGINT)"
            parts = [(low, 0), (low, 1), (high, 0), (high, 1)][: self.limbs]
        last = [k == len(parts) - 1 or parts[k + 1][1] == 0 for k in range(len(parts))]
        self.cuts = []
        for k, (x, place) in enumerate(parts):
            limb = f"({x} div {_LIMB**place}L)" if place else x
            open_top = last[k] and digits <= 19
            self.cuts.append(f"{limb if open_top else f'({limb} % {base})'} AS l{i}_{k}")

    def sums(self) -> list[str]:
        """Aggregates over rows that carry the limbs."""
        i, out = self.i, []
        for k in range(self.limbs):
            out.append(f"sum(l{i}_{k}) AS t{i}_{k}")
        for power in range(self.powers):
            products = [
                f"l{i}_{a} * l{i}_{power - a}"
                for a in range(self.limbs)
                if 0 <= power - a < self.limbs
            ]
            q = f"({' + '.join(products)})"
            out.append(f"sum({q} div {_LIMB}L) AS high{i}_{power}")
            out.append(f"sum({q} % {_LIMB}L) AS low{i}_{power}")
        return out

    def coefficients(self) -> list[str]:
        """Of n * sum(x^2) - sum(x)^2, by power of the limb base."""
        i, out = self.i, []
        for power in range(self.powers):
            squares = " + ".join(
                f"{_wide(f't{i}_{a}')} * {_wide(f't{i}_{power - a}')}"
                for a in range(self.limbs)
                if 0 <= power - a < self.limbs
            )
            both = f"({_wide(f'high{i}_{power}')} * {_LIMB} + {_wide(f'low{i}_{power}')})"
            out.append(f"CAST({_wide(f'count_{i}')} * {both} - ({squares}) AS DECIMAL(38, 0)) AS c{i}_{power}")
        return out

    def carried(self, power: int) -> list[str]:
        """The digit of a power, and the next coefficient with what is carried to it."""
        i = self.i
        digit = f"pmod(c{i}_{power}, CAST({_LIMB} AS DECIMAL(8, 0)))"
        over = f"CAST((c{i}_{power} - {digit}) / {_LIMB} AS DECIMAL(38, 0))"
        return [
            f"CAST({digit} AS BIGINT) AS d{i}_{power}",
            f"CAST(c{i}_{power + 1} + {over} AS DECIMAL(38, 0)) AS c{i}_{power + 1}",
        ]

    def deviation(self) -> str:
        i, top = self.i, self.powers - 1
        exact = f"c{i}_{top}"
        rough = f"CAST(c{i}_{top} AS DOUBLE)"
        for power in range(top - 1, -1, -1):
            exact = f"try_add(try_multiply({exact}, {_wide(str(_LIMB))}), {_wide(f'd{i}_{power}')})"
            rough = f"({rough} * {_LIMB}D + d{i}_{power})"
        n = f"CAST({_wide(f'count_{i}')} * ({_wide(f'count_{i}')} - 1) AS DOUBLE)"
        spread = f"coalesce(CAST({exact} AS DOUBLE), {rough})"
        return f"CASE WHEN count_{i} > 1 THEN sqrt({spread} / {n}) / {10**self.scale}D END"


def _wide(sql: str) -> str:
    return f"CAST({sql} AS DECIMAL(38, 0))"


def _exact_moments(i: int, name: str, kind: DataType) -> _ExactMoments | None:
    """None for floating point and for decimals of more than 28 digits."""
    if isinstance(kind, IntegralType):
        return _ExactMoments(i, f"CAST({quoted(name)} AS BIGINT)", 19, 0)
    if isinstance(kind, DecimalType) and kind.precision <= 28:
        return _ExactMoments(i, quoted(name), kind.precision, kind.scale)
    return None


def numeric_summary(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per column, in one pass.

    The typed form of ``df.describe(cols)``: (column, count, mean, stddev, min, max). The mean is the
    exact total divided once and the deviation comes from exact sums, so that neither depends on the
    order of the rows. Floating-point columns and decimals of more than 28 digits take Spark's own
    merged moments.
    """
    cols = list(cols)
    cuts, measures, rows = [], [], []
    exact: list[_ExactMoments] = []
    for i, name in enumerate(cols):
        kind, c = df.schema[name].dataType, f"v{i}"
        moments = _exact_moments(i, name, kind)
        cuts.append(f"{quoted(name)} AS {c}")
        total = f"CAST({c} AS DECIMAL(19, 0))" if isinstance(kind, IntegralType) else c
        measures += [
            f"count({c}) AS count_{i}",
            f"CAST(sum({total}) AS DOUBLE) AS total_{i}",
            f"CAST(min({c}) AS DOUBLE) AS min_{i}",
            f"CAST(max({c}) AS DOUBLE) AS max_{i}",
        ]
        if moments is None:
            measures.append(f"CAST(stddev_samp({c}) AS DOUBLE) AS stddev_{i}")
            deviation = f"stddev_{i}"
        else:
            exact.append(moments)
            cuts += moments.cuts
            measures += moments.sums()
            deviation = moments.deviation()
        mean = guarded_ratio(f"total_{i}", f"count_{i}")
        rows.append((text_literal(name), f"count_{i}", mean, deviation, f"min_{i}", f"max_{i}"))
    summed = df.selectExpr(*cuts).selectExpr(*measures)
    summed = summed.selectExpr("*", *[sql for m in exact for sql in m.coefficients()])
    for power in range(max((m.powers for m in exact), default=1) - 1):
        carried = [sql for m in exact if power < m.powers - 1 for sql in m.carried(power)]
        replaced = {sql.rsplit(" AS ", 1)[1] for sql in carried}
        kept = [c for c in summed.columns if c not in replaced]
        summed = summed.selectExpr(*kept, *carried)
    labels = ("column", "count", "mean", "stddev", "min", "max")
    return summed.selectExpr(stacked(rows, labels))


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """The first rows by key."""
    return df.orderBy(key).limit(rows)


def fact_key_checks(fact: DataFrame, orders_detail: DataFrame) -> DataFrame:
    """Key uniqueness of the fact next to the raw detail it comes from."""
    key = ["order_id", "line_id"]
    return check_keys_unique(fact, key, "fact_order_line").unionByName(
        check_keys_unique(orders_detail, key, "orders_detail")
    )


def features_contract(df: DataFrame) -> DataFrame:
    return check_contract(df, contracts.DIM_FEATURES, "dim_features")
