from decimal import Decimal, localcontext
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import values
from stratamart import contracts
from stratamart.operators import checks


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(
        [(1, -1.0, 0.5), (1, None, 1.5), (2, 2.0, -0.1), (None, None, None), (None, 3.0, 1.0)],
        "id int, `net amount` double, share double",
    )


def report(df, *columns):
    assert tuple(df.columns) == checks.REPORT_COLUMNS
    assert df.schema["violations"].dataType.simpleString() == "bigint"
    return values(df, *(columns or ("check", "column", "violations", "status")))


def test_nulls(sample):
    assert report(checks.check_nulls(sample, "t", exclude=["share"])) == [
        ("nulls", "id", 2, "warn"),
        ("nulls", "net amount", 2, "warn"),
    ]


def test_negative_values_and_null_passes(sample):
    assert report(checks.check_no_negative(sample, ["net amount", "id"], "t")) == [
        ("negative", "id", 0, "ok"),
        ("negative", "net amount", 1, "warn"),
    ]


def test_unit_range(sample):
    assert report(checks.check_between_0_1(sample, ["share"], "t")) == [
        ("above_1", "share", 1, "warn"),
        ("below_0", "share", 1, "warn"),
    ]


def test_duplicate_keys_counts_keys_and_null_is_a_value(sample):
    assert report(checks.check_keys_unique(sample, "id", "t")) == [("duplicate_keys", "id", 2, "fail")]
    assert report(checks.check_keys_unique(sample, ["id", "share"], "t"))[0][2:] == (0, "ok")


def test_foreign_key_counts_distinct_keys_and_one_null(spark, sample):
    parent = spark.createDataFrame([(2,), (2,), (None,)], "id int")
    assert report(checks.check_fk(parent, sample, "id", "p", "t")) == [
        ("foreign_key_p", "id", 2, "fail")
    ]
    whole = spark.createDataFrame([(1,), (2,)], "id int")
    assert report(checks.check_fk(whole, sample.filter("id > 0"), "id", "p", "t"))[0][3] == "ok"


@pytest.mark.parametrize("nulls", [True, False])
def test_foreign_keys_by_bitmaps_equal_anti_joins(spark, nulls):
    """Negative, zero and far apart keys, keys at the edges of bitmaps, NULL on either side."""
    numbers = [-98304, -32769, -32768, -32767, -1, 0, 1, 2, 32767, 32768, 32769, 65536, 65537, 10**12, -(10**12)]
    child = [(x, y) for i, x in enumerate(numbers) for y in numbers[: i + 1]] * 3 + [(None, 5)] * (2 * nulls)
    child = spark.createDataFrame(child, "a bigint, b bigint")
    some = spark.createDataFrame([(x,) for x in numbers[::2]], "a bigint")
    with_null = some.union(spark.createDataFrame([(None,)], "a bigint"))
    nothing = some.limit(0)
    others = spark.createDataFrame([(x, 1) for x in numbers[::3] + [7]], "b bigint, extra int")
    parents = [(some, "some", "a"), (with_null, "null", "a"), (nothing, "none", "a"), (others, "others", "b")]
    got = checks.check_dense_fks(child, parents, "child")
    expected = [checks.check_fk(parent, child, key, name, "child") for parent, name, key in parents]
    assert got.columns == expected[0].columns
    assert values(got) == sorted(r for e in expected for r in values(e))
    empty = checks.check_dense_fks(child.limit(0), parents, "child").collect()
    assert [(r["violations"], r["status"]) for r in empty] == [(0, "ok")] * 4
    with pytest.raises(ValueError, match="not an integer"):
        checks.check_dense_fks(child.selectExpr("CAST(a AS STRING) AS a"), parents[:1], "child")


def test_foreign_keys_sort_no_rows(spark):
    """A sort of the child's keys takes memory of a task in proportion to its rows."""
    child = spark.range(1000).selectExpr("id AS a", "id % 70 AS b")
    parents = [(child.select("a"), "p", "a"), (child.select("b"), "q", "b")]
    found = checks.check_dense_fks(child, parents, "child")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan
    assert "Sort" not in plan


def test_contract(spark):
    names = contracts.DIM_FEATURES.fieldNames()
    frame = spark.createDataFrame([], contracts.DIM_FEATURES)
    assert report(checks.features_contract(frame)) == [("contract", "*", 0, "ok")]
    changed = frame.withColumnRenamed(names[1], "surprise")
    assert report(checks.features_contract(changed)) == [
        ("extra_column", "surprise", 1, "warn"),
        ("missing_column", names[1], 1, "fail"),
    ]


def test_numeric_summary_matches_describe(sample):
    typed = {r["column"]: r for r in checks.numeric_summary(sample, ["net amount", "share"]).collect()}
    described = {r["summary"]: r for r in sample.describe("net amount", "share").collect()}
    for name, row in typed.items():
        assert row["count"] == int(described["count"][name])
        for label in ("mean", "stddev", "min", "max"):
            assert row[label] == pytest.approx(float(described[label][name]))


def textbook(numbers):
    """Mean and sample deviation from rationals, rounded once."""
    exact = [Fraction(x) for x in numbers]
    mean = sum(exact) / len(exact)
    if len(exact) < 2:
        return float(mean), None
    variance = sum((x - mean) ** 2 for x in exact) / (len(exact) - 1)
    with localcontext(prec=60):
        root = (Decimal(variance.numerator) / Decimal(variance.denominator)).sqrt()
    return float(mean), float(root)


@pytest.mark.parametrize(
    ("kind", "numbers"),
    [
        ("bigint", ["1", "1", "2"]),
        ("decimal(18,4)", ["0.0001", "0.0002"]),
        ("decimal(18,2)", ["1000000000000000.01", "1000000000000000.02", "1000000000000000.04"]),
        ("decimal(18,2)", ["-9999999999999999.99", "9999999999999999.99", "0.01"]),
        ("bigint", ["9223372036854775807", "9223372036854775806", "9223372036854775800"]),
        ("bigint", ["-9223372036854775807", "9223372036854775807", "3"]),
        ("int", ["9999999", "10000000", "9999999", "10000000"]),
        ("decimal(28,14)", ["12345678901234.12345678901234", "12345678901234.12345678901235"]),
        ("decimal(28,14)", ["-99999999999999.99999999999999", "99999999999999.5", "0.00000000000001"]),
        ("decimal(21,3)", ["-123456789012345678.123", "7.5", "123456789012345678.999"]),
        ("decimal(18,4)", ["7.5"] * 5),
        ("decimal(18,4)", ["7.5"]),
        ("double", ["1", "1", "2"]),
        ("decimal(38,10)", ["1", "1", "2"]),
    ],
)
def test_numeric_summary_is_the_textbook_value(spark, kind, numbers):
    rows = spark.createDataFrame([(x,) for x in [*numbers, None]], "v string")
    row = checks.numeric_summary(rows.selectExpr(f"CAST(v AS {kind}) AS v"), ["v"]).collect()[0]
    mean, deviation = textbook(numbers)
    assert row["count"] == len(numbers)
    assert row["mean"] == pytest.approx(mean, rel=1e-15)
    if deviation is None:
        assert row["stddev"] is None
    else:
        assert row["stddev"] == pytest.approx(deviation, rel=4e-16, abs=0)


def test_numeric_summary_does_not_depend_on_order(spark):
    rows = spark.range(2000).selectExpr(
        "id", "CAST((id * 7919 % 100003) * 1234567.8912 AS DECIMAL(18, 4)) AS v"
    )
    found = {
        tuple(checks.numeric_summary(df, ["v"]).collect()[0])
        for df in (rows, rows.orderBy(F.desc("id")), rows.repartition(7, "v"))
    }
    assert len(found) == 1


def test_numeric_summary_of_nothing(sample):
    row = checks.numeric_summary(sample.limit(0), ["share"]).collect()[0]
    assert tuple(row) == ("share", 0, None, None, None, None)


def test_preview_is_ordered(spark):
    assert [r.id for r in checks.preview(spark.range(20, 0, -1), "id").collect()] == [1, 2, 3, 4, 5]


def test_reconcile_reports_differences(spark):
    features = spark.createDataFrame(
        [(1, 5.0, 1, 1), (2, 6.0, 1, 1), (3, None, 1, 1)],
        "customer_id int, ventas_total_3m double, frecuencia_pedidos_3m int, variedad_categorias_3m int",
    )
    sales = spark.createDataFrame(
        [(1, 5.0, 9.0, 1), (2, 7.0, 9.0, 1), (3, None, 9.0, 1)],
        "customer_id int, total_line_net_amount_3m double, total_order_net_amount_3m double, total_qty_units_3m int",
    )
    assert values(checks.reconcile(features, sales), "customer_id", "difference") == [
        (1, 0.0),
        (2, -1.0),
        (3, None),
    ]
    assert report(checks.check_reconciled(features, sales, "t"))[0][2] == 1


def test_no_checks_is_an_error(sample):
    with pytest.raises(ValueError):
        checks.profile(sample, "t")
