"""Values that a contract type cannot hold: widened, or kept as rejects, never changed unnoticed."""

import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from stratamart import __main__ as command
from stratamart import contracts
from stratamart.functions import typing
from stratamart.functions.columns import standard_names
from stratamart.functions.typing import apply_contract, measured_types, reject_counts
from stratamart.operators.dedup import keep_one_per_key
from stratamart.plans.medallion import run_medallion
from stratamart.plans.quality import run_quality_report
from stratamart.session import scratch_dir, tuned
from stratamart.sources.tables import read_fact, read_table

HEADER = "order_id,customer_id,order_date,order_net_amount,tipo_pago\n"
DETAIL = "order_id,line_id,product_id,qty_units,line_net_amount,promo_flag,product_category\n"


def raw(tmp_path, customers, headers, details):
    folder = tmp_path / "raw"
    folder.mkdir(parents=True)
    (folder / "customers_1.csv").write_text(
        "customer_id,customer_name,canal,estado\n" + customers
    )
    (folder / "products_1.csv").write_text(
        "product_id,product_name,product_category,brand\n1,p,bebidas,b\n"
    )
    (folder / "orders_header_1.csv").write_text(HEADER + headers)
    (folder / "orders_detail_1.csv").write_text(DETAIL + details)
    return str(tmp_path)


def text_schemas():
    return {name: contracts.as_text(kind) for name, kind in contracts.BRONZE.items()}


def features(spark, base):
    return {
        r["customer_id"]: r["ventas_total_3m"]
        for r in read_table(spark, f"{base}/gold/dim_features").collect()
    }


@pytest.mark.parametrize("schemas", [{}, text_schemas()], ids=["inferred", "text"])
def test_fractional_units_stay(spark, tmp_path, schemas):
    base = raw(
        tmp_path,
        "1,a,tradicional,activo\n",
        "1,1,2024-01-01,5.00,contado\n",
        "1,1,1,0.5,10.5,0,bebidas\n1,2,1,2.5,1.5,0,bebidas\n",
    )
    run_medallion(spark, base, schemas)
    units = read_fact(spark, f"{base}/silver/fact_order_line").select("qty_units").collect()
    assert sorted(float(r[0]) for r in units) == [0.5, 2.5]
    assert list(features(spark, base).values()) == [12.0]
    assert read_table(spark, f"{base}/silver/rejects").count() == 0


@pytest.mark.parametrize("schemas", [{}, text_schemas()], ids=["inferred", "text"])
def test_text_keys_stay(spark, tmp_path, schemas):
    base = raw(
        tmp_path,
        "C1,a,tradicional,activo\nC2,b,tradicional,activo\n",
        "1,C1,2024-01-01,5.00,contado\n2,C2,2024-01-02,6.00,contado\n",
        "1,1,1,1,10.5,0,bebidas\n2,1,1,1,3.5,0,bebidas\n",
    )
    run_medallion(spark, base, schemas)
    assert read_table(spark, f"{base}/silver/dim_customer").count() == 2
    assert features(spark, base) == {"C1": 10.5, "C2": 3.5}


@pytest.mark.parametrize("schemas", [{}, text_schemas()], ids=["inferred", "text"])
def test_no_number_is_lost(spark, tmp_path, schemas):
    """Noise of floating point in a header amount and a quantity costs neither order nor line."""
    base = raw(
        tmp_path,
        "1,a,tradicional,activo\n",
        "1,1,2024-01-01,5.00,contado\n2,1,2024-01-02,100.30000000000001,contado\n",
        "1,1,1,0.30000000000000004,30,0,bebidas\n2,1,1,1,120.8,0,bebidas\n",
    )
    run_medallion(spark, base, schemas)
    rows = read_table(spark, f"{base}/gold/dim_features").collect()
    assert [(float(r["ventas_total_3m"]), r["frecuencia_pedidos_3m"]) for r in rows] == [(150.8, 2)]
    fact = read_fact(spark, f"{base}/silver/fact_order_line").collect()
    assert sorted(float(r["qty_units"]) for r in fact) == [0.30000000000000004, 1.0]
    assert sorted(float(r["order_net_amount"]) for r in fact) == [5.0, 100.30000000000001]
    assert read_table(spark, f"{base}/silver/rejects").count() == 0


@pytest.mark.parametrize(
    ("numbers", "kind"),
    [
        (["1.50", "007", None, " -3.1 "], "decimal(18,4)"),
        (["1.00000000000001", "123456.5"], "decimal(20,14)"),
        (["12345678901234567890", "1"], "decimal(20,0)"),
        (["1e19", "2.5E-3"], "decimal(24,4)"),
        (["1e30", "0.5"], "double"),
        (["1e-25", "123456.5"], "double"),
        ([".5", "5.", "+1"], "decimal(18,4)"),
        ([None, ""], "decimal(18,4)"),
    ],
)
@pytest.mark.parametrize("source", ["string", "double"])
def test_measured_types_hold_every_number(spark, numbers, kind, source):
    contract = StructType([contracts.ORDERS_DETAIL["line_net_amount"]])
    name = contract[0].name
    rows = spark.createDataFrame([(x,) for x in numbers], f"{name} string")
    raw_rows = rows.selectExpr(f"try_cast({name} AS {source}) AS {name}")
    if source == "string" or "12345678901234567890" not in numbers:  # one double is 1.2345678901234567E19
        assert measured_types(raw_rows, contract)[name].simpleString() == kind
    typed = [r[0] for r in apply_contract(raw_rows, contract).collect()]
    expected = [float(x) if x else None for x in numbers]
    assert [None if x is None else float(x) for x in typed] == expected
    assert reject_counts(raw_rows, contract).collect()[0]["rejects"] == numbers.count("")* (source == "string")


def test_only_what_is_no_number_is_a_reject(spark, tmp_path):
    base = raw(
        tmp_path,
        "1,a,tradicional,activo\n",
        "1,1,2024-01-01,5.00,contado\n",
        "1,1,1,1,10.123456,0,bebidas\n1,2,1,1,n/a,0,bebidas\n1,3,1,1,NaN,0,bebidas\n",
    )
    run_medallion(spark, base, text_schemas())
    assert list(features(spark, base).values()) == [10.123456]
    rejects = read_table(spark, f"{base}/silver/rejects").collect()
    assert sorted((r["table"], r["column"], r["value"]) for r in rejects) == [
        ("orders_detail", "line_net_amount", "NaN"),
        ("orders_detail", "line_net_amount", "n/a"),
    ]
    report = run_quality_report(spark, base).where("check = 'rejects' and violations > 0")
    assert [(r["column"], r["violations"], r["status"]) for r in report.collect()] == [
        ("line_net_amount", 2, "warn")
    ]


def test_types_that_fit_cost_no_pass(spark):
    rows = spark.createDataFrame([], contracts.ORDERS_HEADER)
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    assert measured_types(rows, contracts.ORDERS_HEADER) == {
        f.name: f.dataType for f in contracts.ORDERS_HEADER
    }
    assert len(jobs.getJobIdsForGroup(None)) == before


def test_typed_load_stops_at_a_finer_amount(spark, tmp_path):
    base = raw(tmp_path, "1,a,b,c\n", "1,1,2024-01-01,5.00,x\n", "1,1,1,1,10.123456,0,b\n")
    with pytest.raises(Exception, match="line_net_amount cannot hold the value 10.123456"):
        run_medallion(spark, base)


def test_further_columns_reach_gold(spark, tmp_path):
    base = raw(tmp_path, "", "1,1,2024-01-01,5.00,contado\n", "1,1,1,1,10.5,0,bebidas\n")
    (tmp_path / "raw" / "customers_1.csv").write_text(
        "customer_id,customer_name,canal,estado,Región\n1,a,tradicional,activo,norte\n"
    )
    run_medallion(spark, base)
    rows = read_table(spark, f"{base}/gold/gold_sales_customer_3m").collect()
    assert [(r["customer_id"], r["region"]) for r in rows] == [(1, "norte")]


def test_other_column_order_in_one_file(spark, tmp_path):
    base = raw(tmp_path, "1,a,b,c\n", "1,1,2024-01-01,5.00,x\n", "1,1,1,1,1.5,0,b\n")
    (tmp_path / "raw" / "customers_2.csv").write_text(
        "customer_name,customer_id,canal,estado\nb,2,c,d\n"
    )
    run_medallion(spark, base)
    people = read_table(spark, f"{base}/silver/dim_customer").select("customer_id", "customer_name")
    assert sorted(map(tuple, people.collect())) == [(1, "a"), (2, "b")]


def test_accents_in_names():
    assert standard_names(["Código", "Año", " ñandú-1 "]) == ["codigo", "ano", "nandu_1"]
    with pytest.raises(ValueError, match="without letters"):
        standard_names(["--"])


def test_rows_that_differ_in_a_nested_map_only(spark):
    rows = spark.range(2).select(
        F.lit(1).alias("k"), F.array(F.create_map(F.lit("a"), F.col("id"))).alias("m")
    )
    kept = [keep_one_per_key(d, ["k"]).collect() for d in (rows, rows.orderBy(F.desc("id")))]
    assert kept[0] == kept[1]
    assert kept[0][0]["m"] == [{"a": 0}]


def test_no_shared_folder_is_refused():
    class Conf:
        def get(self, name, default):
            return default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")


def test_stages_leave_the_settings_as_they_were(spark):
    name = "spark.sql.requireAllClusterKeysForDistribution"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        with tuned(spark):
            assert spark.conf.get(name) == "true"
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.set(name, before)


def test_command_line_builds_and_keeps_the_report(spark, tmp_path, monkeypatch, capsys):
    base = raw(
        tmp_path,
        "1,a,tradicional,activo\n",
        "1,1,2024-01-01,5.00,contado\n",
        "1,1,1,one,10.5,0,bebidas\n",
    )
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    for action in (["build", base], ["report", base]):
        monkeypatch.setattr(sys, "argv", ["stratamart", *action])
        command.main()
    report = read_table(spark, f"{base}/quality/report")
    found = {(r["table"], r["check"], r["column"]): r["violations"] for r in report.collect()}
    assert found["orders_detail", "rejects", "qty_units"] == 1
    assert capsys.readouterr().out.count("rejects") >= 10


ODD_NUMBERS = ["5", "+5", "-5", "-0", "007", " 7 ", "1e2", "1.50", "1.5000", ".5", "5.", "0.12345", "x", "", "1d", "NaN",
               "9223372036854775807", "9223372036854775808", "123456789012345678.1234", None]


@pytest.mark.parametrize("kind", [T.LongType(), T.DecimalType(18, 4)])
def test_texts_as_spark_writes_them_are_read_as_all_others(spark, kind):
    """One cast for usual texts must give what the pattern and the exact casts give."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(ODD_NUMBERS)], "i int, v string")
    contract = T.StructType([T.StructField("v", kind)])
    direct = {r.i: r.v for r in apply_contract(rows, contract, types={"v": kind}).collect()}
    typed, exact = typing._cast(contract["v"], T.StringType(), kind)
    plain = {r.i: r.v for r in rows.selectExpr("i", f"CASE WHEN {exact} THEN {typed} END AS v").collect()}
    assert direct == plain
    assert direct[0] == 5 and direct[ODD_NUMBERS.index("x")] is None
