import pytest

from conftest import TESTDATA, values
from stratamart import contracts, run_medallion, run_quality_report
from stratamart.functions.columns import standardise_columns
from stratamart.plans.bronze import bronze_scan, ingest
from stratamart.plans.silver import silver_input, silver_source
from stratamart.sources.csv_extracts import read_csv_glob, write_csv_extracts
from stratamart.sources.star_schema import BUSINESS_KEYS, SOURCES
from stratamart.sources.tables import read_fact, read_table, table_path, write_compacted

GOOD = "customer_id,customer_name,canal,estado\n1,Ana,tradicional,activo\n"
MORE = "customer_id,customer_name,canal,estado\n2,,moderno,\n"


@pytest.fixture
def base(tmp_path):
    (tmp_path / "raw").mkdir()
    return tmp_path


def test_many_files_are_one_table_with_lineage(spark, base):
    (base / "raw" / "customers_1.csv").write_text(GOOD)
    (base / "raw" / "customers_2.csv").write_text(MORE)
    (base / "raw" / "other.csv").write_text("x\n1\n")
    ingest(spark, str(base), "customers", contracts.CUSTOMERS)
    stored = read_table(spark, table_path(str(base), "bronze", "customers"))
    assert values(stored, *contracts.CUSTOMERS.fieldNames()) == [
        (1, "Ana", "tradicional", "activo"),
        (2, None, "moderno", None),
    ]
    rows = stored.collect()
    assert len({r.ingestion_timestamp for r in rows}) == 1
    assert {r.source_file.rsplit("/", 1)[1] for r in rows} == {"customers_1.csv", "customers_2.csv"}


def test_header_in_another_order_is_refused_by_a_plain_read(spark, base):
    (base / "raw" / "customers_1.csv").write_text(GOOD)
    (base / "raw" / "customers_2.csv").write_text("customer_name,customer_id,canal,estado\nB,2,x,y\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_glob(spark, str(base / "raw" / "customers*.csv"), contracts.CUSTOMERS).collect()


@pytest.mark.parametrize("schema", [contracts.CUSTOMERS, None], ids=["typed", "inferred"])
def test_headers_in_another_order_and_with_other_columns(spark, base, schema):
    (base / "raw" / "customers_1.csv").write_text(GOOD)
    (base / "raw" / "customers_2.csv").write_text("customer_name,Customer ID,canal,estado\nB,2,x,y\n")
    (base / "raw" / "customers_3.csv").write_text("")
    (base / "raw" / "customers_4 a.csv").write_text("estado,Región,customer_id\nz,norte,3\n")
    rows = bronze_scan(spark, str(base), "customers", schema)
    assert values(rows, "customer_id", "customer_name", "estado", "region") == [
        (1, "Ana", "activo", None),
        (2, "B", "y", None),
        (3, None, "z", "norte"),
    ]
    files = {r["customer_id"]: r["source_file"].rsplit("/", 1)[1] for r in rows.collect()}
    assert files == {1: "customers_1.csv", 2: "customers_2.csv", 3: "customers_4%20a.csv"}


def test_mixed_headers_without_a_column_of_the_contract(spark, base):
    for n, header in enumerate(["customer_id,canal", "canal,customer_id"]):
        (base / "raw" / f"customers_{n}.csv").write_text(f"{header}\n1,1\n")
    with pytest.raises(ValueError, match="missing.*customer_name"):
        bronze_scan(spark, str(base), "customers", contracts.CUSTOMERS)


def test_column_with_numbers_in_one_group_only(spark, base):
    (base / "raw" / "customers_1.csv").write_text("customer_id,canal\n007,a\n")
    (base / "raw" / "customers_2.csv").write_text("canal,customer_id\nb,C8\n")
    assert values(bronze_scan(spark, str(base), "customers"), "customer_id") == [("007",), ("C8",)]


def test_missing_files_are_refused(spark, base):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        bronze_scan(spark, str(base), "customers", contracts.CUSTOMERS)


def test_bad_value_stops_a_typed_load_and_passes_a_text_load(spark, base):
    (base / "raw" / "customers_1.csv").write_text(GOOD + "x,Bo,moderno,activo\n")
    with pytest.raises(Exception, match="customer_id cannot hold the value x"):
        bronze_scan(spark, str(base), "customers", contracts.CUSTOMERS).collect()
    text = bronze_scan(spark, str(base), "customers", contracts.as_text(contracts.CUSTOMERS))
    assert values(text, "customer_id") == [("1",), ("x",)]


def test_inferred_types(spark, base):
    (base / "raw" / "customers_1.csv").write_text(GOOD)
    inferred = read_csv_glob(spark, str(base / "raw" / "customers*.csv"))
    assert dict(inferred.dtypes)["customer_id"] == "int"


def test_untidy_names(spark):
    frame = spark.createDataFrame([(1, 2)], "` Customer ID ` int, `Net-Amount ($)` int")
    assert standardise_columns(frame).columns == ["customer_id", "net_amount"]
    with pytest.raises(ValueError, match="same standardised name"):
        standardise_columns(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_small_gold_table_is_one_file(spark, tmp_path):
    path = str(tmp_path / "gold")
    write_compacted(spark.range(0, 5000, 1, 16), path)
    assert len(list((tmp_path / "gold").glob("*.parquet"))) == 1
    assert read_table(spark, path).count() == 5000


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base_dir = str(tmp_path_factory.mktemp("layers"))
    for table, source in SOURCES.items():
        write_csv_extracts(source(spark, TESTDATA), f"{base_dir}/raw", table, BUSINESS_KEYS[table][0])
    run_medallion(spark, base_dir)
    return base_dir


def test_rerun_gives_the_same_tables(spark, built):
    tables = [("silver", "dim_date"), ("gold", "gold_sales_customer_3m"), ("gold", "dim_features")]

    def snapshot():
        return [
            values(df.select([c for c in df.columns if c not in contracts.METADATA_COLUMNS]))
            for df in (read_table(spark, table_path(built, *t)) for t in tables)
        ]

    before = snapshot()
    run_medallion(spark, built)
    assert snapshot() == before


def test_fact_hides_its_partition_column_and_wins_shared_columns(spark, built):
    fact = read_fact(spark, table_path(built, "silver", "fact_order_line"))
    assert contracts.FACT_PARTITION not in fact.columns
    assert fact.columns.count(contracts.INGESTION_TIMESTAMP) == 1
    assert fact.filter("source_file NOT LIKE '%orders_header%'").count() == 0


def test_invariants_of_the_feature_table(spark, built):
    table = read_table(spark, table_path(built, "gold", "dim_features"))
    assert table.columns == contracts.DIM_FEATURES.fieldNames()
    assert [f.dataType for f in table.schema] == [f.dataType for f in contracts.DIM_FEATURES]
    assert table.count() == 21
    broken = table.filter(
        "frecuencia_pedidos_3m < 1 OR (dias_promedio_entre_pedidos IS NULL) <> (frecuencia_pedidos_3m = 1)"
        " OR porcentaje_pedidos_promo_3m NOT BETWEEN 0 AND 1 OR mix_credito_vs_contado_3m NOT BETWEEN 0 AND 1"
    )
    assert broken.count() == 0


def test_report_of_healthy_layers(spark, built):
    rows = run_quality_report(spark, built).collect()
    failed = {(r.table, r.check, r.column, r.violations) for r in rows if r.status == "fail"}
    # Orders without lines have no product: the NULL key is the one finding.
    assert failed == {("fact_order_line", "foreign_key_dim_product", "product_id", 1)}
    warned = {(r.table, r.column) for r in rows if r.status == "warn"}
    assert {table for table, _ in warned} == {"fact_order_line"}


def test_inferred_types_give_the_same_features(spark, built, tmp_path):
    base_dir = str(tmp_path)
    for table, source in SOURCES.items():
        write_csv_extracts(source(spark, TESTDATA), f"{base_dir}/raw", table, BUSINESS_KEYS[table][0])
    run_medallion(spark, base_dir, schemas={})
    stored = read_table(spark, table_path(base_dir, "bronze", "orders_detail"))
    assert dict(stored.dtypes)["line_net_amount"] == "double"
    inferred, typed = (
        values(read_table(spark, table_path(d, "gold", "dim_features"))) for d in (base_dir, built)
    )
    assert inferred == typed


def test_other_and_missing_descriptive_columns(spark, base):
    (base / "raw" / "customers_1.csv").write_text("customer_id,estado,region,canal\n1,activo,sur,moderno\n")
    ingest(spark, str(base), "customers")
    assert values(silver_input(silver_source(spark, str(base), "customers")).drop(*contracts.METADATA_COLUMNS)) == [
        (1, "activo", "sur", "moderno")
    ]
