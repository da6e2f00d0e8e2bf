"""CSV extracts: many files matched by one glob, read as one table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructField, StructType

from stratamart.contracts import INGESTION_TIMESTAMP, SOURCE_FILE
from stratamart.functions.columns import standard_names
from stratamart.functions.typing import apply_contract

#: Headers that are read at once, each by a task that reads the first lines of its file only.
HEADERS_AT_ONCE = 16

Headers = dict[tuple[str, ...], list[str]]


def read_csv_glob(
    spark: SparkSession,
    pattern: str | list[str],
    schema: StructType | None = None,
    mode: str = "FAILFAST",
    mixed_headers: bool = False,
    metadata: bool = False,
) -> DataFrame:
    """Read every CSV file matching ``pattern``; each has a header row.

    With a schema the extracts are read once, as text; the schema's columns, found by name, get its
    types, and all others stay text. A value that its type cannot hold exactly stops the load. To
    accept such values, read with ``contracts.as_text(schema)`` and type the rows with
    ``apply_contract``. Without a schema the types are inferred, which costs one more pass.

    CSV columns are positional, so each file's header is compared with that of the first file; a
    file with another column order or another number of columns stops the load. With
    ``mixed_headers`` the header of every file is read first and files with the same one are scanned
    together; the scans are united by standardised name, and a column that some files lack is NULL
    there. ``metadata`` adds ``with_ingest_metadata``.
    """
    if mixed_headers:
        groups = header_groups(spark, extract_files(spark, pattern))
        if len(groups) > 1:
            return _united(spark, groups, schema, mode, metadata, pattern)
    names = spark.read.option("header", True).csv(pattern).columns  # from the header of one file
    return _scan(spark, pattern, names, schema, mode, metadata)


def extract_files(spark: SparkSession, pattern: str | list[str]) -> list[str]:
    """The files a pattern matches, as Spark lists them; no file is read."""
    return [unquote(name) for name in spark.read.text(pattern).inputFiles()]


def header_groups(spark: SparkSession, files: list[str]) -> Headers:
    """Files by their header, in order of their names; files without any line are left out."""

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.option("header", True).csv(file).columns)

    groups: Headers = {}
    files = sorted(files)
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for file, names in zip(files, pool.map(header, files), strict=True):
            if names:
                groups.setdefault(names, []).append(file)
    return groups


def _scan(
    spark: SparkSession,
    files: str | list[str],
    names: list[str],
    schema: StructType | None,
    mode: str,
    metadata: bool,
) -> DataFrame:
    """Files of one header."""
    reader = spark.read.option("header", True)
    if schema is None:
        scan = reader.option("inferSchema", True).csv(files)
        return with_ingest_metadata(scan) if metadata else scan
    text = StructType([StructField(name, StringType()) for name in names])
    reader = reader.schema(text).option("enforceSchema", False).option("mode", mode)
    tidy = standard_names(names)
    own = _columns_of(schema, tidy, files)
    rows = apply_contract(reader.csv(files).toDF(*tidy), own, strict=True)
    return with_ingest_metadata(rows) if metadata else rows


def _columns_of(schema: StructType, names: list[str], files: object) -> StructType:
    own = [field for field in schema if field.name in names]
    missing = [field.name for field in schema if field not in own]
    if missing:
        raise ValueError(f"columns missing from {files}: {missing}")
    return StructType(own)


def _united(
    spark: SparkSession,
    groups: Headers,
    schema: StructType | None,
    mode: str,
    metadata: bool,
    pattern: object,
) -> DataFrame:
    """One scan for each header, united by standardised column name."""
    tidy = {names: standard_names(list(names)) for names in groups}
    if schema is not None:
        _columns_of(schema, [name for names in tidy.values() for name in names], pattern)
        parts = []
        for names, files in groups.items():
            own = StructType([field for field in schema if field.name in tidy[names]])
            parts.append(_scan(spark, files, list(names), own, mode, metadata))
    else:
        parts = _inferred(spark, groups, tidy, metadata)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _inferred(
    spark: SparkSession, groups: Headers, tidy: dict, metadata: bool
) -> list[DataFrame]:
    """Inferred types, but text where a column is a number in one group and none in another."""
    reader = spark.read.option("header", True)
    inferred = {
        names: spark.read.option("header", True).option("inferSchema", True).csv(files).schema
        for names, files in groups.items()
    }
    kinds: dict[str, set[str]] = {}
    for names, found in inferred.items():
        for name, field in zip(tidy[names], found, strict=True):
            is_number = isinstance(field.dataType, NumericType)
            kinds.setdefault(name, set()).add("number" if is_number else field.dataType.simpleString())
    parts = []
    for names, files in groups.items():
        fields = [
            StructField(field.name, field.dataType if len(kinds[name]) == 1 else StringType())
            for name, field in zip(tidy[names], inferred[names], strict=True)
        ]
        rows = reader.schema(StructType(fields)).csv(files).toDF(*tidy[names])
        parts.append(with_ingest_metadata(rows) if metadata else rows)
    return parts


def with_ingest_metadata(scan: DataFrame) -> DataFrame:
    """Add load time (one value per query) and source file. Only valid directly on a file scan."""
    return scan.select(
        "*",
        F.current_timestamp().alias(INGESTION_TIMESTAMP),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
    )


def write_csv_extracts(df: DataFrame, raw_dir: str, table: str, key: str, extracts: int = 3) -> None:
    """Write ``df`` as several extracts ``<table>_part=<n>.csv``, matched by ``<table>*.csv``.

    Rows are assigned to an extract by a hash of ``key``; all extracts are written by one job, each
    by all tasks.
    """
    name = f"{table}_part"
    number = F.pmod(F.xxhash64(key), F.lit(extracts)).cast("string")
    (
        df.withColumn(name, F.concat(number, F.lit(".csv")))
        .write.mode("append")
        .partitionBy(name)
        .option("header", True)
        .csv(raw_dir)
    )
