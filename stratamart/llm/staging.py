"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratamart.session import scratch_dir


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    Cuts the lineage, so that a lost executor costs a new read of the table and not a new run of
    everything before it, and so that several readers share one computation.
    """
    path = scratch_dir(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete staged tables that no plan still to be run reads."""
    for table in tables:
        jvm = table.sparkSession._jvm
        conf = table.sparkSession._jsc.hadoopConfiguration()
        for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def drop_read_shuffles(spark: SparkSession) -> None:
    """Let the driver's JVM collect what finished jobs left, upon which Spark deletes their shuffle files.

    Spark does so at its next full collection, which may come after many more steps.
    """
    spark._jvm.System.gc()
