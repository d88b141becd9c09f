"""Table scans and simple sinks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, source: str, name: str | None = None) -> DataFrame:
    """Scan a table: ``load(spark, sf_dir, "orders")`` reads ``sf_dir/orders.parquet``;
    ``load(spark, "db.t")`` reads a catalog table."""
    if name is None:
        return spark.table(source)
    return spark.read.parquet(f"{source.rstrip('/')}/{name}.parquet")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def ensure_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Create an empty Parquet table with ``schema`` at ``path`` when absent; return it."""
    if not _exists(spark, path):
        spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
    return spark.read.schema(schema).parquet(path)


def drop_table(spark: SparkSession, path: str, if_exists: bool = True) -> bool:
    """``DROP TABLE [IF EXISTS]``: delete the table's folder; False when there was none."""
    if not _exists(spark, path):
        if if_exists:
            return False
        raise FileNotFoundError(f"no table at {path}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True))


def append_rows(spark: SparkSession, path: str, rows: Iterable, schema: StructType) -> None:
    """``INSERT ... VALUES``: a literal, small row set appended to the table."""
    spark.createDataFrame(list(rows), schema).write.mode("append").parquet(path)


def append_query(df: DataFrame, path: str) -> None:
    """``INSERT ... SELECT``: append the result of a query."""
    df.write.mode("append").parquet(path)


def ctas(df: DataFrame, path: str) -> DataFrame:
    """``CREATE TABLE t AS SELECT``: the table must not exist yet."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def file_to_table(spark: SparkSession, file: str, path: str, header: bool = True, sep: str = ",",
                  schema: StructType | None = None) -> DataFrame:
    """Load one delimited file into a new table (header + separator as in a load wizard)."""
    reader = spark.read.option("header", header).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return ctas(reader.csv(file), path)
