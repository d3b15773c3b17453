"""Schemas, tables and views in the catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.sources.writers import qualified_path


def create_schema(spark: SparkSession, name: str, use: bool = False) -> None:
    spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name)", {"name": name})
    if use:
        spark.catalog.setCurrentDatabase(name)


def drop_schema(spark: SparkSession, name: str) -> None:
    spark.sql("DROP SCHEMA IF EXISTS IDENTIFIER(:name) CASCADE", {"name": name})


def register_external(spark: SparkSession, name: str, path: str) -> None:
    """Give a Parquet path a table name, so that the table shows what the path holds now.

    A table of that name stays, unless its columns are no longer those of the path; then it
    is registered anew. A managed table, a view or a table over another path has data of its
    own under that name: that is an error, and nothing is dropped. Call it again after each
    load: it drops listings Spark has kept and finds new partitions.
    """
    columns = [(f.name, f.dataType) for f in spark.read.parquet(path).schema.fields]
    if spark.catalog.tableExists(name):
        kind, location = spark.catalog.getTable(name).tableType, _location(spark, name)
        if kind != "EXTERNAL" or location != qualified_path(spark, path):
            raise ValueError(f"{name} is there already: {kind.lower()}, at {location}")
        if [(f.name, f.dataType) for f in spark.table(name).schema.fields] != columns:
            spark.sql("DROP TABLE IDENTIFIER(:name)", {"name": name})
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def _location(spark: SparkSession, name: str) -> str | None:
    """Where a table lies, spelt as `qualified_path` does; a view lies nowhere."""
    detail = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", {"name": name})
    found = detail.filter("col_name = 'Location'").select("data_type").head()
    return qualified_path(spark, found[0]) if found else None


def replace_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def insert_into(df: DataFrame, table: str) -> None:
    """Append by column position; a value that does not fit the column type is an error."""
    df.write.insertInto(table, overwrite=False)


def insert_if_empty(df: DataFrame, table: str) -> bool:
    """Seed rows for a table that has none; reads at most one row of it."""
    if not df.sparkSession.table(table).isEmpty():
        return False
    insert_into(df, table)
    return True


def list_tables(spark: SparkSession, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Namespace and name of every table in every schema but the excluded ones."""
    schemas = [row.namespace for row in spark.sql("SHOW SCHEMAS").collect()]
    frames = [
        spark.sql("SHOW TABLES IN IDENTIFIER(:name)", {"name": name}).filter(~F.col("isTemporary"))
        for name in schemas
        if name not in exclude
    ]
    empty = spark.createDataFrame([], "namespace string, tableName string, isTemporary boolean")
    return reduce(DataFrame.unionByName, frames, empty).select("namespace", "tableName")


def describe_schema(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of every column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column string, type string, nullable boolean"
    )
