"""SQL over registered frames and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def exec_query(spark: SparkSession, sql: str) -> DataFrame:
    """execQuery: the result is a DataFrame (no driver-side callback)."""
    return spark.sql(sql)


def create_parquet_table(spark: SparkSession, name: str, schema_ddl: str, location: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING parquet LOCATION '{location}'")


def exec_update(spark: SparkSession, sql: str) -> None:
    """execUpdate / executeBatch: INSERT ... SELECT / VALUES into a table (no row-level UPDATE)."""
    spark.sql(sql)
