"""Table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table as it is stored."""
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, user: str | None = None,
              password: str | None = None, **options: str) -> DataFrame:
    """JDBC table scan (the reference reads ``city_info`` this way)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if user is not None:
        reader = reader.option("user", user)
    if password is not None:
        reader = reader.option("password", password)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def read_catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table registered in the session catalog (Hive metastore or views)."""
    return spark.table(name)
