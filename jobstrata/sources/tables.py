"""Tables as Parquet files or folders below one directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def job_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Delivered rows of both job tables, with the columns asked for."""
    pick = columns or ("*",)
    return table(spark, folder, "nyc_jobs").select(*pick).unionByName(
        table(spark, folder, "remote_jobs").select(*pick)
    )
