from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of ``sf_dir``; a file or a directory of part files."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
