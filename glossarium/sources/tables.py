"""Table access by folder: one Parquet file or folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Table `name` of the folder, restricted to `columns` where given so that the scan prunes."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
