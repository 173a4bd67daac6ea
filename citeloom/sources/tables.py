"""Parquet tables of one directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """``directory/name.parquet`` (a file or a folder of parts)."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
