"""Parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def finite(c):
    """NaN becomes NULL: NULL is the only missing value inside the engine."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)
