"""Problem 7: documents.text in containers of 2,048 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pegelwerk.llm import packing
from pegelwerk.sources.tables import table


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.containers(table(spark, sf_dir, "documents"))


def p7_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.usage(p7_containers(spark, sf_dir))


QUERIES = {"p7_containers": p7_containers, "p7_usage": p7_usage}
SQL: dict[str, str] = {}
