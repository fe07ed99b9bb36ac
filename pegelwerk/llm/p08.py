"""Problem 8: passages of bewertungstexte in documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pegelwerk.llm import leaks
from pegelwerk.sources.tables import table


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "bewertungstexte"))


def p8_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also passages with other numbers, names or units."""
    return leaks.reparameterised(table(spark, sf_dir, "documents"), table(spark, sf_dir, "bewertungstexte"))


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents each leaked item stands in."""
    return p8_found(spark, sf_dir).groupBy("item_id").agg(F.count(F.lit(1)).alias("dokumente"))


QUERIES = {"p8_found": p8_found, "p8_templates": p8_templates, "p8_items": p8_items}
SQL: dict[str, str] = {}
