"""Problem 9: personal data in documents.text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pegelwerk.llm import privacy
from pegelwerk.sources.tables import table


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.found(table(spark, sf_dir, "documents"))


def p9_sanitised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with placeholders."""
    return privacy.sanitised(table(spark, sf_dir, "documents"))


def p9_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disclosing terms: how many bits each gives about a person being named."""
    terms = privacy.Knowledge(privacy.read(table(spark, sf_dir, "documents"))).terms
    rows = [terms[r].withColumn("rolle", F.lit(r)) for r in ("given", "family")]
    return rows[0].unionByName(rows[1]).select("rolle", "term", "n", F.round("announced", 6).alias("announced"), F.round("share", 6).alias("share"), F.round("bits", 6).alias("bits"))


QUERIES = {"p9_found": p9_found, "p9_sanitised": p9_sanitised, "p9_terms": p9_terms}
SQL: dict[str, str] = {}
