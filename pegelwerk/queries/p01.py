"""Problem 1: implausible readings of recovery_extract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pegelwerk.operators.charts import implausible
from pegelwerk.sources.tables import table

FIELDS = ["laeq", "lmin", "lmax"]


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "recovery_extract")
    return implausible(rows, "messstelle", "sekunde", "satz_id", FIELDS, ("lmin", "laeq", "lmax"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir).select(F.col("row_id").alias("satz_id")).distinct()


def p1_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged rows by reason."""
    names = {"impossible": "unmoeglich", "contradicting": "widerspruch", "spike": "ausreisser", "stuck": "haengt"}
    reasons = F.array_compact(F.array(*[F.when(F.col(c), n) for c, n in names.items()]))
    return _flags(spark, sf_dir).select("row_id", F.explode(reasons).alias("grund")).groupBy("grund").agg(F.countDistinct("row_id").alias("saetze"))


QUERIES = {"p1_found": p1_found, "p1_reasons": p1_reasons}
SQL: dict[str, str] = {}
