"""Problem 2: each event's nearest level sample and measurement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pegelwerk.llm.nearest import nearest
from pegelwerk.queries.p06 import MEASURED, measurement_instants
from pegelwerk.sources.tables import table


def _matched(spark: SparkSession, sf_dir: str, tolerance_ms: int = 5000) -> DataFrame:
    events = (
        table(spark, sf_dir, "relevante_ereignisse")
        .filter(F.col("WAV").isNotNull() & F.col("Timestamp_ms").isNotNull())
        .groupBy(F.col("WAV").alias("key"))
        .agg(F.min("Timestamp_ms").alias("t"), F.min("messstelle").alias("entity"))
    )
    levels = table(spark, sf_dir, "level_samples").select(F.col("messstelle").alias("entity"), F.col("at").alias("t"), "id")
    measured = measurement_instants(spark, sf_dir).select(F.col("messstelle").alias("entity"), F.col("utc_ms").alias("t"), "id")
    return nearest(events, {"level_samples": levels, "measurements": measured}, tolerance_ms)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir).select(F.col("key").alias("wav"), F.col("side").alias("tabelle"), "partner_id")


def p2_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far away the partners are, in classes of one second."""
    return (
        _matched(spark, sf_dir)
        .groupBy(F.col("side").alias("tabelle"), F.call_function("div", F.col("distance"), F.lit(1000).cast("long")).alias("sekunden"))
        .agg(F.count(F.lit(1)).alias("ereignisse"), F.sum("distance").alias("summe_ms"))
    )


_PAIRS = f"""
    WITH e AS (SELECT WAV AS wav, min(Timestamp_ms) AS t, min(messstelle) AS messstelle FROM relevante_ereignisse WHERE Timestamp_ms IS NOT NULL GROUP BY WAV),
    m AS ({MEASURED}),
    r AS (SELECT 'level_samples' AS tabelle, messstelle, "at" AS t, id FROM level_samples UNION ALL SELECT 'measurements', messstelle, t, id FROM m),
    x AS (SELECT e.wav, r.tabelle, r.id AS partner_id, abs(e.t - r.t) AS d FROM e JOIN r ON r.messstelle = e.messstelle AND r.t BETWEEN e.t - 5000 AND e.t + 5000),
    y AS (SELECT *, row_number() OVER (PARTITION BY wav, tabelle ORDER BY d, partner_id) AS k FROM x)"""

QUERIES = {"p2_found": p2_found, "p2_distances": p2_distances}
SQL = {
    "p2_found": f"{_PAIRS} SELECT wav, tabelle, partner_id FROM y WHERE k = 1",
    "p2_distances": f"{_PAIRS} SELECT tabelle, d // 1000 AS sekunden, count(*) AS ereignisse, CAST(sum(d) AS BIGINT) AS summe_ms FROM y WHERE k = 1 GROUP BY ALL",
}
