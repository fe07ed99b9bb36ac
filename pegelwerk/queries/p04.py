"""Problem 4: sessions of events per station."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pegelwerk.operators.sessions import cut, session_tree
from pegelwerk.sources.tables import finite, table


def _tree(spark: SparkSession, sf_dir: str, settings: list[int]) -> DataFrame:
    clips = (
        table(spark, sf_dir, "relevante_ereignisse")
        .filter(F.col("WAV").isNotNull() & F.col("Timestamp_ms").isNotNull())
        .groupBy("WAV")
        .agg(*[F.min(c).alias(c) for c in ("Timestamp_ms", "messstelle", "Datum")], F.max(finite(F.col("dBA"))).alias("dBA"))
    )
    return session_tree(clips, ["messstelle"], "Timestamp_ms", "WAV", "dBA", limit="Datum", settings=settings)


def _named(df: DataFrame) -> DataFrame:
    return df.select(
        "messstelle", "start_ms", F.col("end_ms").alias("ende_ms"), F.col("events").alias("ereignisse"), F.col("best_key").alias("lautester_clip")
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(cut(_tree(spark, sf_dir, [120_000]), 120_000))


def p4_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions under several gap settings, all from one tree."""
    settings = [10_000, 30_000, 60_000, 120_000, 300_000, 900_000]
    s = F.explode(F.array(*[F.lit(x).cast("long") for x in settings]))
    return (
        _tree(spark, sf_dir, settings)
        .select("*", s.alias("pause_ms"))
        .filter((F.col("gap") <= F.col("pause_ms")) & (F.col("upper_gap") > F.col("pause_ms")))
        .groupBy("pause_ms")
        .agg(F.count(F.lit(1)).alias("sitzungen"), F.sum("events").alias("ereignisse"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("dauer_ms"))
    )


_EVENTS = """
    WITH e AS (SELECT WAV, min(Timestamp_ms) AS t, min(messstelle) AS messstelle, min(Datum) AS Datum, max(CASE WHEN isnan(dBA) THEN NULL ELSE dBA END) AS dBA
        FROM relevante_ereignisse WHERE Timestamp_ms IS NOT NULL GROUP BY WAV),
    l AS (SELECT *, t - lag(t) OVER w AS pause, Datum = lag(Datum) OVER w AS gleich FROM e WINDOW w AS (PARTITION BY messstelle ORDER BY t, WAV))"""
QUERIES = {"p4_found": p4_found, "p4_settings": p4_settings}
SQL = {
    "p4_found": f"""{_EVENTS},
    g AS (SELECT *, sum(CASE WHEN pause <= 120000 AND gleich THEN 0 ELSE 1 END) OVER (PARTITION BY messstelle ORDER BY t, WAV) AS k FROM l)
    SELECT messstelle, min(t) AS start_ms, max(t) AS ende_ms, count(*) AS ereignisse,
        arg_min(WAV, row(coalesce(-dBA, 'Infinity'::DOUBLE), t, WAV)) AS lautester_clip FROM g GROUP BY messstelle, k""",
    "p4_settings": f"""{_EVENTS},
    s AS (SELECT unnest([10000, 30000, 60000, 120000, 300000, 900000]) AS pause_ms),
    g AS (SELECT *, sum(CASE WHEN pause <= pause_ms AND gleich THEN 0 ELSE 1 END) OVER (PARTITION BY pause_ms, messstelle ORDER BY t, WAV) AS k FROM l, s),
    x AS (SELECT pause_ms, messstelle, k, count(*) AS n, max(t) - min(t) AS d FROM g GROUP BY ALL)
    SELECT CAST(pause_ms AS BIGINT) AS pause_ms, count(*) AS sitzungen, CAST(sum(n) AS BIGINT) AS ereignisse, CAST(sum(d) AS BIGINT) AS dauer_ms FROM x GROUP BY 1""",
}
