"""Problem 3: one value per minute and station, missing minutes marked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pegelwerk.operators import grid
from pegelwerk.operators.instants import local_day
from pegelwerk.queries.p06 import BERLIN, MEASURED, measurement_instants
from pegelwerk.sources.tables import table

KEYS = ["tabelle", "messstelle", "tag"]


def _minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filled minutes of countable readings, with their energetic mean."""
    valid = (F.col("levelDb") > 0) & (F.col("levelDb") <= 160)
    levels = table(spark, sf_dir, "level_samples").filter(valid & (F.col("source") == "PCE_323"))
    levels = levels.select(F.lit("level_samples").alias("tabelle"), "messstelle", F.col("at").alias("utc_ms"), "levelDb")
    flags = F.col("flags").isNotNull() & (F.col("flags").bitwiseAND(F.lit(1 | 2 | 8)) == 0)
    measured = measurement_instants(spark, sf_dir).filter(valid & flags & (F.col("deviceName") == "PCE-323"))
    measured = measured.select(F.lit("measurements").alias("tabelle"), "messstelle", "utc_ms", "levelDb")
    energy = F.pow(F.lit(10.0), F.col("levelDb") / 10)
    filled = grid.steps(
        levels.unionByName(measured).filter(F.col("messstelle").isNotNull()),
        ["tabelle", "messstelle"],
        "utc_ms",
        60,
        {"messwerte": F.count(F.lit(1)), "laeq": 10 * F.log10(F.avg(energy))},
    )
    # Berlin's offsets are whole minutes: a minute lies on one local day
    return filled.withColumn("tag", local_day(F.col("step_s") * 1000, BERLIN))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.missing(_minutes(spark, sf_dir), KEYS, 60).select("tabelle", "messstelle", F.col("step_s").alias("minute_s"))


def p3_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole regular series."""
    return grid.regular(_minutes(spark, sf_dir), KEYS, 60).select(
        "tabelle", "messstelle", F.col("step_s").alias("minute_s"), "messwerte", F.round("laeq", 6).alias("laeq"), F.col("is_missing").alias("fehlt")
    )


_FILLED = f"""
    WITH m AS ({MEASURED}),
    r AS (SELECT 'level_samples' AS tabelle, messstelle, "at" AS t, levelDb FROM level_samples WHERE source = 'PCE_323'
        UNION ALL SELECT 'measurements', m.messstelle, m.t, x.levelDb FROM m JOIN measurements x USING (id) JOIN sessions s ON s.id = x.sessionId
        WHERE s.deviceName = 'PCE-323' AND x.flags IS NOT NULL AND x.flags & 11 = 0),
    f AS (SELECT tabelle, messstelle, t // 60000 * 60 AS minute_s, count(*) AS messwerte, 10 * log10(avg(pow(10, levelDb / 10))) AS laeq
        FROM r WHERE levelDb > 0 AND levelDb <= 160 GROUP BY ALL),
    d AS (SELECT *, CAST(timezone('Europe/Berlin', to_timestamp(minute_s)) AS DATE) AS tag FROM f),
    b AS (SELECT tabelle, messstelle, tag, min(minute_s) AS a, max(minute_s) AS z FROM d GROUP BY ALL),
    g AS (SELECT tabelle, messstelle, unnest(range(a, z + 60, 60)) AS minute_s FROM b)"""

QUERIES = {"p3_found": p3_found, "p3_series": p3_series}
SQL = {
    "p3_found": f"{_FILLED} SELECT g.* FROM g ANTI JOIN f USING (tabelle, messstelle, minute_s)",
    "p3_series": f"{_FILLED} SELECT g.*, f.messwerte, round(f.laeq, 6) AS laeq, f.laeq IS NULL AS fehlt FROM g LEFT JOIN f USING (tabelle, messstelle, minute_s)",
}
