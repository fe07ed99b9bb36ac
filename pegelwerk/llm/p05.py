"""Problem 5: one row for each second, window or file that occurs several times."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pegelwerk.llm.consensus import different, vote
from pegelwerk.plans.lineage import written
from pegelwerk.sources.tables import table

UNLISTED = 1 << 30
#: table -> (art in vertrauen, its column, column whose highest value is newest, fields)
TABLES = {
    "recovery_extract": ("methode", "methode", "runde", ["n", "laeq", "lmin", "lmax"]),
    "alt_export": ("quelle", "Quelle", "exportiert_ms", ["Pegel_dB", "LAeq_dB", "LAFmax_dB", "LAFmin_dB", "Samples", "Klassifikation", "Notizen"]),
    "inventar": ("herkunft_archiv", "herkunft_archiv", "runde", ["pfad", "groesse", "geaendert_utc", "typ", "grund", "lokaler_pfad"]),
}


def _keyed(df: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    if name == "alt_export":
        text = F.trim("Zeit")
        zone = text.rlike(r"(Z|[+-]\d\d:?\d\d)$")
        return df.withColumn("_t", F.unix_millis(F.when(zone, text.try_cast("timestamp")))), ["messstelle", "_t"]
    if name == "inventar":
        return df.withColumn("_sha", F.nullif(F.lower(F.trim("sha256")), F.lit(""))), ["_sha"]
    return df, ["messstelle", "sekunde"]


def _values(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    art, by, newest, fields = TABLES[name]
    trust = (
        table(spark, sf_dir, "vertrauen")
        .filter(F.col("art") == art)
        .groupBy(F.upper(F.trim("wert")).alias("_by"))
        .agg(F.min("rang").alias("_rang"))
    )
    df, keys = _keyed(table(spark, sf_dir, name), name)
    rows = df.select(*keys, "satz_id", newest, by, *fields).withColumn("_by", F.upper(F.trim(F.col(by)))).join(trust, "_by", "left")
    order = [F.coalesce(F.col("_rang").cast("long"), F.lit(UNLISTED)), -F.coalesce(F.col(newest).cast("long"), F.lit(-(1 << 62)))]
    return different(rows, keys, "satz_id", order, fields).withColumn("tabelle", F.lit(name))


def _all(spark: SparkSession, sf_dir: str, weights: str) -> DataFrame:
    values = written(reduce(DataFrame.unionByName, [_values(spark, sf_dir, name) for name in TABLES]))
    best = vote(values, ["tabelle", "_group", "field"], weights)
    return best.select("tabelle", F.col("_group").alias("gruppe"), F.col("field").alias("feld"), F.col("_rank.id").alias("satz_id"), "value")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all(spark, sf_dir, "first").select("tabelle", "gruppe", "feld", "satz_id")


def p5_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survivors under votes weighted by trust instead of strict precedence."""
    return _all(spark, sf_dir, "vote").select("tabelle", "gruppe", "feld", "satz_id", "value")


def _sql() -> str:
    key = {
        "recovery_extract": "messstelle || '|' || sekunde",
        "alt_export": "messstelle || '|' || epoch_ms(CAST(trim(Zeit) AS TIMESTAMPTZ))",
        "inventar": "nullif(lower(trim(sha256)), '')",
    }
    numbers = {"n", "laeq", "lmin", "lmax", "Pegel_dB", "LAeq_dB", "LAFmax_dB", "LAFmin_dB", "Samples", "groesse"}
    parts = []
    for name, (art, by, newest, fields) in TABLES.items():
        for f in fields:
            has = f"{f} IS NOT NULL" + (" AND NOT isnan(CAST(" + f + " AS DOUBLE))" if f in numbers else f" AND trim({f}) <> ''")
            parts.append(
                f"""SELECT '{name}' AS tabelle, g.gruppe, '{f}' AS feld,
                arg_min(satz_id, row(coalesce(v.rang, 1000000), -coalesce({newest}, -4000000000000000000), satz_id)) AS satz_id
                FROM (SELECT *, {key[name]} AS k FROM {name}) x
                JOIN (SELECT {key[name]} AS k, min(satz_id) AS gruppe FROM {name} WHERE {key[name]} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) g USING (k)
                LEFT JOIN (SELECT upper(trim(wert)) AS w, min(rang) AS rang FROM vertrauen WHERE art = '{art}' GROUP BY 1) v ON v.w = upper(trim(x.{by}))
                WHERE {has} GROUP BY g.gruppe"""
            )
    return " UNION ALL ".join(parts)


QUERIES = {"p5_found": p5_found, "p5_votes": p5_votes}
SQL = {"p5_found": _sql()}
