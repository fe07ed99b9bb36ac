"""Cached model outputs with consistency checks, and small tables beside the measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the tables by day; fixed values.
POSITIONS = ["Datum", "Umgebung", "Position", "Hinweis"]
EVIDENCE = ["Datum", "Umgebung", "Position", "dB_min", "dB_max", "Zeit"]


def probabilities(spark: SparkSession, path: str, size: int = 527) -> DataFrame:
    """(WAV, probs) of a cache; reading a vector of another length, or a name twice, is an error: such a cache belongs to another model."""
    rows = spark.read.parquet(path)
    length = F.when(F.size("probs") != size, F.raise_error(F.concat(F.lit("wrong length: "), "WAV")).cast("int")).otherwise(0)
    n = rows.groupBy("WAV").agg(F.first("probs").alias("probs"), F.count(F.lit(1)).alias("n"))
    twice = F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("twice: "), "WAV")).cast("int")).otherwise(0)
    return n.filter(twice + length == 0).select("WAV", "probs")


def scores(cache: DataFrame, model: str, prompts: str, categories: list[str]) -> DataFrame:
    """Cached scores that still hold: made by this model, with this version of the prompts, for these categories in this order."""
    same = (F.col("modell") == model) & (F.col("prompt_version") == prompts) & (F.col("kategorien") == F.array(*map(F.lit, categories)))
    return cache.filter(F.coalesce(same, F.lit(False)))


def by_day(spark: SparkSession, path: str, columns: list[str], one: bool = True) -> DataFrame:
    """A ';' table of a few rows a day, as text; rows without a day go. ``one``: the last row of each day counts."""
    raw = spark.read.option("wholetext", True).text(path)
    head = F.regexp_replace("value", "^\ufeff", "")
    lines = raw.select(F.posexplode(F.split(head, r"\r?\n")).alias("pos", "v")).filter(F.trim("v") != "").withColumn("v", F.split("v", ";"))
    names = {c.strip(): k for k, c in enumerate(lines.orderBy("pos").first()["v"])}
    rows = lines.filter(F.col("v")[0] != "Datum").select("pos", *[(F.trim(F.get("v", names[c])) if c in names else F.lit(None).cast("string")).alias(c) for c in columns])
    rows = rows.filter(F.col("Datum").try_cast("date").isNotNull()).withColumn("Datum", F.col("Datum").try_cast("date"))
    if not one:
        return rows.drop("pos")
    rest = [c for c in columns if c != "Datum"]
    return rows.groupBy("Datum").agg(*[F.max_by(c, "pos").alias(c) for c in rest])


def index(spark: SparkSession, path: str) -> DataFrame:
    """An earlier event index read again: rows without name, instant or level that can be read are skipped."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    number = F.replace(F.trim("dBA_Dauermessung"), F.lit(","), F.lit(".")).try_cast("double")
    rows = raw.select(F.trim("Datum").try_cast("date").alias("Datum"), F.trim("Timestamp_ms").try_cast("long").alias("Timestamp_ms"), F.nullif(F.trim("WAV"), F.lit("")).alias("WAV"), number.alias("dBA"))
    return rows.dropna()


def with_positions(days: DataFrame, positions: DataFrame, default: str) -> DataFrame:
    """The table of positions, with a row at the default place for every measured day that has none; what is there stays."""
    new = days.select("Datum").distinct().join(positions, "Datum", "left_anti")
    return positions.unionByName(new.withColumn("Position", F.lit(default)), allowMissingColumns=True)


def video_audit(videos: DataFrame, days: DataFrame) -> DataFrame:
    """videos (datei, tag, sod; both null if the name could not be read) and days (tag, von, bis in seconds of day) -> what each is evidence of.

    belegart: grafik (inside the day's window), messtag (outside), ohne_messung or nicht_erkannt.
    """
    j = videos.join(days.select("tag", "von", "bis"), "tag", "left")
    kind = F.when(F.col("tag").isNull() | F.col("sod").isNull(), "nicht_erkannt").when(F.col("von").isNull(), "ohne_messung").when(F.col("sod").between(F.col("von"), F.col("bis")), "grafik").otherwise("messtag")
    return j.select("datei", "tag", "sod", kind.alias("belegart"))
