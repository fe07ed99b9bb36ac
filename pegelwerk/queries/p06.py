"""Problem 6: mixed timestamp formats and time zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pegelwerk.operators import instants as I
from pegelwerk.sources.tables import table

BERLIN = "Europe/Berlin"


def measurement_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """measurements with station, device and utc_ms; sessions are joined by size."""
    s = table(spark, sf_dir, "sessions").select(F.col("id").alias("sessionId"), "deviceName", "messstelle", "zeitangabe")
    m = table(spark, sf_dir, "measurements").select("id", "sessionId", "timestamp", "levelDb", "flags")
    local = F.col("zeitangabe") == "ortszeit"
    ms = I.parse_epoch(F.col("timestamp"))
    return m.join(s, "sessionId", "left").select(
        "id", "messstelle", "deviceName", "levelDb", "flags", "timestamp", "zeitangabe", "sessionId",
        F.when(local, I.wall_to_utc(ms, BERLIN)).otherwise(ms).alias("utc_ms"),
    )


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with first and last wall clock, and the zone that fits between their station's neighbours."""
    m = table(spark, sf_dir, "measurements").filter(F.col("id").isNotNull())
    ms = I.parse_epoch(F.col("timestamp"))
    ends = m.groupBy("sessionId").agg(F.min(ms).alias("first_ms"), F.max(ms).alias("last_ms"), F.min("id").alias("seq"), F.count(F.lit(1)).alias("werte"))
    s = table(spark, sf_dir, "sessions").filter(F.col("id").isNotNull()).groupBy(F.col("id").alias("sessionId"))
    s = s.agg(F.min("messstelle").alias("messstelle"), F.max(F.coalesce(F.col("zeitangabe") == "ortszeit", F.lit(False))).alias("lokal"))
    both = ends.join(s, "sessionId", "left").withColumn("angabe", F.when(F.col("lokal"), BERLIN).otherwise("UTC"))
    return I.by_order(both, "messstelle", "seq", "first_ms", "last_ms", "angabe")


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """measurements that are no epoch ms of UTC, with their instant."""
    zones = _sessions(spark, sf_dir).select("sessionId", "zone")
    m = table(spark, sf_dir, "measurements").filter(F.col("id").isNotNull()).select("id", "sessionId", "timestamp")
    ms, zone = I.parse_epoch(F.col("timestamp")), F.coalesce("zone", F.lit("UTC"))
    wrong = m.join(zones, "sessionId", "left").filter((ms != F.col("timestamp")) | (zone != "UTC"))
    utc = F.when(zone == BERLIN, I.wall_to_utc(ms, BERLIN)).otherwise(ms)
    return wrong.select(F.lit("measurements").alias("tabelle"), F.col("id").cast("string").alias("schluessel"), utc.alias("utc_ms"))


def _clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per WAV: station, parsed clock, Timestamp_ms, and the zone of the station's day."""
    # copies of a clip may lack the instant, or hold an unreadable one: all are read, and one per WAV is chosen before anything is decided
    e = table(spark, sf_dir, "relevante_ereignisse").filter(F.col("WAV").isNotNull())
    e = e.groupBy("WAV", "Datum", "Uhrzeit").agg(F.min("Timestamp_ms").alias("ref_ms"), F.min("messstelle").alias("messstelle"))
    day = F.coalesce("Datum", F.min("Datum").over(Window.partitionBy("WAV")))
    choice = lambda w: F.struct(F.coalesce(w["wall_ms"], w["epoch_ms"]).isNull().alias("u"), F.col("Datum").isNull().alias("d"), "Datum", "Uhrzeit", w.alias("wert"))
    t = F.min(I._let(I.parse_text(F.col("Uhrzeit"), F.col("tag")), choice)).alias("t")
    e = e.withColumn("tag", day).groupBy("WAV").agg(F.min("ref_ms").alias("ref_ms"), F.min("messstelle").alias("messstelle"), F.min("tag").alias("day"), t)
    bare = F.when(F.col("t.wert.offset_ms").isNull(), F.col("t.wert.wall_ms"))
    e = e.select("WAV", "messstelle", F.col("day").alias("tag"), "ref_ms", F.col("t.wert").alias("wert"), bare.alias("wall_ms"), F.lit(BERLIN).alias("angabe"))
    # an event's clock is cut to the second or minute: compare by the quarter hour
    return I.by_reference(e, ["messstelle", "tag"], "wall_ms", "ref_ms", "angabe", slack_ms=900_000)


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """manifest with parsed instants and the zone of its stretch of fetches."""
    f = table(spark, sf_dir, "manifest").filter(F.col("file").isNotNull()).select(
        "file",
        F.regexp_extract("file", r"(\d{1,18})\D*$", 1).try_cast("long").alias("seq"),
        I.parse_text(F.col("fetched_at_utc")).alias("wert"),
        (~F.col("fetched_at_utc").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$")).alias("zu_melden"),
        F.lit("UTC").alias("angabe"),
    )
    w = F.col("wert")
    f = f.withColumns({"known_ms": F.coalesce(w["epoch_ms"], w["wall_ms"] - w["offset_ms"]), "wall_ms": w["wall_ms"]})
    return I.between_known(f, "seq", "wall_ms", "known_ms", "angabe")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    instant = I.to_utc(F.col("wert"), F.col("zone")).alias("utc_ms")
    clips = _clips(spark, sf_dir).filter(F.col("ref_ms").isNull()).select(F.lit("relevante_ereignisse").alias("tabelle"), F.col("WAV").alias("schluessel"), instant)
    # one instant per file, should one be listed twice
    files = _fetched(spark, sf_dir).filter("zu_melden").select("file", instant).groupBy("file").agg(F.min("utc_ms").alias("utc_ms"))
    files = files.select(F.lit("manifest").alias("tabelle"), F.col("file").alias("schluessel"), "utc_ms")
    rows = _measured(spark, sf_dir).groupBy("tabelle", "schluessel").agg(F.min("utc_ms").alias("utc_ms")).unionByName(clips).unionByName(files)
    return rows.filter(F.col("utc_ms").isNotNull())


def p6_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offset history of every station's sessions and events and of the manifest: stretches of days (or fetches) in one zone, with violations."""
    day = lambda c: F.date_from_unix_date(I._whole(F.col(c), 86_400_000).cast("int")).cast("string")
    s = _sessions(spark, sf_dir).select(F.concat_ws("/", F.lit("sitzungen"), "messstelle", "angabe").alias("quelle"), day("first_ms").alias("einheit"), "zone", "violations")
    e = _clips(spark, sf_dir).filter(F.col("wall_ms").isNotNull()).select(F.concat_ws("/", F.lit("ereignisse"), "messstelle").alias("quelle"), F.col("tag").cast("string").alias("einheit"), "zone", "violations")
    f = _fetched(spark, sf_dir).filter(F.col("wall_ms").isNotNull() & F.col("known_ms").isNull())
    f = f.select(F.lit("manifest").alias("quelle"), F.format_string("%012d", I._whole(F.col("seq"), 4096)).alias("einheit"), "zone", "violations")
    h = I.history(s.unionByName(e).unionByName(f), "quelle", "einheit")
    return h.select("quelle", "von", "bis", "zone", F.col("violations").alias("verstoesse"), F.col("values").alias("werte"))


#: measurements with station and instant, for the statements of other queries
MEASURED = """
    SELECT m.id, s.messstelle, CASE WHEN s.zeitangabe = 'ortszeit'
        THEN epoch_ms(timezone('Europe/Berlin', make_timestamp(ms * 1000))) ELSE ms END AS t
    FROM (SELECT id, sessionId, CASE WHEN timestamp < 100000000000 THEN timestamp * 1000 WHEN timestamp < 100000000000000 THEN timestamp
        WHEN timestamp < 100000000000000000 THEN timestamp // 1000 ELSE timestamp // 1000000 END AS ms FROM measurements) m
    JOIN sessions s ON s.id = m.sessionId"""

QUERIES = {"p6_found": p6_found, "p6_zones": p6_zones}
SQL: dict[str, str] = {}
