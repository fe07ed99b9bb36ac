"""Readers of meter and app exports. Every reader has a fixed schema; nothing is inferred.

Rows carry ``datei`` and ``pos`` (their order in the file), so that "first" and "last" mean something.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pegelwerk.functions import levels as L

APP_COLUMNS = ["Zeit", "LAeq_dB", "Samples", "Quelle"]
COPY = r"\(\d+\)\.csv$"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(datei, pos, value): lines with the file's name and their order in it.

    A file is read as one piece, so that the order is the file's; exports are days, not terabytes each.
    """
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("datei"), F.regexp_replace("value", "^﻿", "").alias("v"))
    return text.select("datei", F.posexplode(F.split("v", r"\r?\n")).alias("pos", "value")).filter(F.col("value") != "")


def meter_csv(spark: SparkSession, path: str, zone: str = "Europe/Berlin", copies: bool = False) -> DataFrame:
    """Export of the meter: rows of a running number, MM-dd-yyyy, HH:mm:ss and level -> (datei, pos, second, tag, sod, leq).

    Rows whose first field is no number or that have fewer than four fields are skipped; a date or level
    that can't be read gives null.  Files that are named copies, as "day (1).csv", are left out unless ``copies``.
    """
    c = F.split("value", ",")
    d = lines(spark, path).filter((F.size(c) >= 4) & F.trim(c[0]).rlike(r"^\d+$"))
    if not copies:
        d = d.filter(~F.col("datei").rlike(COPY))
    wall = F.try_to_timestamp(F.concat_ws(" ", F.trim(c[1]), F.trim(c[2])), F.lit("MM-dd-yyyy HH:mm:ss")).cast("timestamp_ntz")
    day = F.to_date(wall)
    sod = F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)
    from pegelwerk.operators.instants import wall_to_utc

    ms = (F.unix_date(day).cast("long") * 86_400 + sod) * 1000
    return d.select("datei", "pos", F.call_function("div", wall_to_utc(ms, zone), F.lit(1000).cast("long")).alias("second"), day.alias("tag"), sod.alias("sod"), L.parse_level(c[3]).alias("leq"))


def one_per_second(rows: DataFrame, keep: str = "mean") -> DataFrame:
    """Rows of one second -> one: energetic mean, or the first or last by file and place."""
    valid = rows.filter(L.valid(F.col("leq")) & F.col("second").isNotNull())
    order = F.struct("datei", "pos")
    agg = {"mean": L.laeq(F.col("leq")), "first": F.min_by("leq", order), "last": F.max_by("leq", order)}[keep]
    return valid.groupBy("second").agg(agg.alias("leq"))


def file_sessions(rows: DataFrame) -> DataFrame:
    """First and last second of each file."""
    return rows.groupBy("datei").agg(F.min("second").alias("begin"), (F.max("second") + 1).alias("end"))


def app_csv(spark: SparkSession, path: str) -> DataFrame:
    """Export of the app: ';', header, decimal comma, byte order mark -> typed columns and ``grund`` why a row doesn't count.

    The level is LAeq_dB, in session files Pegel_dB.  A file without a required column raises.
    """
    raw = spark.read.csv(path, sep=";", header=True, inferSchema=False, encoding="UTF-8")
    raw = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    session = "LAeq_dB" not in raw.columns and "Pegel_dB" in raw.columns
    need = [c for c in APP_COLUMNS if c != "LAeq_dB" or not session]
    missing = [c for c in need if c not in raw.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    col = lambda c, kind: F.col(c).try_cast(kind) if c in raw.columns else F.lit(None).cast(kind)
    zone = F.trim("Zeit").rlike(r"(Z|[+-]\d\d:?\d\d)$")
    out = raw.select(
        F.unix_millis(F.when(zone, F.trim("Zeit").try_cast("timestamp"))).alias("start_ms"),
        L.parse_level(F.col("Pegel_dB" if session else "LAeq_dB")).alias("leq"),
        L.parse_level(F.col("LAFmax_dB")).alias("maximum") if "LAFmax_dB" in raw.columns else F.lit(None).cast("double").alias("maximum"),
        col("Samples", "int").alias("samples"),
        F.trim("Quelle").alias("quelle"),
        (F.coalesce(col("Flags", "int"), F.lit(L.EXCLUDING_FLAGS)) if "Flags" in raw.columns else F.lit(0)).alias("flags"),
    )
    return out.withColumn("grund", reject_reason())


def reject_reason() -> Column:
    return (
        F.when(F.col("start_ms").isNull(), "zeit")
        .when(F.col("quelle") == "KEINE_VERBINDUNG", "keine_verbindung")
        .when(~L.countable_flags(F.col("flags")), "flags")
        .when(F.coalesce("samples", F.lit(0)) <= 0, "samples")
        .when(~L.valid(F.col("leq")), "pegel")
    )


def day_report(text: Column) -> Column:
    """Report of a day -> array of (sod, amplitude): blocks between rows of dashes with 'Zeit:' and 'Amplitude:'."""
    blocks = F.split(text, "-{5,}")
    clock = lambda b, k: F.regexp_extract(b, r"Zeit:\s*(\d{1,2}):(\d{2}):(\d{2})", k).try_cast("int")
    entry = lambda b: F.struct(
        (clock(b, 1) * 3600 + clock(b, 2) * 60 + clock(b, 3)).alias("sod"), L.parse_level(F.regexp_extract(b, r"Amplitude:\s*([0-9.,]+)", 1)).alias("amplitude")
    )
    return F.filter(F.transform(blocks, entry), lambda x: x["sod"].isNotNull())


def input_order(files: DataFrame) -> DataFrame:
    """(pfad, groesse) with ``vorrang``: app exports first, then larger, then by path."""
    kind = F.when(F.regexp_extract("pfad", r"([^/\\]*)$", 1).startswith("laermprotokoll_"), 0).otherwise(1)
    return files.withColumn("vorrang", F.row_number().over(Window.orderBy(kind, F.desc("groesse"), "pfad")))
