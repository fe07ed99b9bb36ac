"""Weather archives: columns by description, stations by distance, products on a common grid."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pegelwerk.operators.select import keep_first_class
from pegelwerk.operators.weather import haversine_km

#: product -> role -> (pattern of the description, units); fixed values
ROLES = {
    "precipitation": {
        "rain_mm": (r"Summe.*Niederschlag", ("mm",)),
        "rain_duration_min": (r"Niederschlagsdauer", ("minute", "minuten", "min")),
        "rain_indicator": (r"Niederschlagsindikator", ("numerischer code", "numerical code")),
    },
    "wind": {
        "wind_mean_ms": (r"Windgeschwindigkeitsmittel|mittlere Windgeschwindigkeit", ("m/sec", "m/s")),
        "wind_direction_deg": (r"Windrichtungsmittel|mittlere Windrichtung", ("grad", "°")),
    },
    "extreme_wind": {"gust_ms": (r"^Maximum der Windgeschwindigkeit", ("m/sec", "m/s"))},
}
#: class of an archive -> how far its values are checked; fixed values
STATUS = {
    "historical": "qualitätsgeprüft",
    "recent": "vorläufig, Qualitätsprüfung nicht abgeschlossen",
    "now": "vorläufig, nicht qualitätsgeprüft (now)",
}
CLASSES = ["historical", "recent", "now"]


def description(spark: SparkSession, path: str) -> DataFrame:
    """Table of parameters: lines that begin with a number; footers are dropped."""
    c = F.split("value", ";")
    t = spark.read.text(path)
    return t.filter(F.trim(c[0]).rlike(r"^\d+$")).select(F.trim(c[0]).alias("station"), *[F.trim(F.get(c, k)).alias(n) for k, n in enumerate(("parameter", "beschreibung", "einheit"), 1)])


def column_of(rows: list, product: str, role: str) -> str:
    """The one parameter that fits a role of a product by words and unit; none or several is an error."""
    words, units = ROLES[product][role]
    fit = sorted({r["parameter"] for r in rows if re.search(words, r["beschreibung"], re.I) and r["einheit"].lower() in units})
    if len(fit) != 1:
        raise ValueError(f"{product}/{role}: {fit or 'no parameter'}")
    return fit[0]


def product(spark: SparkSession, path: str, columns: dict[str, str], name: str, origin: str, kind: str = "historical") -> DataFrame:
    """One archive -> (ende, station, values by role, <name>_qn, <name>_station, <name>_status, <name>_origin); -999 is missing, stamps are UTC.

    The same station and stamp twice is an error, raised by ``unique`` when the rows are read.
    """
    raw = spark.read.csv(path, sep=";", header=True, inferSchema=False)
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    value = lambda c: F.nullif(F.trim(F.col(c)).try_cast("double"), F.lit(-999.0))
    stamp = F.unix_timestamp(F.to_timestamp(F.concat(F.trim("MESS_DATUM"), F.lit("+0000")), "yyyyMMddHHmmZ"))
    qn = next((c for c in raw.columns if c.upper().startswith("QN")), None)
    station = F.lpad(F.trim("STATIONS_ID"), 5, "0")
    return raw.filter(F.trim("MESS_DATUM").rlike(r"^[2-9]\d{11}$")).select(
        stamp.alias("ende"),
        station.alias("station"),
        *[value(c).alias(role) for role, c in columns.items()],
        (value(qn) if qn else F.lit(None).cast("double")).alias(f"{name}_qn"),
        station.alias(f"{name}_station"),
        F.lit(STATUS[kind]).alias(f"{name}_status"),
        F.lit(origin).alias(f"{name}_origin"),
    )


def unique(rows: DataFrame) -> DataFrame:
    """rows; reading them fails if a station has a stamp twice. Counted per day of a station, so no window is long."""
    day = F.call_function("div", F.col("ende"), F.lit(86_400).cast("long"))
    n = F.count(F.lit(1)).over(Window.partitionBy("station", day, "ende"))
    fault = F.concat(F.lit("stamp twice: "), "station", F.lit(" "), F.col("ende").cast("string"))
    return rows.withColumn("_n", F.when(n > 1, F.raise_error(fault).cast("long")).otherwise(n)).filter("_n = 1").drop("_n")


def merged_classes(pieces: dict[str, DataFrame]) -> DataFrame:
    """Rows of several archive classes: where they overlap, historical wins over recent over now."""
    from functools import reduce

    every = reduce(DataFrame.unionByName, [p.withColumn("_class", F.lit(k)) for k, p in pieces.items()])
    return keep_first_class(every, ["station", "ende"], "_class", CLASSES, [F.lit(0)]).drop("_class")


def processed(spark: SparkSession, path: str) -> DataFrame:
    """A processed weather table -> its columns, with ``ende`` and ``anfang`` as epoch seconds; stations stay text."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    second = lambda c: F.unix_seconds(F.col(c).try_cast("timestamp"))
    text = [c for c in raw.columns if c.endswith(("_station", "_status", "_origin"))]
    rest = [c for c in raw.columns if c not in text and c not in ("interval_end_berlin", "interval_start_berlin")]
    return raw.select(second("interval_end_berlin").alias("ende"), second("interval_start_berlin").alias("anfang"), *[F.col(c).try_cast("double").alias(c) for c in rest], *text)


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Geography and devices of stations from the metadata archives below a path: (mitglied, art, station, werte by column name)."""
    from pegelwerk.sources.archives import members

    m = members(spark, path, texts=".txt").filter(F.col("pfad").rlike(r"Metadaten_(Geographie|Geraete)_[^/!]*\.txt$"))
    rows = m.select("pfad", F.split("text", r"\r?\n").alias("l")).select("pfad", F.transform(F.split(F.col("l")[0], ";"), lambda x: F.trim(x)).alias("namen"), F.explode("l").alias("v"))
    fields = F.transform(F.split("v", ";"), lambda x: F.trim(x))
    kind = F.when(F.col("pfad").contains("Geographie"), "geographie").otherwise("geraet")
    good = rows.filter(fields[0].rlike(r"^\d+$"))
    return good.select(F.col("pfad").alias("mitglied"), kind.alias("art"), F.lpad(fields[0], 5, "0").alias("station"), F.map_from_arrays(F.slice("namen", 1, F.least(F.size("namen"), F.size(fields))), F.slice(fields, 1, F.least(F.size("namen"), F.size(fields)))).alias("werte"))


def repeated(rows: DataFrame) -> DataFrame:
    """Stations and stamps that occur more than once."""
    return rows.groupBy("station", "ende").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def on_grid(spark: SparkSession, begin: int, end: int, width: int, products: list[DataFrame]) -> DataFrame:
    """Every bin end in (begin, end], with the products' columns where they have one."""
    grid = spark.range(begin + width, end + 1, width).select(F.col("id").alias("ende"))
    for p in products:
        grid = grid.join(p.drop("station"), "ende", "left")
    return grid


def stations(spark: SparkSession, path: str, lat: float, lon: float) -> DataFrame:
    """Station list of fixed columns -> (station, von, bis, lat, lon, name, km), the nearest first."""
    s = F.split(F.trim("value"), r"\s+")
    t = spark.read.text(path).filter(F.trim("value").rlike(r"^\d{1,5}\s+\d{8}\s+\d{8}\s"))
    d = t.select(F.lpad(s[0], 5, "0").alias("station"), s[1].alias("von"), s[2].alias("bis"), F.get(s, 4).try_cast("double").alias("lat"), F.get(s, 5).try_cast("double").alias("lon"), F.get(s, 6).alias("name"))
    return d.withColumn("km", haversine_km(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"))).orderBy("km", "station")
