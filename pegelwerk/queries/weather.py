"""Weather operators. There is no weather table: hourly bins of ``events`` stand in.

rain = sum of ``value`` of purchases over 200, wind = mean of views, direction = value of errors.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pegelwerk.functions import levels as L
from pegelwerk.operators import intervals as V
from pegelwerk.operators import select as C
from pegelwerk.operators import weather as W
from pegelwerk.queries.levels import r6
from pegelwerk.sources.tables import table

HOUR = 3600


def _second():
    """Seconds since 1970 of a timestamp without zone; independent of the session's zone."""
    return F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)")


def _bins(spark, sf_dir):
    """Hourly bins named by their end; one station per user group of 4."""
    kind = lambda k, c: F.when(F.col("event_type") == k, c)
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 4).alias("station"), _second().alias("t"), "event_type", "value")
    v = F.col("value")
    return e.groupBy("station", ((F.floor(F.col("t") / HOUR) + 1) * HOUR).alias("ende")).agg(
        F.sum(kind("purchase", F.greatest(v - 40, F.lit(0.0)))).alias("regen"), F.avg(kind("view", v)).alias("wind"), F.max(kind("click", v)).alias("boe"), F.max(kind("error", v % 360)).alias("richtung")
    )


BINS = """b AS (SELECT user_id % 4 AS station, (CAST(floor(epoch(ts)) AS BIGINT) // 3600 + 1) * 3600 AS ende, sum(CASE WHEN event_type = 'purchase' THEN greatest(value - 40, 0) END) AS regen,
    avg(CASE WHEN event_type = 'view' THEN value END) AS wind, max(CASE WHEN event_type = 'click' THEN value END) AS boe, max(CASE WHEN event_type = 'error' THEN value % 360 END) AS richtung FROM events GROUP BY ALL)"""


def _runs(spark, sf_dir):
    return W.runs(_bins(spark, sf_dir), ["station"], "ende", F.col("regen") > 0, HOUR, 1, F.col("regen").isNotNull()).filter(F.col("lauf").isNotNull())


def weather_runs_bridge(spark, sf_dir):
    r = _runs(spark, sf_dir)
    return r.groupBy("station", "lauf").agg((F.min("ende") - HOUR).alias("begin"), F.max("ende").alias("end"), F.count(F.lit(1)).alias("bins")).drop("lauf")


def weather_event_summary(spark, sf_dir):
    """Sums, peaks, class and direction of each run: A-27, A-28, F-14, F-15."""
    r = _runs(spark, sf_dir)
    d = r.groupBy("station", "lauf").agg(
        (F.min("ende") - HOUR).alias("begin"), F.sum("regen").alias("regen"), F.max("regen").alias("spitze"), F.avg("wind").alias("wind"), F.max("wind").alias("wind_max"), F.max("boe").alias("boe")
    )
    return d.select("station", "begin", r6("regen"), r6("spitze"), r6("wind"), "boe", L.rain_class(F.col("spitze"), 25.0, 60.0).alias("klasse"), L.beaufort(F.col("wind_max") / 10).alias("bft"))


def circular_direction(spark, sf_dir):
    b = _bins(spark, sf_dir)
    d = F.floor(F.col("ende") / 86_400)
    return b.groupBy("station", d.alias("tag")).agg(W.circular_mean(F.when(F.col("wind").isNotNull(), F.col("richtung")), F.col("wind")).alias("richtung")).select("station", "tag", r6("richtung"))


def segment_totals_min_count(spark, sf_dir):
    """Totals of day segments, null unless each hour has a value: A-29."""
    h = F.floor(F.pmod(F.col("ende") - HOUR, F.lit(86_400)) / HOUR)
    seg = F.when(h < 7, "vor07").when(h < 20, "07-20").otherwise("ab20")
    n = F.when(F.col("abschnitt") == "vor07", 7).when(F.col("abschnitt") == "07-20", 13).otherwise(4)
    b = _bins(spark, sf_dir).withColumns({"tag": F.floor((F.col("ende") - HOUR) / 86_400), "abschnitt": seg})
    g = b.groupBy("tag", "abschnitt").agg(F.sum("wind").alias("w"), F.count("wind").alias("c"), F.countDistinct("ende").alias("bins"), F.max("boe").alias("boe"))
    return g.select("tag", "abschnitt", F.round(F.when(F.col("bins") == n, F.col("w")), 6).alias("summe"), "boe", "bins")


def daily_shifted_window(spark, sf_dir):
    """Daily sums over windows that begin at 05:50, bins right closed: A-30."""
    day = F.floor((F.col("ende") - 1 - (5 * 3600 + 50 * 60)) / 86_400)
    g = _bins(spark, sf_dir).groupBy("station", day.alias("tag")).agg(F.count(F.lit(1)).alias("bins"), F.count("regen").alias("bekannt"), F.sum("regen").alias("regen"))
    return g.select("station", "tag", "bins", "bekannt", r6("regen"), (F.col("bekannt") == 24).alias("vergleichbar"))


def _rain_wind(spark, sf_dir):
    """Events as seconds with level, day, and whether a rain run (with an hour after it) or a windy bin covers them."""
    rain = weather_runs_bridge(spark, sf_dir).select("station", "begin", (F.col("end") + HOUR).alias("end"))
    rain = V.merged(rain.filter(F.col("end") - F.col("begin") > 3 * HOUR), ["station"]).select("station", "begin", "end")
    wind = _bins(spark, sf_dir).filter(F.col("wind") >= 60).select("station", (F.col("ende") - HOUR).alias("begin"), F.col("ende").alias("end"))
    s = table(spark, sf_dir, "events").filter((F.col("value") > 0) & (F.col("value") <= 160)).select("event_id", (F.col("user_id") % 4).alias("station"), _second().alias("second"), F.col("value").alias("leq"))
    s = V.covered(V.covered(s, rain, ["station"], "second", "regen", 6 * HOUR), wind, ["station"], "second", "wind", 6 * HOUR)
    return s.withColumn("tag", F.floor(F.col("second") / 86_400))


def ab_sensitivity(spark, sf_dir):
    d = W.sensitivity(_rain_wind(spark, sf_dir), ["tag"], "regen", "wind")
    cols = [f"{k}_{x}" for k in ("a", "ohne_regen", "ohne_wind", "b") for x in ("sekunden", "ueber55", "ueber60", "stufe")]
    levels = [r6(f"{k}_{x}") for k in ("a", "ohne_regen", "ohne_wind", "b") for x in ("laeq", "untergrenze")]
    return d.select("tag", "regen_s", "wind_s", *cols, *levels, r6("differenz"), "geaendert", "grund")


def fallback_substitution(spark, sf_dir):
    """Per hour the bin of the nearest station that has rain and wind: J-22."""
    b = _bins(spark, sf_dir).withColumn("abstand", F.col("station"))
    return C.substitute_rows(b, ["ende"], ["regen", "wind"], "abstand").select("ende", "station", r6("regen"), r6("wind"))


def null_safe_diff(spark, sf_dir):
    """Two stations compared field by field: J-20."""
    b = _bins(spark, sf_dir).select("station", "ende", F.round("regen", 3).cast("decimal(18,3)").alias("regen"), F.round("boe", 3).cast("decimal(18,3)").alias("boe"))
    one = lambda k: b.filter(F.col("station") == k).drop("station")
    return C.null_safe_diff(one(0), one(1), ["ende"], ["regen", "boe"]).groupBy("feld").agg(F.count(F.lit(1)).alias("unterschiede"), F.count_if(F.col("alt").isNull()).alias("alt_fehlt"), F.count_if(F.col("neu").isNull()).alias("neu_fehlt"))


QUERIES = {
    f.__name__: f
    for f in (
        weather_runs_bridge, weather_event_summary, circular_direction, segment_totals_min_count, daily_shifted_window, ab_sensitivity, fallback_substitution, null_safe_diff,
    )
}
_R = f"""{BINS}, p AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY ende) AS p, coalesce(regen > 0, false) AS a FROM b),
    c AS (SELECT *, lag(p) OVER w AS vp, lag(ende) OVER w AS ve FROM p WHERE a WINDOW w AS (PARTITION BY station ORDER BY ende)),
    n AS (SELECT c.*, NOT coalesce(p - vp <= 2 AND ende - ve = (p - vp) * 3600 AND (p - vp = 1 OR (SELECT count(*) FROM p q WHERE q.station = c.station AND q.p = c.p - 1 AND q.regen IS NOT NULL) = 1), false) AS neu FROM c),
    g AS (SELECT *, sum(neu::INT) OVER (PARTITION BY station ORDER BY ende) AS lauf FROM n),
    r AS (SELECT station, min(ende) - 3600 AS "begin", max(ende) AS "end" FROM g GROUP BY station, lauf)"""
_AB = """{k}_sekunden, coalesce({k}_l > 55, false) AS {k}_ueber55, coalesce({k}_l > 60, false) AS {k}_ueber60, CASE WHEN {k}_sekunden >= 42120 THEN 'hoch' WHEN {k}_sekunden >= 32760 THEN 'teil' WHEN {k}_sekunden > 0 THEN 'fenster' ELSE 'keine' END AS {k}_stufe,
    round({k}_l, 6) AS {k}_laeq, round({k}_l + 10 * log10(CASE WHEN {k}_sekunden > 0 THEN {k}_sekunden / 46800 END), 6) AS {k}_untergrenze"""
_AGG = "count(*) FILTER ({c}) AS {k}_sekunden, round(10 * log10(avg(pow(10, leq / 10)) FILTER ({c})), 9) AS {k}_l"
_CASES = {"a": "true", "ohne_regen": "NOT regen", "ohne_wind": "NOT wind", "b": "NOT (regen OR wind)"}
_CH = " OR ".join(f"a_{x} <> {v}_{x}" for x in ("stufe", "ueber55", "ueber60") for v in ("ohne_regen", "ohne_wind", "b"))
SQL = {
    "weather_runs_bridge": f"""WITH {_R} SELECT r.*, (SELECT count(*) FROM b WHERE b.station = r.station AND b.ende > r."begin" AND b.ende <= r."end") AS bins FROM r""",
    "weather_event_summary": f"""WITH {_R}, x AS (SELECT r.station, r."begin", sum(regen) AS regen, max(regen) AS spitze, avg(wind) AS wind, max(wind) AS wm, max(boe) AS boe FROM r JOIN b ON b.station = r.station AND b.ende > r."begin" AND b.ende <= r."end" GROUP BY ALL)
        SELECT station, "begin", round(regen, 6) AS regen, round(spitze, 6) AS spitze, round(wind, 6) AS wind, boe, CASE WHEN spitze IS NULL THEN 'unbekannt' WHEN spitze < 25 THEN 'leicht' WHEN spitze <= 60 THEN 'mäßig' ELSE 'stark' END AS klasse,
        CASE WHEN wm IS NOT NULL THEN {' + '.join(f'(wm / 10 >= {t})::INT' for t in L.BEAUFORT)} END AS bft FROM x""",
    "circular_direction": f"""WITH {BINS}, d AS (SELECT station, ende // 86400 AS tag, wind AS w, CASE WHEN wind IS NOT NULL THEN richtung END AS g FROM b),
        s AS (SELECT station, tag, sum(cos(radians(g)) * w) AS x, sum(sin(radians(g)) * w) AS y FROM d GROUP BY ALL)
        SELECT station, tag, CASE WHEN sqrt(x * x + y * y) > 1e-9 THEN round((degrees(atan2(y, x)) + 360) % 360, 6) END AS richtung FROM s""",
    "segment_totals_min_count": f"""WITH {BINS}, d AS (SELECT *, (ende - 3600) // 86400 AS tag, (ende - 3600) % 86400 // 3600 AS h FROM b),
        s AS (SELECT *, CASE WHEN h < 7 THEN 'vor07' WHEN h < 20 THEN '07-20' ELSE 'ab20' END AS abschnitt FROM d)
        SELECT tag, abschnitt, CASE WHEN count(DISTINCT ende) = CASE abschnitt WHEN 'vor07' THEN 7 WHEN '07-20' THEN 13 ELSE 4 END THEN round(sum(wind), 6) END AS summe, max(boe) AS boe, count(DISTINCT ende) AS bins FROM s GROUP BY tag, abschnitt""",
    "daily_shifted_window": f"""WITH {BINS} SELECT station, (ende - 21001) // 86400 AS tag, count(*) AS bins, count(regen) AS bekannt, round(sum(regen), 6) AS regen, count(regen) = 24 AS vergleichbar FROM b GROUP BY ALL""",
    "ab_sensitivity": f"""WITH {_R}, l AS (SELECT station, "begin" AS a, "end" + 3600 AS z FROM r WHERE "end" - "begin" + 3600 > 10800), w AS (SELECT station, ende - 3600 AS a, ende AS z FROM b WHERE wind >= 60),
        s AS (SELECT event_id, user_id % 4 AS station, CAST(floor(epoch(ts)) AS BIGINT) AS second, value AS leq FROM events WHERE value > 0 AND value <= 160),
        m AS (SELECT s.*, second // 86400 AS tag, EXISTS (SELECT 1 FROM l WHERE l.station = s.station AND s.second >= l.a AND s.second < l.z) AS regen, EXISTS (SELECT 1 FROM w WHERE w.station = s.station AND s.second >= w.a AND s.second < w.z) AS wind FROM s),
        d AS (SELECT tag, count(*) FILTER (regen) AS regen_s, count(*) FILTER (wind) AS wind_s, {', '.join(_AGG.format(c=c, k=k) for k, c in _CASES.items())} FROM m GROUP BY tag),
        e AS (SELECT tag, regen_s, wind_s, {', '.join(_AB.format(k=k) for k in _CASES)}, round(b_l - a_l, 6) AS differenz FROM d)
        SELECT *, {_CH} AS geaendert, CASE WHEN regen_s > 0 AND wind_s > 0 THEN 'Niederschlag + Wind' WHEN regen_s > 0 THEN 'Niederschlag' WHEN wind_s > 0 THEN 'Wind' ELSE 'kein Ausschluss' END AS grund FROM e""",
    "fallback_substitution": f"""WITH {BINS} SELECT ende, station, round(regen, 6) AS regen, round(wind, 6) AS wind FROM b QUALIFY row_number() OVER (PARTITION BY ende ORDER BY CASE WHEN regen IS NOT NULL AND wind IS NOT NULL THEN 0 ELSE 1 END, station) = 1""",
    "null_safe_diff": f"""WITH {BINS}, j AS (SELECT round(x.regen, 3) AS r0, round(y.regen, 3) AS r1, round(x.boe, 3) AS b0, round(y.boe, 3) AS b1 FROM b x JOIN b y USING (ende) WHERE x.station = 0 AND y.station = 1),
        l AS (SELECT 'regen' AS feld, r0 AS alt, r1 AS neu FROM j UNION ALL SELECT 'boe', b0, b1 FROM j)
        SELECT feld, count(*) AS unterschiede, count(*) FILTER (alt IS NULL) AS alt_fehlt, count(*) FILTER (neu IS NULL) AS neu_fehlt FROM l WHERE alt IS DISTINCT FROM neu GROUP BY feld""",
}
