"""Runs, phases and interval joins over seconds and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pegelwerk.functions import levels as L
from pegelwerk.operators import intervals as V
from pegelwerk.queries.levels import BERLIN, KEYS, SECONDS, r6, seconds
from pegelwerk.sources.tables import table

#: (threshold dB, minutes); fixed values of the four criteria
CRITERIA = [(60.0, 5), (60.0, 10), (65.0, 5), (70.0, 3)]
CRIT = "c(schwelle, minuten) AS (VALUES (60.0::DOUBLE, 5), (60.0::DOUBLE, 10), (65.0::DOUBLE, 5), (70.0::DOUBLE, 3))"


def _criteria(spark):
    return spark.createDataFrame(CRITERIA, "schwelle double, minuten int")


def _phases(spark, sf_dir):
    """Every station and day under every criterion; four rows, so broadcast."""
    both = seconds(spark, sf_dir).crossJoin(F.broadcast(_criteria(spark))).filter(F.col("leq") >= F.col("schwelle"))
    runs = V.islands(both, [*KEYS, "schwelle", "minuten"], "second", 20)
    return runs.filter(F.col("end") - 1 - F.col("begin") >= F.col("minuten") * 60)


def islands_by_criteria(spark, sf_dir):
    return _phases(spark, sf_dir)


def phase_stats(spark, sf_dir):
    """Level, coverage and clips of each phase: A-13."""
    x = F.col("leq")
    p = _phases(spark, sf_dir).drop("punkte")
    s = seconds(spark, sf_dir).select(*KEYS, "second", "leq")
    inside = V.points_in(s, p, KEYS, "second")
    id_ = [*KEYS, "schwelle", "minuten", "begin", "end"]
    stats = inside.groupBy(*id_).agg(
        L.laeq(x).alias("leq"), F.max(x).alias("lmax"), F.min(x).alias("lmin"), (F.count_if(x >= F.col("schwelle")) / F.count(F.lit(1))).alias("anteil")
    )
    clips = _clips(spark, sf_dir).select("messstelle", "second")
    counts = V.points_in(clips, p, ["messstelle"], "second").groupBy("messstelle", "schwelle", "minuten", "begin", "end").agg(F.count(F.lit(1)).alias("clips"))
    out = stats.join(counts, ["messstelle", "schwelle", "minuten", "begin", "end"], "left")
    return out.select(*id_, r6("leq"), "lmax", "lmin", r6("anteil"), F.coalesce("clips", F.lit(0)).cast("long").alias("clips"))


def _clips(spark, sf_dir) -> DataFrame:
    """One row per WAV with an instant: station, second, label and level."""
    e = table(spark, sf_dir, "relevante_ereignisse").filter(F.col("Timestamp_ms").isNotNull())
    return e.groupBy("WAV").agg(F.min("messstelle").alias("messstelle"), F.min(F.floor(F.col("Timestamp_ms") / 1000)).alias("second"), F.max("dBA").alias("dba"))


CLIPS = "k AS (SELECT WAV, min(messstelle) AS messstelle, min(Timestamp_ms // 1000) AS second, max(dBA) AS dba FROM relevante_ereignisse WHERE Timestamp_ms IS NOT NULL GROUP BY WAV)"


def quiet_spans(spark, sf_dir):
    """Even, loud noise by the rule's own limits: rolling mean over 70 dB, deviation under 4 dB."""
    return V.spans(seconds(spark, sf_dir), KEYS).select(*KEYS, "begin", "end", "punkte", r6("leq"), "lmax")


def quiet_spans_60(spark, sf_dir):
    """The same with relaxed limits."""
    return V.spans(seconds(spark, sf_dir), KEYS, above=60.0, spread=2.0).select(*KEYS, "begin", "end", "punkte", r6("leq"), "lmax")


def duration_phases(spark, sf_dir):
    return V.duration_phases(seconds(spark, sf_dir), KEYS, _exclusions(spark, sf_dir), 55.0, 5, 200)


def duration_phases_plain(spark, sf_dir):
    return V.duration_phases(seconds(spark, sf_dir), KEYS, None, 60.0)


def _sessions(spark, sf_dir):
    """Measuring intervals of each station and day: runs of seconds with breaks of up to 30 s."""
    return V.islands(seconds(spark, sf_dir), KEYS, "second", 30).drop("punkte")


def interval_merge(spark, sf_dir):
    return V.merged(_sessions(spark, sf_dir), KEYS, 120)


def interval_gaps(spark, sf_dir):
    return V.gaps(V.merged(_sessions(spark, sf_dir), KEYS, 0), KEYS, 120)


def _exclusions(spark, sf_dir):
    """A minute around each clip over 80 dB, with 30 s after it, as exclusion; cut at local midnight and merged per day."""
    k = _clips(spark, sf_dir).filter("dba >= 80")
    i = k.select("messstelle", (F.col("second") - 30).alias("begin"), (F.col("second") + 60).alias("end"))
    return V.merged(V.by_day(i, BERLIN), KEYS).drop("teile")


def exclusion_anti(spark, sf_dir):
    """Seconds left outside of all exclusions, per station and day."""
    kept = V.points_in(seconds(spark, sf_dir), _exclusions(spark, sf_dir), KEYS, "second", "left_anti")
    return kept.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("sekunden"), F.sum("second").alias("summe"))


def point_in_interval(spark, sf_dir):
    """Clips inside a loud phase."""
    p = _phases(spark, sf_dir).select("messstelle", "begin", "end")
    return V.points_in(_clips(spark, sf_dir), p, ["messstelle"], "second", "left_semi").select("WAV", "messstelle", "second")


def interval_overlap(spark, sf_dir):
    """Common seconds of phases and exclusions."""
    p = _phases(spark, sf_dir).filter("schwelle = 60 AND minuten = 5").select(*KEYS, "begin", "end")
    return V.overlaps(p, _exclusions(spark, sf_dir).select(*KEYS, "begin", "end"), KEYS)


def last_match_interval(spark, sf_dir):
    """The last begun phase that covers the middle of each ten minutes."""
    p = _phases(spark, sf_dir)
    bins = seconds(spark, sf_dir).select("messstelle", (F.floor(F.col("second") / 600) * 600 + 300).alias("mitte")).distinct()
    hit = V.points_in(bins, p, ["messstelle"], "mitte")
    return hit.groupBy("messstelle", "mitte").agg(F.max(F.struct("begin", "schwelle", F.col("minuten").alias("minuten"))).alias("p")).select("messstelle", "mitte", "p.*")




QUERIES = {
    f.__name__: f
    for f in (
        islands_by_criteria, phase_stats, quiet_spans, quiet_spans_60, duration_phases, duration_phases_plain, interval_merge, interval_gaps,
        exclusion_anti, point_in_interval, interval_overlap, last_match_interval,
    )
}
_RUNS = f"""{SECONDS}, {CRIT},
    l AS (SELECT messstelle, tag, schwelle, minuten, second, coalesce(second - lag(second) OVER (PARTITION BY messstelle, tag, schwelle, minuten ORDER BY second) > 20, true) AS neu FROM s, c WHERE leq >= schwelle),
    r AS (SELECT *, sum(neu::INT) OVER (PARTITION BY messstelle, tag, schwelle, minuten ORDER BY second) AS lauf FROM l),
    p AS (SELECT messstelle, tag, schwelle, minuten, min(second) AS "begin", max(second) + 1 AS "end", count(*) AS punkte FROM r GROUP BY messstelle, tag, schwelle, minuten, lauf
        HAVING max(second) - min(second) >= minuten * 60)"""
_SESS = f"""{SECONDS},
    l AS (SELECT messstelle, tag, second, coalesce(second - lag(second) OVER (PARTITION BY messstelle, tag ORDER BY second) > {{gap}}, true) AS neu FROM s),
    r AS (SELECT *, sum(neu::INT) OVER (PARTITION BY messstelle, tag ORDER BY second) AS lauf FROM l),
    m AS (SELECT messstelle, tag, min(second) AS "begin", max(second) + 1 AS "end" FROM r GROUP BY messstelle, tag, lauf)"""
_EXCL = f"""{CLIPS}, x0 AS (SELECT messstelle, second - 30 AS a, second + 60 AS b FROM k WHERE dba >= 80),
    x1 AS (SELECT *, max(b) OVER (PARTITION BY messstelle ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS v FROM x0),
    x2 AS (SELECT *, sum(CASE WHEN v IS NULL OR a > v THEN 1 ELSE 0 END) OVER (PARTITION BY messstelle ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS g FROM x1),
    x3 AS (SELECT messstelle, min(a) AS a, max(b) AS b FROM x2 GROUP BY messstelle, g),
    x4 AS (SELECT *, CAST(unnest(generate_series(date_trunc('day', timezone('Europe/Berlin', to_timestamp(a))), date_trunc('day', timezone('Europe/Berlin', to_timestamp(b - 1))), INTERVAL 1 DAY)) AS DATE) AS tag FROM x3),
    x AS (SELECT messstelle, tag, greatest(a, CAST(epoch(timezone('Europe/Berlin', CAST(tag AS TIMESTAMP))) AS BIGINT)) AS a, least(b, CAST(epoch(timezone('Europe/Berlin', CAST(tag + 1 AS TIMESTAMP))) AS BIGINT)) AS b FROM x4)"""
_SPANS = """WITH {s}, w AS (SELECT *, count(*) OVER v AS cnt, round(avg(leq) OVER v, 9) AS m, round(stddev_samp(leq) OVER v, 9) AS d FROM s WINDOW v AS (PARTITION BY messstelle, tag ORDER BY second RANGE BETWEEN 15 PRECEDING AND 14 FOLLOWING)),
    q AS (SELECT *, coalesce(second - lag(second) OVER (PARTITION BY messstelle, tag ORDER BY second) > 15, true) AS neu FROM w WHERE cnt >= 15 AND m > {above} AND d < {spread}),
    r AS (SELECT *, sum(neu::INT) OVER (PARTITION BY messstelle, tag ORDER BY second) AS lauf FROM q)
    SELECT messstelle, tag, min(second) AS "begin", max(second) + 1 AS "end", count(*) AS punkte, round(10 * log10(avg(pow(10, leq / 10))), 6) AS leq, max(leq) AS lmax
    FROM r GROUP BY messstelle, tag, lauf HAVING max(second) - min(second) >= 59"""


def _phases_sql(threshold: float, minutes: int, above: int, excluded: bool) -> str:
    seg = f"SELECT s.*, (SELECT count(*) FROM x WHERE x.messstelle = s.messstelle AND x.b <= s.second) AS seg FROM s WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.messstelle = s.messstelle AND s.second >= x.a AND s.second < x.b)" if excluded else "SELECT *, 0 AS seg FROM s"
    return f"""WITH {SECONDS}, {_EXCL}, g AS ({seg}),
    m AS (SELECT messstelle, tag, seg, second // 60 AS mi, avg(pow(10, leq / 10)) >= {10 ** (threshold / 10)!r} * (1 - 1e-12) AS h, min(second) AS a, max(second) AS z, count(*) AS n, count(*) FILTER (leq > {threshold}) AS o FROM g GROUP BY ALL),
    l AS (SELECT *, mi - lag(mi) OVER w AS dm, a - lag(z) OVER w AS ds, lag(h) OVER w AS vh FROM m WINDOW w AS (PARTITION BY messstelle, tag, seg ORDER BY mi)),
    r AS (SELECT *, sum(CASE WHEN h AND (vh IS NULL OR NOT vh OR dm > 2 OR ds > 61) THEN 1 ELSE 0 END) OVER (PARTITION BY messstelle, tag, seg ORDER BY mi) AS lauf FROM l)
    SELECT messstelle, tag, min(a) AS "begin", max(z) + 1 AS "end", count(*) AS minuten, CAST(sum(n) AS BIGINT) AS gemessen, CAST(sum(o) AS BIGINT) AS ueber, CAST(max(z) + 1 - min(a) - sum(n) AS BIGINT) AS luecken
    FROM r WHERE h GROUP BY messstelle, tag, seg, lauf HAVING count(*) >= {minutes} AND sum(o) >= {above}"""


SQL = {
    "islands_by_criteria": f"WITH {_RUNS} SELECT * FROM p",
    "phase_stats": f"""WITH {_RUNS}, {CLIPS},
        a AS (SELECT p.*, 10 * log10(avg(pow(10, s.leq / 10))) AS leq, max(s.leq) AS lmax, min(s.leq) AS lmin, avg(CASE WHEN s.leq >= p.schwelle THEN 1.0 ELSE 0.0 END) AS anteil
            FROM p JOIN s ON s.messstelle = p.messstelle AND s.tag = p.tag AND s.second >= p."begin" AND s.second < p."end" GROUP BY ALL)
        SELECT messstelle, tag, schwelle, minuten, "begin", "end", round(leq, 6) AS leq, lmax, lmin, round(anteil, 6) AS anteil,
            (SELECT count(*) FROM k WHERE k.messstelle = a.messstelle AND k.second >= a."begin" AND k.second < a."end") AS clips FROM a""",
    "quiet_spans": _SPANS.format(s=SECONDS, above=70, spread=4),
    "quiet_spans_60": _SPANS.format(s=SECONDS, above=60, spread=2),
    "duration_phases": _phases_sql(55.0, 5, 200, True),
    "duration_phases_plain": _phases_sql(60.0, 10, 600, False),
    "interval_merge": f"""WITH {_SESS.format(gap=30)},
        y AS (SELECT *, coalesce("begin" > lag("end") OVER w + 120, true) AS neu FROM m WINDOW w AS (PARTITION BY messstelle, tag ORDER BY "begin")),
        z AS (SELECT *, sum(neu::INT) OVER (PARTITION BY messstelle, tag ORDER BY "begin") AS g FROM y)
        SELECT messstelle, tag, min("begin") AS "begin", max("end") AS "end", count(*) AS teile FROM z GROUP BY messstelle, tag, g""",
    "interval_gaps": f"""WITH {_SESS.format(gap=30)}, y AS (SELECT messstelle, tag, "end" AS a, lead("begin") OVER (PARTITION BY messstelle, tag ORDER BY "begin") AS b FROM m)
        SELECT messstelle, tag, a AS "begin", b AS "end" FROM y WHERE b - a > 120""",
    "exclusion_anti": f"""WITH {SECONDS}, {_EXCL} SELECT messstelle, tag, count(*) AS sekunden, CAST(sum(second) AS BIGINT) AS summe FROM s
        WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.messstelle = s.messstelle AND s.second >= x.a AND s.second < x.b) GROUP BY messstelle, tag""",
    "point_in_interval": f"""WITH {_RUNS}, {CLIPS} SELECT WAV, messstelle, second FROM k WHERE EXISTS (SELECT 1 FROM p WHERE p.messstelle = k.messstelle AND k.second >= p."begin" AND k.second < p."end")""",
    "interval_overlap": f"""WITH {_RUNS}, {_EXCL} SELECT p.messstelle, p.tag, p."begin", p."end", x.a AS b_begin, x.b AS b_end, least(p."end", x.b) - greatest(p."begin", x.a) AS gemeinsam
        FROM p JOIN x ON x.messstelle = p.messstelle AND p."begin" < x.b AND p."end" > x.a WHERE schwelle = 60 AND minuten = 5""",
    "last_match_interval": f"""WITH {_RUNS}, b AS (SELECT DISTINCT messstelle, second // 600 * 600 + 300 AS mitte FROM s),
        h AS (SELECT b.messstelle, b.mitte, p."begin", p.schwelle, p.minuten, row_number() OVER (PARTITION BY b.messstelle, b.mitte ORDER BY p."begin" DESC, p.schwelle DESC, p.minuten DESC) AS n
            FROM b JOIN p ON p.messstelle = b.messstelle AND b.mitte >= p."begin" AND b.mitte < p."end")
        SELECT messstelle, mitte, "begin", schwelle, minuten FROM h WHERE n = 1""",
}
