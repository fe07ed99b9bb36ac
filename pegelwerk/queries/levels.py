"""Seconds, days and rolling windows over the measuring tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pegelwerk.functions import levels as L
from pegelwerk.operators import rolling as R
from pegelwerk.operators import seconds as S
from pegelwerk.operators.instants import _whole, local_day
from pegelwerk.sources.tables import table

BERLIN = "Europe/Berlin"
KEYS = ["messstelle", "tag"]


def r6(c: str):
    return F.round(c, 6).alias(c)


def seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value per station and second of recovery_extract, with local day and second of day."""
    return S.with_local(S.merge_seconds(table(spark, sf_dir, "recovery_extract"), ["messstelle"], "sekunde", "laeq", "lmax"), BERLIN)


SECONDS = """s AS (SELECT messstelle, sekunde AS second, 10 * log10(avg(pow(10, laeq / 10))) AS leq,
    max(CASE WHEN lmax > 0 AND lmax <= 160 THEN lmax END) AS maximum, count(*) AS n,
    CAST(timezone('Europe/Berlin', to_timestamp(sekunde)) AS DATE) AS tag,
    CAST(epoch(timezone('Europe/Berlin', to_timestamp(sekunde))) AS BIGINT) % 86400 AS sod
    FROM recovery_extract WHERE laeq > 0 AND laeq <= 160 GROUP BY messstelle, sekunde)"""


def second_rollup(spark, sf_dir):
    df = S.rollup(table(spark, sf_dir, "level_samples"), ["messstelle"], "at", "levelDb", "id", "source")
    return df.select("messstelle", "second", "n", r6("laeq"), "lmin", "lmax", "letzter", "id_von", "id_bis", "quelle")


def merged_seconds(spark, sf_dir):
    return seconds(spark, sf_dir).select("messstelle", "second", r6("leq"), "maximum", "n", "tag", F.col("sod").cast("long").alias("sod"))


def daily_laeq(spark, sf_dir):
    d = S.day_metrics(seconds(spark, sf_dir), KEYS)
    return d.select(*KEYS, "sekunden", r6("abdeckung"), "stufe", r6("laeq"), "lmax", r6("l1"), "ueber55", r6("anteil55"))


def segment_laeq(spark, sf_dir):
    s = seconds(spark, sf_dir).withColumn("abschnitt", L.segment(F.col("sod")))
    d = s.groupBy(*KEYS, "abschnitt").agg(F.count(F.lit(1)).alias("sekunden"), L.laeq(F.col("leq")).alias("laeq"), F.max("maximum").alias("lmax"))
    over = lambda c, x: F.coalesce(F.col(c) > x, F.lit(False))
    return d.select(*KEYS, "abschnitt", "sekunden", r6("laeq"), "lmax", over("laeq", 40).alias("ueber40"), over("laeq", 45).alias("ueber45"), over("lmax", 60).alias("max60"))


def takt_max_lr(spark, sf_dir):
    return S.takt_maximum(seconds(spark, sf_dir), KEYS).select(*KEYS, r6("lr"), "takte", r6("ki"))


def assumed_levels(spark, sf_dir):
    """Bounds and fill-ups of the day level: A-11, A-12, A-26, F-18."""
    s = seconds(spark, sf_dir).filter((F.col("sod") >= 25_200) & (F.col("sod") < 72_000))
    d = s.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("sekunden"), L.laeq(F.col("leq")).alias("laeq"), F.max("sod").cast("long").alias("ende"))
    n, rest = F.col("sekunden"), F.lit(72_000) - F.col("ende")
    late = F.col("ende").between(54_000, 68_400)
    return d.select(
        *KEYS, "sekunden", r6("laeq"), "ende",
        F.round(L.lower_bound(F.col("laeq"), n), 6).alias("untergrenze"),
        F.round(L.filled_up(F.col("laeq"), n, F.lit(L.DAY_SECONDS) - n, 50.0), 6).alias("aufgefuellt"),
        F.round(F.when(late, L.filled_up(F.col("laeq"), n, rest, 55.0)), 6).alias("vorsichtig"),
        L.borderline(F.col("laeq")).alias("grenzfall"),
        L.tier_of_count(n).alias("stufe"),
    )


def plausibility_counts(spark, sf_dir):
    x = table(spark, sf_dir, "recovery_extract")
    return x.groupBy("tabelle", L.plausibility(F.col("lmin"), F.col("lmax")).alias("plausibilitaet")).agg(F.count(F.lit(1)).alias("saetze"))


def flag_mask(spark, sf_dir):
    m = table(spark, sf_dir, "measurements")
    return m.groupBy("flags").agg(F.count(F.lit(1)).alias("zeilen"), F.count_if(L.countable_flags(F.col("flags")) & L.valid(F.col("levelDb"))).alias("gueltig"))


def reject_reasons(spark, sf_dir):
    a = table(spark, sf_dir, "alt_export")
    reason = (
        F.when(F.trim("Zeit").try_cast("timestamp").isNull(), "zeit")
        .when(F.upper(F.trim("Quelle")) == "KEINE_VERBINDUNG", "keine_verbindung")
        .when(~L.countable_flags(F.col("Flags")), "flags")
        .when(F.coalesce("Samples", F.lit(0)) <= 0, "samples")
        .when(~L.valid(F.col("LAeq_dB")), "pegel")
        .otherwise("ok")
    )
    return a.groupBy(reason.alias("grund")).agg(F.count(F.lit(1)).alias("zeilen"))


def samples_by_day_source(spark, sf_dir):
    x = table(spark, sf_dir, "level_samples")
    day = F.date_from_unix_date(local_day(F.col("at"), BERLIN))
    return x.groupBy("messstelle", day.alias("tag"), "source").agg(F.count(F.lit(1)).alias("zeilen"), F.min("at").alias("erste"), F.max("at").alias("letzte"))


def time_regressions(spark, sf_dir):
    """Steps back and gaps over 120 s along the order of arrival, per station; blocks of ids bound the windows."""
    from pyspark.sql import Window

    x = table(spark, sf_dir, "level_samples").select("messstelle", "id", "at", _whole(F.col("id"), 100_000).alias("_b"))
    ends = x.groupBy("messstelle", "_b").agg(F.max_by("at", "id").alias("z"))
    carry = ends.select("messstelle", "_b", F.lag("z").over(Window.partitionBy("messstelle").orderBy("_b")).alias("carry"))
    w = Window.partitionBy("messstelle", "_b").orderBy("id")
    d = x.join(carry, ["messstelle", "_b"]).withColumn("vor", F.coalesce(F.lag("at").over(w), "carry"))
    step = F.col("at") - F.col("vor")
    return d.groupBy("messstelle").agg(F.count_if(step < 0).alias("ruecksprung"), F.count_if(step > 120_000).alias("luecke"))


def rolling_leq(spark, sf_dir):
    return R.rolling_laeq(seconds(spark, sf_dir), KEYS).select("messstelle", "second", r6("rollend"))


def rolling_mean_std(spark, sf_dir):
    return R.centred(seconds(spark, sf_dir), KEYS).select("messstelle", "second", r6("mittel"), r6("streuung"))


def loudest_hour(spark, sf_dir):
    """The loudest hour of each day by the rule: 1,800 measured seconds at least."""
    return R.loudest_hour(seconds(spark, sf_dir), KEYS).select(*KEYS, "ende", "sekunden", r6("laeq"))


def loudest_quarter_hour_of_data(spark, sf_dir):
    """The same with 900 measured seconds."""
    return R.loudest_hour(seconds(spark, sf_dir), KEYS, least=900).select(*KEYS, "ende", "sekunden", r6("laeq"))


def loudest_hour_of_day(spark, sf_dir):
    """Inside the day window 07 to 20: W-02 with its bounds."""
    s = seconds(spark, sf_dir)
    at = lambda sod: (F.col("second") - F.col("sod") + sod).alias
    s = s.select("*", at(25_200)("_von"), at(72_000)("_bis"))
    return R.loudest_hour(s, KEYS, bounds=("_von", "_bis")).select(*KEYS, "ende", "sekunden", r6("laeq"))


def loudest_hour_complete(spark, sf_dir):
    """Only hours without any gap: W-04."""
    return R.loudest_hour(seconds(spark, sf_dir), KEYS, least=3600).select(*KEYS, "ende", "sekunden", r6("laeq"))


def loudest_at_noon(spark, sf_dir):
    """Loudest hours of at least 60 dB whose middle lies between 11 and 15 o'clock: F-23."""
    from pegelwerk.operators.instants import utc_to_wall

    h = loudest_hour(spark, sf_dir)
    middle = F.pmod(utc_to_wall((F.col("ende") - 1799) * 1000, BERLIN), F.lit(86_400_000))
    return h.filter((middle >= 39_600_000) & (middle <= 54_000_000) & (F.col("laeq") >= 60))


def loudest_minute(spark, sf_dir):
    return R.loudest_hour(seconds(spark, sf_dir), KEYS, least=30, strict_start=False, span=60).select(*KEYS, "ende", "sekunden", r6("laeq"))


def _loudest_sql(span: int, least: int, strict: bool, day: bool = False) -> str:
    start = f"a + {span - 1}" if strict else "a"
    seconds_ = SECONDS + (", s AS (SELECT *, second - sod + 72000 AS bis FROM s0 WHERE sod >= 25200 AND sod < 72000)" if day else "")
    seconds_ = seconds_.replace("s AS (SELECT messstelle, sekunde", "s0 AS (SELECT messstelle, sekunde", 1) if day else seconds_
    last = f"least(greatest(max(second), min(second) + {span - 1}), min(bis) - 1)" if day else f"greatest(max(second), min(second) + {span - 1})"
    return f"""WITH {seconds_},
    b AS (SELECT messstelle, tag, min(second) AS a, {last} AS z FROM s GROUP BY ALL),
    g AS (SELECT messstelle, tag, a, unnest(range(a, z + 1)) AS t FROM b),
    f AS (SELECT g.messstelle, g.tag, g.a, g.t, pow(10, s.leq / 10) AS e FROM g LEFT JOIN s ON s.messstelle = g.messstelle AND s.tag = g.tag AND s.second = g.t),
    w AS (SELECT *, count(e) OVER v AS n, round(10 * log10(avg(e) OVER v), 9) AS l FROM f WINDOW v AS (PARTITION BY messstelle, tag ORDER BY t ROWS BETWEEN {span - 1} PRECEDING AND CURRENT ROW))
    SELECT messstelle, tag, arg_min(t, row(-l, t)) AS ende, arg_min(n, row(-l, t)) AS sekunden, round(max(l), 6) AS laeq FROM w WHERE n >= {least} AND t >= {start} GROUP BY messstelle, tag"""


QUERIES = {
    f.__name__: f
    for f in (
        daily_laeq, second_rollup, merged_seconds, segment_laeq, takt_max_lr, assumed_levels, plausibility_counts, flag_mask, reject_reasons,
        samples_by_day_source, time_regressions, rolling_leq, rolling_mean_std, loudest_hour, loudest_quarter_hour_of_data, loudest_hour_of_day, loudest_hour_complete, loudest_at_noon, loudest_minute,
    )
}
_DAY = "CAST(timezone('Europe/Berlin', to_timestamp({} / 1000)) AS DATE)"
SQL = {
    "daily_laeq": f"""WITH {SECONDS} SELECT messstelle, tag, count(*) AS sekunden, round(count(*) / 46800, 6) AS abdeckung,
        CASE WHEN count(*) / 46800 >= 0.9 THEN 'valid' WHEN count(*) / 46800 >= 0.7 THEN 'partial' ELSE 'window' END AS stufe,
        round(10 * log10(avg(pow(10, leq / 10))), 6) AS laeq, max(maximum) AS lmax, round(quantile_cont(leq, 0.99), 6) AS l1,
        count(*) FILTER (leq > 55) AS ueber55, round(avg(CASE WHEN leq > 55 THEN 1.0 ELSE 0.0 END), 6) AS anteil55 FROM s GROUP BY ALL""",
    "second_rollup": """SELECT messstelle, "at" // 1000 AS second, count(*) AS n, round(10 * log10(avg(pow(10, levelDb / 10))), 6) AS laeq, min(levelDb) AS lmin, max(levelDb) AS lmax,
        arg_max(levelDb, row("at", id)) AS letzter, min(id) AS id_von, max(id) AS id_bis,
        CASE WHEN count(DISTINCT source) = 1 AND count(source) = count(*) THEN min(source) ELSE 'GEMISCHT' END AS quelle
        FROM level_samples WHERE levelDb > 0 AND levelDb <= 160 GROUP BY ALL""",
    "merged_seconds": f"WITH {SECONDS} SELECT messstelle, second, round(leq, 6) AS leq, maximum, n, tag, sod FROM s",
    "segment_laeq": f"""WITH {SECONDS}, x AS (SELECT messstelle, tag, CASE WHEN sod < 25200 THEN 'vor07' WHEN sod < 72000 THEN '07-20' ELSE 'ab20' END AS abschnitt, count(*) AS sekunden,
        10 * log10(avg(pow(10, leq / 10))) AS laeq, max(maximum) AS lmax FROM s GROUP BY ALL)
        SELECT messstelle, tag, abschnitt, sekunden, round(laeq, 6) AS laeq, lmax, laeq > 40 AS ueber40, laeq > 45 AS ueber45, coalesce(lmax > 60, false) AS max60 FROM x""",
    "takt_max_lr": f"""WITH {SECONDS}, k AS (SELECT messstelle, tag, leq, (row_number() OVER (PARTITION BY messstelle, tag ORDER BY second) - 1) // 5 AS b FROM s),
        m AS (SELECT messstelle, tag, b, max(leq) AS m FROM k GROUP BY ALL HAVING count(*) = 5)
        , t AS (SELECT messstelle, tag, 10 * log10(avg(pow(10, m / 10))) AS lr, count(*) AS takte FROM m GROUP BY messstelle, tag),
        d AS (SELECT messstelle, tag, 10 * log10(avg(pow(10, leq / 10))) AS l FROM s GROUP BY ALL)
        SELECT messstelle, tag, round(lr, 6) AS lr, takte, round(lr - l, 6) AS ki FROM t JOIN d USING (messstelle, tag)""",
    "assumed_levels": f"""WITH {SECONDS}, d AS (SELECT messstelle, tag, count(*) AS n, 10 * log10(avg(pow(10, leq / 10))) AS l, max(sod) AS ende FROM s WHERE sod >= 25200 AND sod < 72000 GROUP BY ALL)
        SELECT messstelle, tag, n AS sekunden, round(l, 6) AS laeq, ende, round(l + 10 * log10(n / 46800), 6) AS untergrenze,
        round(10 * log10((n * pow(10, l / 10) + (46800 - n) * pow(10, 5)) / 46800), 6) AS aufgefuellt,
        CASE WHEN ende BETWEEN 54000 AND 68400 THEN round(10 * log10((n * pow(10, l / 10) + (72000 - ende) * pow(10, 5.5)) / (n + 72000 - ende)), 6) END AS vorsichtig,
        abs(l - 55) <= 2.5 OR abs(l - 60) <= 2.5 AS grenzfall,
        CASE WHEN n >= 42120 THEN 'hoch' WHEN n >= 32760 THEN 'teil' ELSE 'fenster' END AS stufe FROM d""",
    "plausibility_counts": "SELECT tabelle, CASE WHEN lmin < 50 THEN 'UNTER_50' WHEN lmax > 100 THEN 'UEBER_100' ELSE 'OK' END AS plausibilitaet, count(*) AS saetze FROM recovery_extract GROUP BY ALL",
    "flag_mask": "SELECT flags, count(*) AS zeilen, count(*) FILTER (coalesce(flags, 11) & 11 = 0 AND levelDb > 0 AND levelDb <= 160) AS gueltig FROM measurements GROUP BY flags",
    "reject_reasons": """SELECT CASE WHEN TRY_CAST(trim(Zeit) AS TIMESTAMPTZ) IS NULL THEN 'zeit' WHEN upper(trim(Quelle)) = 'KEINE_VERBINDUNG' THEN 'keine_verbindung'
        WHEN coalesce(Flags, 11) & 11 <> 0 THEN 'flags' WHEN coalesce(Samples, 0) <= 0 THEN 'samples' WHEN LAeq_dB > 0 AND LAeq_dB <= 160 THEN 'ok' ELSE 'pegel' END AS grund, count(*) AS zeilen FROM alt_export GROUP BY 1""",
    "samples_by_day_source": f"""SELECT messstelle, {_DAY.format('"at"')} AS tag, source, count(*) AS zeilen, min("at") AS erste, max("at") AS letzte FROM level_samples GROUP BY ALL""",
    "time_regressions": """WITH l AS (SELECT messstelle, "at" - lag("at") OVER (PARTITION BY messstelle ORDER BY id) AS d FROM level_samples)
        SELECT messstelle, count(*) FILTER (d < 0) AS ruecksprung, count(*) FILTER (d > 120000) AS luecke FROM l GROUP BY messstelle""",
    "rolling_leq": f"""WITH {SECONDS} SELECT messstelle, second, CASE WHEN count(*) OVER w >= 20 THEN round(10 * log10(avg(pow(10, leq / 10)) OVER w), 6) END AS rollend FROM s
        WINDOW w AS (PARTITION BY messstelle, tag ORDER BY second RANGE BETWEEN 59 PRECEDING AND CURRENT ROW)""",
    "rolling_mean_std": f"""WITH {SECONDS} SELECT messstelle, second, CASE WHEN count(*) OVER w >= 15 THEN round(avg(leq) OVER w, 6) END AS mittel,
        CASE WHEN count(*) OVER w >= 15 THEN round(stddev_samp(leq) OVER w, 6) END AS streuung FROM s
        WINDOW w AS (PARTITION BY messstelle, tag ORDER BY second RANGE BETWEEN 15 PRECEDING AND 14 FOLLOWING)""",
    "loudest_hour": _loudest_sql(3600, 1800, True),
    "loudest_quarter_hour_of_data": _loudest_sql(3600, 900, True),
    "loudest_hour_of_day": _loudest_sql(3600, 1800, True, True),
    "loudest_hour_complete": _loudest_sql(3600, 3600, True),
    "loudest_at_noon": f"""SELECT * FROM ({_loudest_sql(3600, 1800, True)}) h WHERE laeq >= 60
        AND CAST(floor(epoch(timezone('Europe/Berlin', to_timestamp(ende - 1799)))) AS BIGINT) % 86400 BETWEEN 39600 AND 54000""",
    "loudest_minute": _loudest_sql(60, 30, False),
}
