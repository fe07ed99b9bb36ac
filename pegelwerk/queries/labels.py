"""Label rules, evidence and verdicts over events and embeddings; day overviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from pegelwerk.functions import audio as A
from pegelwerk.functions import levels as L
from pegelwerk.functions import vectors as X
from pegelwerk.queries.events import _E, _events
from pegelwerk.queries.levels import SECONDS, r6, seconds
from pegelwerk.sources.tables import table

#: (category, condition on an event's features, weight); fixed values
RULES = [
    ("Sprache", "silbentakt > 0.45", 1.2), ("Sprache", "grundton > 0.30 AND grundton < 0.97", 1.0), ("Sprache", "centroid_Hz > 400 AND centroid_Hz < 2000", 0.3), ("Sprache", '"e_tief_<250" > 0.35', -1.0),
    ("Motor/Bagger", '"e_tief_<250" > 0.30', 1.0), ("Motor/Bagger", "centroid_Hz < 700", 1.0), ("Motor/Bagger", "impuls_crest < 6", 0.5),
    ("Bohren/Impuls", "impuls_crest > 7", 0.8), ("Bohren/Impuls", '"e_hoch_>2k" > 0.45', 1.0), ("Bohren/Impuls", "centroid_Hz > 2200", 0.8),
    ("Fahrzeug", "centroid_Hz > 700 AND centroid_Hz < 2500", 0.6), ("Fahrzeug", '"e_hoch_>2k" > 0.2 AND "e_tief_<250" < 0.35', 0.4), ("Fahrzeug", "silbentakt < 0.4", 0.2),
]
#: Labels that count as work on the site; fixed values.
SITE = ["Bagger", "Bohrgeraet/schweres Geraet", "Schweres Baugeraet/sonstige Maschine", "Motor/Diesel", "Schlagen/Bohren", "Saege", "Fahrzeug", "Signal/Warnton"]
CLASSES = {"a": {0: 1.0, 1: 0.8, 2: 0.5}, "b": {3: 1.0, 4: 1.0}, "c": {5: 0.85}}


def rule_labels(spark, sf_dir):
    """Labels from those rules that an event's own columns allow, with the gate on speech: N-05."""
    e = table(spark, sf_dir, "relevante_ereignisse")
    gate = ("Sprache", F.expr("silbentakt > 0.45 OR (grundton > 0.30 AND grundton < 0.97)"), 0.35)
    r = A.rule_scores([(k, F.expr(c.replace('"', "`")), w) for k, c, w in RULES], [gate])
    exact = lambda c: F.sum(F.round(c, 6).cast("decimal(18,6)")).cast("double")
    return e.select(r.alias("r")).groupBy("r.label").agg(F.count(F.lit(1)).alias("zeilen"), exact("r.punkte").alias("punkte"), exact("r.konfidenz").alias("konfidenz"))


def evidence_matrix(spark, sf_dir):
    """Evidence by category and coverage: N-04."""
    p = F.transform(X.doubles(F.col("embedding")), lambda x: F.abs(x))
    e = table(spark, sf_dir, "embeddings").select("vec_id", p.alias("p")).select("vec_id", A.evidence(F.col("p"), CLASSES, ("d", [6, 7], [8, 9])).alias("e"))
    return e.select("vec_id", *[F.round(f"e.belege.{k}", 6).alias(k) for k in (*CLASSES, "d")], F.col("e.bester").alias("bester"), F.round("e.abdeckung", 6).alias("abdeckung"))


def cluster_verdicts(spark, sf_dir):
    """Mean scores, margins, consensus and gate per cluster: A-38, L-02, L-04, L-05."""
    e = table(spark, sf_dir, "embeddings").select("label", A.prompt_scores(F.slice(X.doubles(F.col("embedding")), 1, 4), F.array(*[F.array(*[F.lit(float(i == k)) for i in range(4)]) for k in range(4)]), 4.0).alias("s"))
    v = A.cluster_verdict(e, "label", "s", ["w", "x", "y", "z"], strict="w")
    return v.select("label", "kandidat", r6("punkte"), r6("abstand"), r6("konsens"), r6("konfidenz"), "urteil")


def site_days(spark, sf_dir):
    """Per day: labelled site events, those at night, loudest: F-09, F-22, T-09, A-42."""
    from pegelwerk.operators.instants import utc_to_wall

    e = _events(spark, sf_dir)
    h = F.floor(F.pmod(utc_to_wall(F.col("Timestamp_ms"), "Europe/Berlin"), F.lit(86_400_000)) / 3_600_000)
    site = F.col("label").isin(SITE)
    night = F.coalesce((h < 7) | (h >= 20), F.lit(False))
    return e.groupBy("Datum").agg(F.count_if(site).alias("bau"), F.count_if(~site).alias("sonst"), F.count_if(site & night).alias("nachts"), F.max(F.when(site, F.col("dBA"))).alias("spitze"))


def day_list(spark, sf_dir):
    """Measured days and, where there are none, days with evidence only: U-06."""
    m = seconds(spark, sf_dir).select("messstelle", "tag").distinct()
    e = table(spark, sf_dir, "relevante_ereignisse").select("messstelle", F.col("Datum").alias("tag")).distinct()
    return m.withColumn("art", F.lit("gemessen")).unionByName(e.join(m, ["messstelle", "tag"], "left_anti").withColumn("art", F.lit("beleg")))


def checks(spark, sf_dir):
    """Plausibility of day metrics as columns: F-24, U-05."""
    s = seconds(spark, sf_dir)
    d = s.groupBy("messstelle", "tag").agg(F.count(F.lit(1)).alias("n"), L.laeq(F.col("leq")).alias("l"), F.min("leq").alias("a"), F.max("leq").alias("z"))
    day = F.col("z") - F.col("l")
    return d.agg(F.count_if(F.col("n") > 90_000).alias("zu_viele"), F.count_if(day < -1e-9).alias("ueber_max"), F.count_if(F.col("l") < F.col("a") - 1e-9).alias("unter_min"), F.count(F.lit(1)).alias("tage"))


QUERIES = {f.__name__: f for f in (rule_labels, evidence_matrix, cluster_verdicts, site_days, day_list, checks)}
_SUMS = {k: " + ".join(f"CASE WHEN {c} THEN {w} ELSE 0 END" for kk, c, w in RULES if kk == k) for k in dict.fromkeys(r[0] for r in RULES)}
_SUMS["Sprache"] = f"({_SUMS['Sprache']}) * CASE WHEN silbentakt > 0.45 OR (grundton > 0.30 AND grundton < 0.97) THEN 1 ELSE 0.35 END"
_IN = "'Bagger', 'Bohrgeraet/schweres Geraet', 'Schweres Baugeraet/sonstige Maschine', 'Motor/Diesel', 'Schlagen/Bohren', 'Saege', 'Fahrzeug', 'Signal/Warnton'"
SQL = {
    "rule_labels": "WITH p AS (SELECT "
    + ", ".join(f"round({v}, 6) AS s{i}" for i, v in enumerate(_SUMS.values()))
    + " FROM relevante_ereignisse), q AS (SELECT *, list_reverse_sort([s0, s1, s2, s3]) AS o, "
    + "list_min(["
    + ", ".join(f"row(-s{i}, '{k}')" for i, k in enumerate(_SUMS))
    + "])[2] AS k FROM p), r AS (SELECT *, greatest(0, least(1, 0.2 * o[1] + 0.35 * (o[1] - o[2]))) AS c FROM q) SELECT CASE WHEN o[1] >= 1 THEN k ELSE 'Sonstiges' END AS label, count(*) AS zeilen, CAST(sum(CAST(round(o[1], 6) AS DECIMAL(18, 6))) AS DOUBLE) AS punkte, CAST(sum(CAST(round(CASE WHEN o[1] >= 1 THEN c ELSE least(c, 0.25) END, 6) AS DECIMAL(18, 6))) AS DOUBLE) AS konfidenz FROM r GROUP BY 1",
    "evidence_matrix": """WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: abs(x::DOUBLE)) AS p FROM embeddings),
        t AS (SELECT *, list_reverse_sort([p[1], p[2] * 0.8, p[3] * 0.5]) AS a3, list_reverse_sort([p[4], p[5]]) AS b2, greatest(p[7], p[8]) AS f, greatest(p[9], p[10]) AS g FROM p),
        e AS (SELECT vec_id, p, a3[1] + 0.25 * a3[2] + 0.1 * a3[3] AS a, b2[1] + 0.25 * b2[2] AS b, p[6] * 0.85 AS c, CASE WHEN f >= 0.06 AND g >= 0.06 THEN sqrt(f * g) * 1.3 ELSE 0 END AS d FROM t)
        SELECT vec_id, round(a, 6) AS a, round(b, 6) AS b, round(c, 6) AS c, round(d, 6) AS d, CASE greatest(a, b, c, d) WHEN a THEN 'a' WHEN b THEN 'b' WHEN c THEN 'c' ELSE 'd' END AS bester,
        round(least(1.0, greatest(a, b, c, d) / greatest(list_max(p), 1e-6)), 6) AS abdeckung FROM e""",
    "site_days": f"""WITH {_E}, h AS (SELECT *, label IN ({_IN}) AS bau, CAST(floor(epoch(timezone('Europe/Berlin', to_timestamp(Timestamp_ms / 1000)))) AS BIGINT) % 86400 // 3600 AS h FROM e)
        SELECT Datum, count(*) FILTER (bau) AS bau, count(*) FILTER (NOT bau) AS sonst, count(*) FILTER (bau AND (h < 7 OR h >= 20)) AS nachts, max(CASE WHEN bau THEN dBA END) AS spitze FROM h GROUP BY Datum""",
    "day_list": f"""WITH {SECONDS}, m AS (SELECT DISTINCT messstelle, tag FROM s), e AS (SELECT DISTINCT messstelle, Datum AS tag FROM relevante_ereignisse)
        SELECT *, 'gemessen' AS art FROM m UNION ALL SELECT *, 'beleg' FROM e ANTI JOIN m USING (messstelle, tag)""",
    "checks": f"""WITH {SECONDS}, d AS (SELECT count(*) AS n, 10 * log10(avg(pow(10, leq / 10))) AS l, min(leq) AS a, max(leq) AS z FROM s GROUP BY messstelle, tag)
        SELECT count(*) FILTER (n > 90000) AS zu_viele, count(*) FILTER (l > z + 1e-9) AS ueber_max, count(*) FILTER (l < a - 1e-9) AS unter_min, count(*) AS tage FROM d""",
    "cluster_verdicts": """WITH v AS (SELECT label, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b, embedding[3]::DOUBLE AS c, embedding[4]::DOUBLE AS d FROM embeddings),
        u AS (SELECT label, exp(4 * a / n) AS a, exp(4 * b / n) AS b, exp(4 * c / n) AS c, exp(4 * d / n) AS d FROM (SELECT *, sqrt(a * a + b * b + c * c + d * d) AS n FROM v)),
        s AS (SELECT label, a / t AS w, b / t AS x, c / t AS y, d / t AS z FROM (SELECT *, a + b + c + d AS t FROM u)),
        g AS (SELECT *, CASE greatest(w, x, y, z) WHEN w THEN 'w' WHEN x THEN 'x' WHEN y THEN 'y' ELSE 'z' END AS sieger FROM s),
        k AS (SELECT label, max(n) / sum(n) AS konsens FROM (SELECT label, sieger, count(*) AS n FROM g GROUP BY ALL) GROUP BY label),
        m AS (SELECT label, avg(w) AS w, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM s GROUP BY label),
        o AS (SELECT *, list_reverse_sort([w, x, y, z]) AS l, CASE greatest(w, x, y, z) WHEN w THEN 'w' WHEN x THEN 'x' WHEN y THEN 'y' ELSE 'z' END AS kandidat FROM m),
        p AS (SELECT label, kandidat, l[1] AS punkte, l[1] - l[2] AS abstand, konsens FROM o JOIN k USING (label)),
        c AS (SELECT *, greatest(0.0, least(1.0, 0.4 * least(1.0, punkte / 0.5) + 0.3 * konsens + 0.2 * least(1.0, abstand / 0.2))) AS konfidenz FROM p)
        SELECT label, kandidat, round(punkte, 6) AS punkte, round(abstand, 6) AS abstand, round(konsens, 6) AS konsens, round(konfidenz, 6) AS konfidenz,
        CASE WHEN konfidenz >= 0.72 AND konsens >= 0.6 AND punkte >= 0.24 AND abstand >= 0.035 AND (kandidat <> 'w' OR (konfidenz >= 0.8 AND punkte >= 0.41 AND abstand >= 0.15 AND konsens >= 0.999)) THEN 'automatisch' ELSE 'pruefen' END AS urteil FROM c""",
}
