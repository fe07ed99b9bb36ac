"""Window checks, reconstruction, targets and balance over alt_export, level_samples and recovery_extract."""

from __future__ import annotations

from pyspark.sql import functions as F

from pegelwerk.functions import levels as L
from pegelwerk.operators import recovery as R
from pegelwerk.operators import seconds as S
from pegelwerk.queries.events import _W, _windows
from pegelwerk.queries.levels import BERLIN, r6
from pegelwerk.sources.tables import table

STATUS = {"PCE_323": "PCE", "GEMISCHT": "GEMISCHT", "MIKROFON": "MIKROFON"}


def _checked(spark, sf_dir, source, pure, tolerance=0.15):
    s = R.window_samples(table(spark, sf_dir, "level_samples"), ["messstelle"], "at", "levelDb", "source", "PCE_323", "MIKROFON", 10_000)
    w = _windows(spark, sf_dir).filter(F.col("quelle") == source)
    return R.check_windows(w, s, ["messstelle"], "leq", "Samples", pure, tolerance)


def mixed_window_check(spark, sf_dir):
    return _checked(spark, sf_dir, "GEMISCHT", False).select("messstelle", "start_ms", "status", r6("delta"), F.col("n_proben").cast("long").alias("n_proben"), "gleich")


def pure_window_check(spark, sf_dir):
    return _checked(spark, sf_dir, "PCE_323", True).groupBy("messstelle", "status").agg(F.count(F.lit(1)).alias("fenster"), F.count_if("gleich").alias("gleich"))


def mixed_window_check_3db(spark, sf_dir):
    """The check with a relaxed tolerance."""
    return _checked(spark, sf_dir, "GEMISCHT", False, 3.0).groupBy("messstelle", "status").agg(F.count(F.lit(1)).alias("fenster"), F.count_if("gleich").alias("gleich"))


def reconstruct_energy(spark, sf_dir):
    w = _checked(spark, sf_dir, "GEMISCHT", False)
    return R.reconstruct(w, "leq", "Samples").select("messstelle", "start_ms", "ergebnis", r6("mitte"), r6("unten"), r6("oben"))


def modal_gap(spark, sf_dir):
    return R.modal_gap(_windows(spark, sf_dir), ["messstelle"], "start_ms")


def _targets(spark, sf_dir):
    w = _windows(spark, sf_dir)
    names = F.create_map(*[F.lit(x) for kv in STATUS.items() for x in kv])
    status = F.when(F.col("Samples") > 0, F.coalesce(F.try_element_at(names, F.col("quelle")), F.lit("FEHLT"))).otherwise("FEHLT")
    return R.inherit(w, ["messstelle"], status, 10, "start_ms")


def target_inherit(spark, sf_dir):
    """Seconds by inherited status, per station: W-22, A-23."""
    t = _targets(spark, sf_dir)
    return t.groupBy("messstelle").agg(*[F.count_if(F.col("status") == s).alias(s.lower()) for s in (*STATUS.values(), "FEHLT")])


def window_status_lookup(spark, sf_dir):
    """Status of the export window that holds each recovered second: J-16."""
    r = table(spark, sf_dir, "recovery_extract").select("messstelle", F.col("sekunde").alias("second"), "satz_id")
    j = r.join(_targets(spark, sf_dir), ["messstelle", "second"], "left")
    return j.groupBy("messstelle", "status").agg(F.count(F.lit(1)).alias("saetze"))


def daily_balance(spark, sf_dir):
    """Per station and day: already there, wanted, rescued, left, possible coverage: A-24."""
    t = S.with_local(_targets(spark, sf_dir), BERLIN).filter((F.col("sod") >= 25_200) & (F.col("sod") < 72_000))
    got = table(spark, sf_dir, "recovery_extract").filter(L.valid(F.col("laeq"))).select("messstelle", F.col("sekunde").alias("second")).distinct().withColumn("da", F.lit(True))
    j = t.join(got, ["messstelle", "second"], "left")
    already, hit = F.col("status") == "PCE", F.coalesce("da", F.lit(False))
    d = j.groupBy("messstelle", "tag").agg(F.count_if(already).alias("bereits"), F.count_if(~already).alias("ziel"), F.count_if(~already & hit).alias("gerettet"))
    return d.select("*", (F.col("ziel") - F.col("gerettet")).alias("rest"), F.bround((F.col("bereits") + F.col("gerettet")) / L.DAY_SECONDS, 4).alias("abdeckung"))


def stratified_sample(spark, sf_dir):
    """Up to 20 recovered rows per station and day, by a seeded hash: T-05."""
    s = S.with_local(table(spark, sf_dir, "recovery_extract").select("messstelle", "satz_id", F.col("sekunde").alias("second")), BERLIN)
    return R.stratified_sample(s, ["messstelle", "tag"], "satz_id", 20, 42).select("messstelle", "tag", "satz_id")


QUERIES = {
    f.__name__: f
    for f in (mixed_window_check, mixed_window_check_3db, pure_window_check, reconstruct_energy, modal_gap, target_inherit, window_status_lookup, daily_balance, stratified_sample)
}
_P = """p AS (SELECT messstelle, "at" // 10000 * 10000 AS start_ms, count(*) FILTER (source = 'PCE_323') AS np, count(*) FILTER (source = 'MIKROFON') AS nm,
    coalesce(sum(pow(10, levelDb / 10)) FILTER (source = 'PCE_323'), 0) AS ep, coalesce(sum(pow(10, levelDb / 10)) FILTER (source = 'MIKROFON'), 0) AS em
    FROM level_samples WHERE levelDb > 0 AND levelDb <= 160 AND source IN ('PCE_323', 'MIKROFON') GROUP BY ALL)"""
_CHECK = """x AS (SELECT w.*, p.nm, p.em, {n} AS n, round(CASE WHEN {n} > 0 THEN 10 * log10({e} / {n}) END - leq, 9) AS delta FROM w LEFT JOIN p USING (messstelle, start_ms) WHERE quelle = '{q}'),
    c AS (SELECT *, CASE WHEN delta IS NULL THEN 'NICHT_PRUEFBAR' WHEN abs(delta) <= {tol} THEN 'BESTAETIGT' ELSE 'KONFLIKT' END AS status FROM x)"""
_MIX = _CHECK.format(n="(coalesce(np, 0) + coalesce(nm, 0))", e="(ep + em)", q="GEMISCHT", tol="0.15")
_MIX3 = _CHECK.format(n="(coalesce(np, 0) + coalesce(nm, 0))", e="(ep + em)", q="GEMISCHT", tol="3.0")
_PURE = _CHECK.format(n="coalesce(np, 0)", e="ep", q="PCE_323", tol="0.15")
_ST = "CASE WHEN Samples > 0 AND quelle IN ('PCE_323', 'GEMISCHT', 'MIKROFON') THEN replace(quelle, 'PCE_323', 'PCE') ELSE 'FEHLT' END"
_TG = f"""{_W}, q AS (SELECT messstelle, start_ms, {_ST} AS status, unnest(range(CAST(ceil(start_ms / 1000) AS BIGINT), CAST(ceil((start_ms + 10000) / 1000) AS BIGINT))) AS second FROM w),
    z AS (SELECT messstelle, second, arg_max(status, start_ms) AS status FROM q GROUP BY ALL)"""
SQL = {
    "mixed_window_check": f"WITH {_W}, {_P}, {_MIX} SELECT messstelle, start_ms, status, round(delta, 6) AS delta, CAST(n AS BIGINT) AS n_proben, CASE WHEN delta IS NOT NULL THEN n = Samples END AS gleich FROM c",
    "mixed_window_check_3db": f"WITH {_W}, {_P}, {_MIX3} SELECT messstelle, status, count(*) AS fenster, count(*) FILTER (delta IS NOT NULL AND n = Samples) AS gleich FROM c GROUP BY ALL",
    "pure_window_check": f"WITH {_W}, {_P}, {_PURE} SELECT messstelle, status, count(*) AS fenster, count(*) FILTER (delta IS NOT NULL AND n = Samples) AS gleich FROM c GROUP BY ALL",
    "reconstruct_energy": f"""WITH {_W}, {_P}, {_MIX}, r AS (SELECT *, leq IS NOT NULL AND nm > 0 AND Samples - nm > 0 AS ok FROM c),
        f AS (SELECT *, Samples * pow(10, leq / 10) - em AS m, Samples * pow(10, (leq - 0.05) / 10) - em AS u, Samples * pow(10, (leq + 0.05) / 10) - em AS o, Samples - nm AS k FROM r)
        SELECT messstelle, start_ms, CASE WHEN NOT coalesce(ok, false) THEN 'NICHT_BERECHENBAR' WHEN m <= 0 THEN 'UNMOEGLICH' ELSE 'BERECHNET' END AS ergebnis,
        CASE WHEN ok AND m > 0 THEN round(10 * log10(m / k), 6) END AS mitte, CASE WHEN ok AND u > 0 THEN round(10 * log10(u / k), 6) END AS unten, CASE WHEN ok AND o > 0 THEN round(10 * log10(o / k), 6) END AS oben FROM f""",
    "modal_gap": f"""WITH {_W}, d AS (SELECT messstelle, start_ms - lag(start_ms) OVER (PARTITION BY messstelle ORDER BY start_ms) AS d FROM w),
        c AS (SELECT messstelle, d, count(*) AS n FROM d WHERE d > 0 GROUP BY ALL) SELECT messstelle, greatest(1, CAST(round(arg_min(d, row(-n, d)) / 1000) AS BIGINT)) AS fenster_s FROM c GROUP BY messstelle""",
    "target_inherit": f"""WITH {_TG} SELECT messstelle, count(*) FILTER (status = 'PCE') AS pce, count(*) FILTER (status = 'GEMISCHT') AS gemischt, count(*) FILTER (status = 'MIKROFON') AS mikrofon,
        count(*) FILTER (status = 'FEHLT') AS fehlt FROM z GROUP BY messstelle""",
    "window_status_lookup": f"WITH {_TG} SELECT r.messstelle, z.status, count(*) AS saetze FROM recovery_extract r LEFT JOIN z ON z.messstelle = r.messstelle AND z.second = r.sekunde GROUP BY ALL",
    "daily_balance": f"""WITH {_TG}, g AS (SELECT DISTINCT messstelle, sekunde AS second FROM recovery_extract WHERE laeq > 0 AND laeq <= 160),
        j AS (SELECT z.*, g.second IS NOT NULL AS da, CAST(timezone('Europe/Berlin', to_timestamp(z.second)) AS DATE) AS tag, CAST(epoch(timezone('Europe/Berlin', to_timestamp(z.second))) AS BIGINT) % 86400 AS sod FROM z LEFT JOIN g USING (messstelle, second)),
        d AS (SELECT messstelle, tag, count(*) FILTER (status = 'PCE') AS bereits, count(*) FILTER (status <> 'PCE') AS ziel, count(*) FILTER (status <> 'PCE' AND da) AS gerettet FROM j WHERE sod >= 25200 AND sod < 72000 GROUP BY ALL)
        SELECT *, ziel - gerettet AS rest, round_even((bereits + gerettet) / 46800, 4) AS abdeckung FROM d""",
    "stratified_sample": """SELECT messstelle, CAST(timezone('Europe/Berlin', to_timestamp(sekunde)) AS DATE) AS tag, satz_id FROM recovery_extract
        QUALIFY row_number() OVER (PARTITION BY messstelle, tag ORDER BY md5(satz_id || ':42'), satz_id) <= 20""",
}
