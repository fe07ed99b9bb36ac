"""Selection, merging, labels and episodes over the evidence tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pegelwerk.functions import levels as L
from pegelwerk.operators import seconds as S
from pegelwerk.operators import select as C
from pegelwerk.operators import votes as V
from pegelwerk.queries.levels import r6
from pegelwerk.sources.tables import finite, table

#: Old names of labels; fixed values.
ALIAS = {"Tiefbohrer": "Bohrgeraet/schweres Geraet"}
ALIAS_SQL = "CASE {0} WHEN 'Tiefbohrer' THEN 'Bohrgeraet/schweres Geraet' ELSE {0} END"
#: Extraction methods by trust; fixed values. Other methods come last.
METHODS = {"DB_INTAKT": 0, "GERAETEEXPORT": 0, "WAL": 1, "RECOVER": 2, "CARVING": 3}


def _by_table(spark, sf_dir, name):
    r = table(spark, sf_dir, "recovery_extract").filter(F.col("tabelle") == name)
    return S.merge_seconds(r, ["messstelle"], "sekunde", "laeq", "lmax").select("messstelle", "second", "leq", F.lit(name).alias("herkunft"))


_T = """m AS (SELECT messstelle, sekunde AS second, tabelle, 10 * log10(avg(pow(10, laeq / 10))) AS leq FROM recovery_extract WHERE laeq > 0 AND laeq <= 160 GROUP BY ALL),
    a AS (SELECT * FROM m WHERE tabelle = 'level_samples'), b AS (SELECT * FROM m WHERE tabelle = 'measurements')"""


def priority_union(spark, sf_dir):
    u = C.priority_union(_by_table(spark, sf_dir, "level_samples"), _by_table(spark, sf_dir, "measurements"), ["messstelle", "second"])
    return u.groupBy("messstelle", "herkunft").agg(F.count(F.lit(1)).alias("sekunden"), L.laeq(F.col("leq")).alias("laeq")).select("messstelle", "herkunft", "sekunden", r6("laeq"))


def overlap_audit(spark, sf_dir):
    return C.overlap_audit(_by_table(spark, sf_dir, "level_samples"), _by_table(spark, sf_dir, "measurements"), ["messstelle", "second"], "leq")


def _windows(spark, sf_dir):
    """alt_export with its instant, source and level; one row per window: the last export."""
    a = table(spark, sf_dir, "alt_export")
    t = F.unix_millis(F.trim("Zeit").try_cast("timestamp"))
    rows = a.select("messstelle", t.alias("start_ms"), F.upper(F.trim("Quelle")).alias("quelle"), F.col("LAeq_dB").alias("leq"), "Samples", "exportiert_ms", "satz_id")
    return C.first_per_key(rows.dropna(subset=["start_ms"]), ["messstelle", "start_ms"], [F.desc_nulls_last("exportiert_ms"), F.asc("satz_id")])


_W = """w AS (SELECT messstelle, epoch_ms(TRY_CAST(trim(Zeit) AS TIMESTAMPTZ)) AS start_ms, upper(trim(Quelle)) AS quelle, LAeq_dB AS leq, Samples, exportiert_ms, satz_id FROM alt_export
    WHERE TRY_CAST(trim(Zeit) AS TIMESTAMPTZ) IS NOT NULL QUALIFY row_number() OVER (PARTITION BY messstelle, start_ms ORDER BY exportiert_ms DESC NULLS LAST, satz_id) = 1)"""


def _tens(spark, sf_dir):
    """level_samples of the meter in windows of ten seconds."""
    s = table(spark, sf_dir, "level_samples").filter((F.col("source") == "PCE_323") & L.valid(F.col("levelDb")))
    return s.groupBy("messstelle", (F.floor(F.col("at") / 10_000) * 10_000).alias("start_ms")).agg(L.laeq(F.col("levelDb")).alias("leq"))


_TEN = """t AS (SELECT messstelle, "at" // 10000 * 10000 AS start_ms, 10 * log10(avg(pow(10, levelDb / 10))) AS leq FROM level_samples WHERE source = 'PCE_323' AND levelDb > 0 AND levelDb <= 160 GROUP BY ALL)"""


def mixed_replacement(spark, sf_dir):
    w = _windows(spark, sf_dir).select("messstelle", "start_ms", "quelle", "leq")
    out = C.replace_mixed(w, _tens(spark, sf_dir), ["messstelle", "start_ms"], "quelle", "leq", "PCE_323", "GEMISCHT")
    return out.select("messstelle", "start_ms", "quelle", r6("leq"), "ersetzt", r6("delta"))


def supplement_anti(spark, sf_dir):
    """Ten-second windows that only the samples have."""
    return _tens(spark, sf_dir).join(_windows(spark, sf_dir).select("messstelle", "start_ms"), ["messstelle", "start_ms"], "left_anti").select("messstelle", "start_ms", r6("leq"))


def merge_priority_conflict(spark, sf_dir):
    """Best candidate per second, confirmations, conflicts and cross checks: W-17, W-18."""
    r = table(spark, sf_dir, "recovery_extract").filter(L.valid(F.col("laeq")))
    names = F.create_map(*[F.lit(x) for kv in METHODS.items() for x in kv])
    rank = F.coalesce(F.try_element_at(names, F.upper(F.trim("methode"))), F.lit(9))
    m = C.merge_by_priority(r.select("messstelle", "sekunde", "laeq", "tabelle", "sha256", "satz_id", rank.alias("_r")), ["messstelle", "sekunde"], "laeq", ["_r", "tabelle", "sha256", "satz_id"], "tabelle")
    label = F.when(F.col("konflikt"), "KONFLIKT_QUELLEN").when(F.col("querpruefung"), "QUERPRUEFUNG_2_TABELLEN").otherwise("UNGEPRUEFT")
    return m.filter(F.col("konflikt") | (F.col("rang") == 1)).select("messstelle", "sekunde", "satz_id", "laeq", F.col("rang").cast("long").alias("rang"), F.when(F.col("konflikt"), 0).otherwise(F.col("gleiche")).cast("long").alias("weitere"), label.alias("validierung"))


def _events(spark, sf_dir):
    """One row per WAV with the last filled fields; labels by precedence."""
    e = table(spark, sf_dir, "relevante_ereignisse")
    label = V.renamed(V.precedence("Laermquelle_geprueft", "Laermquelle_KI", "Laermquelle_Auto"), ALIAS)
    first = C.first_per_key(e.withColumn("dBA", finite(F.col("dBA"))), ["WAV"], [F.asc("Timestamp_ms"), F.desc_nulls_last("dBA"), F.desc_nulls_last("Laermquelle_KI"), F.desc_nulls_last("Laermquelle_Auto"), F.desc_nulls_last("Laermquelle_geprueft")])
    return first.select("messstelle", "WAV", "Datum", "Timestamp_ms", "dBA", label.alias("label"))


_E = f"""e0 AS (SELECT *, CASE WHEN isnan(dBA) THEN NULL ELSE dBA END AS d FROM relevante_ereignisse),
    e AS (SELECT messstelle, WAV, Datum, Timestamp_ms, d AS dBA, {ALIAS_SQL.format("coalesce(nullif(trim(Laermquelle_geprueft), ''), nullif(trim(Laermquelle_KI), ''), nullif(trim(Laermquelle_Auto), ''))")} AS label
    FROM e0 QUALIFY row_number() OVER (PARTITION BY WAV ORDER BY Timestamp_ms NULLS FIRST, d DESC NULLS LAST, Laermquelle_KI DESC NULLS LAST, Laermquelle_Auto DESC NULLS LAST, Laermquelle_geprueft DESC NULLS LAST) = 1)"""


def source_precedence(spark, sf_dir):
    return _events(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("clips"), L.laeq(F.col("dBA")).alias("laeq"), F.max("dBA").alias("lmax")).select("label", "clips", r6("laeq"), "lmax")


def weighted_vote(spark, sf_dir):
    return V.weighted_vote(_events(spark, sf_dir), ["messstelle", "Datum"], "label", "dBA", 1.0).select("messstelle", "Datum", "label", r6("anteil"))


def vote_shares(spark, sf_dir):
    return V.weighted_vote(_events(spark, sf_dir), ["messstelle"], "label", "dBA", 0.0).select("messstelle", "anteile")


def bin_dominant(spark, sf_dir):
    """Ten-minute bins with dominant label: W-14."""
    e = _events(spark, sf_dir).filter(F.col("Timestamp_ms").isNotNull()).withColumn("bin", F.floor(F.col("Timestamp_ms") / 600_000))
    return V.weighted_vote(e, ["messstelle", "bin"], "label", "dBA", 0.0).select("messstelle", "bin", "label")


def bin_share(spark, sf_dir):
    """Share of each station's bins that a label dominates: A-18."""
    from pyspark.sql import Window

    b = bin_dominant(spark, sf_dir).groupBy("messstelle", "label").agg(F.count(F.lit(1)).alias("bins"))
    return b.select("messstelle", "label", "bins", F.round(F.col("bins") / F.sum("bins").over(Window.partitionBy("messstelle")), 6).alias("anteil"))


def _episodes(spark, sf_dir):
    e = _events(spark, sf_dir).filter(F.col("Timestamp_ms").isNotNull())
    return V.episodes(e, ["messstelle", "Datum"], "Timestamp_ms", 120_000)


def episodes(spark, sf_dir):
    x, key = F.col("dBA"), ["messstelle", "Datum", "episode"]
    loud = F.min(F.struct((-F.coalesce("dBA", F.lit(0.0))).alias("v"), "Timestamp_ms", "WAV"))
    d = _episodes(spark, sf_dir).groupBy(*key).agg(
        F.min("Timestamp_ms").alias("start_ms"), F.max("Timestamp_ms").alias("ende_ms"), F.count(F.lit(1)).alias("ereignisse"), F.max("dBA").alias("spitze"),
        F.avg(F.coalesce(x, F.lit(0.0))).alias("mittel"), L.laeq(x).alias("leq"), loud.alias("l"),
    )
    vote = V.weighted_vote(_episodes(spark, sf_dir), key, "label", "dBA", 0.0).select(*key, "label")
    return d.join(vote, key, "left").select(*key, "start_ms", "ende_ms", "ereignisse", "spitze", r6("mittel"), r6("leq"), F.col("l.WAV").alias("lautester"), "label")


def top6_per_day(spark, sf_dir):
    order = [F.desc(F.coalesce("dBA", F.lit(0.0))), F.asc("Timestamp_ms"), F.asc("WAV")]
    return V.top_per_group(_events(spark, sf_dir).filter(F.col("Timestamp_ms").isNotNull()), ["messstelle", "Datum"], order, 6).select("messstelle", "Datum", F.col("rang").cast("long").alias("rang"), "WAV", "dBA")


def label_import(spark, sf_dir):
    """Checked labels of later copies fill blank ones: J-25."""
    e = table(spark, sf_dir, "relevante_ereignisse")
    new = e.filter(F.trim("Laermquelle_geprueft") != "").groupBy("WAV").agg(F.min("Laermquelle_geprueft").alias("neu"))
    return C.fill_only(e.select("WAV", "Laermquelle_geprueft"), new, "WAV", "Laermquelle_geprueft", "neu").groupBy("Laermquelle_geprueft").agg(F.count(F.lit(1)).alias("zeilen"))


def label_update(spark, sf_dir):
    """Automatic labels replaced by the station's dominant one from a date on; manual labels win: J-26."""
    e = _events(spark, sf_dir).join(table(spark, sf_dir, "relevante_ereignisse").groupBy("WAV").agg(F.max(F.nullif(F.trim("Laermquelle_geprueft"), F.lit(""))).alias("hand")), "WAV")
    new = V.weighted_vote(_events(spark, sf_dir), ["messstelle"], "label", "dBA", 0.0).select("messstelle", F.col("label").alias("neu"))
    out = C.guarded_update(e, new, "messstelle", "label", "hand", "neu", F.col("Datum") >= "2024-01-01")
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("clips"), F.count_if("konflikt").alias("konflikte"))


_EP = f"""{_E}, l AS (SELECT *, coalesce(Timestamp_ms - lag(Timestamp_ms) OVER (PARTITION BY messstelle, Datum ORDER BY Timestamp_ms, WAV) > 120000, true) AS neu FROM e WHERE Timestamp_ms IS NOT NULL),
    p AS (SELECT *, CAST(sum(neu::INT) OVER (PARTITION BY messstelle, Datum ORDER BY Timestamp_ms, WAV) AS BIGINT) AS episode FROM l)"""


def _vote(frm: str, keys: str, missing: float) -> str:
    return f"""(SELECT {keys}, arg_min(label, row(-s, label)) AS label, max(s) / sum(s) AS anteil FROM (SELECT {keys}, label, round(sum(coalesce(dBA, {missing})), 6) AS s FROM {frm} WHERE label IS NOT NULL GROUP BY ALL) GROUP BY {keys})"""


QUERIES = {
    f.__name__: f
    for f in (
        priority_union, overlap_audit, mixed_replacement, supplement_anti, merge_priority_conflict, source_precedence, weighted_vote, vote_shares,
        bin_dominant, bin_share, episodes, top6_per_day, label_import, label_update,
    )
}
_RANK = "CASE upper(trim(methode)) WHEN 'DB_INTAKT' THEN 0 WHEN 'GERAETEEXPORT' THEN 0 WHEN 'WAL' THEN 1 WHEN 'RECOVER' THEN 2 WHEN 'CARVING' THEN 3 ELSE 9 END"
SQL = {
    "priority_union": f"""WITH {_T}, u AS (SELECT messstelle, second, leq, tabelle FROM a UNION ALL SELECT messstelle, second, leq, tabelle FROM b ANTI JOIN a USING (messstelle, second))
        SELECT messstelle, tabelle AS herkunft, count(*) AS sekunden, round(10 * log10(avg(pow(10, leq / 10))), 6) AS laeq FROM u GROUP BY ALL""",
    "overlap_audit": f"""WITH {_T}, d AS (SELECT abs(a.leq - b.leq) AS d FROM a JOIN b USING (messstelle, second))
        SELECT count(*) AS gemeinsam, count(*) FILTER (d <= 0.15) AS gleich, count(*) FILTER (d > 0.15) AS konflikte, round(max(d), 3) AS groesste FROM d""",
    "mixed_replacement": f"""WITH {_W}, {_TEN} SELECT w.messstelle, w.start_ms, quelle, round(CASE WHEN quelle = 'GEMISCHT' THEN t.leq ELSE w.leq END, 6) AS leq,
        quelle = 'GEMISCHT' AS ersetzt, CASE WHEN quelle = 'GEMISCHT' THEN round(t.leq - w.leq, 6) END AS delta FROM w LEFT JOIN t USING (messstelle, start_ms)
        WHERE quelle = 'PCE_323' OR (quelle = 'GEMISCHT' AND t.leq IS NOT NULL)""",
    "supplement_anti": f"WITH {_W}, {_TEN} SELECT messstelle, start_ms, round(leq, 6) AS leq FROM t ANTI JOIN w USING (messstelle, start_ms)",
    "merge_priority_conflict": f"""WITH r AS (SELECT *, {_RANK} AS r FROM recovery_extract WHERE laeq > 0 AND laeq <= 160),
        b AS (SELECT *, row_number() OVER o AS rang, first_value(laeq) OVER o AS best, first_value(tabelle) OVER o AS bt FROM r WINDOW o AS (PARTITION BY messstelle, sekunde ORDER BY r, tabelle, sha256, satz_id)),
        n AS (SELECT *, abs(laeq - best) <= 0.15 AND rang > 1 AS nah, abs(laeq - best) > 0.15 AND rang > 1 AS fern FROM b),
        c AS (SELECT *, count(*) FILTER (nah) OVER v AS gleiche, count(*) FILTER (fern) OVER v > 0 AS konflikt, count(*) FILTER (nah AND tabelle <> bt) OVER v > 0 AS quer FROM n WINDOW v AS (PARTITION BY messstelle, sekunde))
        SELECT messstelle, sekunde, satz_id, laeq, rang, CASE WHEN konflikt THEN 0 ELSE gleiche END AS weitere,
        CASE WHEN konflikt THEN 'KONFLIKT_QUELLEN' WHEN quer THEN 'QUERPRUEFUNG_2_TABELLEN' ELSE 'UNGEPRUEFT' END AS validierung FROM c WHERE konflikt OR rang = 1""",
    "source_precedence": f"WITH {_E} SELECT label, count(*) AS clips, round(10 * log10(avg(pow(10, dBA / 10))), 6) AS laeq, max(dBA) AS lmax FROM e GROUP BY label",
    "weighted_vote": f"WITH {_E} SELECT messstelle, Datum, label, round(anteil, 6) AS anteil FROM {_vote('e', 'messstelle, Datum', 1.0)}",
    "vote_shares": f"""WITH {_E}, s AS (SELECT messstelle, label, round(sum(coalesce(dBA, 0)), 6) AS s FROM e WHERE label IS NOT NULL GROUP BY ALL), t AS (SELECT *, round(sum(s) OVER (PARTITION BY messstelle), 6) AS t FROM s)
        SELECT messstelle, string_agg(label || ' ' || CAST(floor(round(100 * s / t, 6) + 0.5) AS BIGINT) || '%', ', ' ORDER BY s DESC, label) AS anteile FROM t GROUP BY messstelle""",
    "bin_dominant": f"WITH {_E}, b AS (SELECT *, Timestamp_ms // 600000 AS bin FROM e WHERE Timestamp_ms IS NOT NULL) SELECT messstelle, bin, label FROM {_vote('b', 'messstelle, bin', 0.0)}",
    "bin_share": f"""WITH {_E}, b AS (SELECT *, Timestamp_ms // 600000 AS bin FROM e WHERE Timestamp_ms IS NOT NULL), d AS (SELECT messstelle, bin, label FROM {_vote('b', 'messstelle, bin', 0.0)}),
        n AS (SELECT messstelle, label, count(*) AS bins FROM d GROUP BY ALL) SELECT messstelle, label, bins, round(bins / sum(bins) OVER (PARTITION BY messstelle), 6) AS anteil FROM n""",
    "episodes": f"""WITH {_EP}, v AS (SELECT * FROM {_vote('p', 'messstelle, Datum, episode', 0.0)}),
        d AS (SELECT messstelle, Datum, episode, min(Timestamp_ms) AS start_ms, max(Timestamp_ms) AS ende_ms, count(*) AS ereignisse, max(dBA) AS spitze, round(avg(coalesce(dBA, 0)), 6) AS mittel,
            round(10 * log10(avg(pow(10, dBA / 10))), 6) AS leq, arg_min(WAV, row(-coalesce(dBA, 0), Timestamp_ms, WAV)) AS lautester FROM p GROUP BY ALL)
        SELECT d.*, v.label FROM d LEFT JOIN v USING (messstelle, Datum, episode)""",
    "top6_per_day": f"""WITH {_E} SELECT messstelle, Datum, row_number() OVER (PARTITION BY messstelle, Datum ORDER BY coalesce(dBA, 0) DESC, Timestamp_ms, WAV) AS rang, WAV, dBA FROM e WHERE Timestamp_ms IS NOT NULL QUALIFY rang <= 6""",
    "label_import": """WITH n AS (SELECT WAV, min(Laermquelle_geprueft) AS neu FROM relevante_ereignisse WHERE trim(Laermquelle_geprueft) <> '' GROUP BY WAV)
        SELECT coalesce(nullif(trim(Laermquelle_geprueft), ''), nullif(trim(neu), '')) AS Laermquelle_geprueft, count(*) AS zeilen FROM relevante_ereignisse LEFT JOIN n USING (WAV) GROUP BY 1""",
    "label_update": f"""WITH {_E}, h AS (SELECT WAV, max(nullif(trim(Laermquelle_geprueft), '')) AS hand FROM relevante_ereignisse GROUP BY WAV), v AS (SELECT messstelle, label AS neu FROM {_vote('e', 'messstelle', 0.0)})
        SELECT CASE WHEN Datum >= DATE '2024-01-01' AND neu IS NOT NULL AND hand IS NULL THEN neu ELSE label END AS label, count(*) AS clips,
        count(*) FILTER (Datum >= DATE '2024-01-01' AND hand IS NOT NULL AND hand <> neu) AS konflikte FROM e JOIN h USING (WAV) LEFT JOIN v USING (messstelle) GROUP BY 1""",
}
