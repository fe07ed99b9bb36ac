"""Day reports: provenance, validation, phase sources, bin colours, coverage texts, counters and calendars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pegelwerk.functions import levels as L
from pegelwerk.functions import text as T
from pegelwerk.functions import vectors as X
from pegelwerk.operators import intervals as V
from pegelwerk.operators import recovery as R
from pegelwerk.operators import seconds as S
from pegelwerk.operators import select as C
from pegelwerk.operators import votes as O
from pegelwerk.operators.instants import _whole, local_day, utc_to_wall
from pegelwerk.queries.events import _E, _W, METHODS, _events
from pegelwerk.queries.intervals import _EXCL, _RUNS, _SESS, _SPANS, _exclusions, _phases, _sessions, quiet_spans_60
from pegelwerk.queries.labels import _IN, SITE
from pegelwerk.queries.levels import BERLIN, KEYS, SECONDS, r6, seconds
from pegelwerk.queries.recovery import _MIX, _P, _PURE, _checked
from pegelwerk.queries.weather import SQL as _WEATHER
from pegelwerk.queries.weather import ab_sensitivity
from pegelwerk.sources.tables import table


def merged_seconds_full(spark, sf_dir):
    """One record per second with its provenance: A-02."""
    rows = table(spark, sf_dir, "recovery_extract")
    m = S.merge_full(rows, ["messstelle"], "sekunde", "laeq", "lmax", "tabelle", ["methode", "datei", "runde", "lmin"], "satz_id")
    return m.select("messstelle", "second", r6("leq"), "maximum", "n", "quelle", "methode", "datei", "runde", "lmin")


def merge_validation(spark, sf_dir):
    """How the best row of each second is confirmed: conflict of sources, its window's check, another table: W-18."""
    r = table(spark, sf_dir, "recovery_extract").filter(L.valid(F.col("laeq")))
    names = F.create_map(*[F.lit(x) for kv in METHODS.items() for x in kv])
    rank = F.coalesce(F.try_element_at(names, F.upper(F.trim("methode"))), F.lit(9))
    m = C.merge_by_priority(r.select("messstelle", "sekunde", "laeq", "tabelle", "sha256", "satz_id", rank.alias("_r")), ["messstelle", "sekunde"], "laeq", ["_r", "tabelle", "sha256", "satz_id"], "tabelle")
    w = _checked(spark, sf_dir, "GEMISCHT", False).withColumn("art", F.lit("4A")).unionByName(_checked(spark, sf_dir, "PCE_323", True).withColumn("art", F.lit("PCE_CSV")))
    known = R.inherit(w, ["messstelle"], F.concat_ws("_", "status", "art"), 10, "start_ms").select("messstelle", F.col("second").alias("sekunde"), "status")
    best = m.filter(F.col("konflikt") | (F.col("rang") == 1)).join(known, ["messstelle", "sekunde"], "left")
    return best.groupBy("messstelle", C.validation("konflikt", "querpruefung", "tabelle", "status").alias("validierung")).agg(F.count(F.lit(1)).alias("saetze"))


def relevant_events(spark, sf_dir):
    """Events from 60 dB on with an instant, in the columns that go on: F-06, F-12."""
    e = _events(spark, sf_dir).filter((F.col("dBA") >= 60) & F.col("Timestamp_ms").isNotNull())
    path = F.concat_ws("/", F.lit("relevante_wavs"), F.col("Datum").cast("string"), "WAV")
    return e.select("messstelle", "Datum", "Timestamp_ms", F.round("dBA", 1).alias("dBA"), "WAV", path.alias("WAV_Pfad"))


def rule_in_force(spark, sf_dir):
    """Days of loud even noise, and whether the rule for them was in force then: F-08."""
    q = quiet_spans_60(spark, sf_dir).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("spannen"))
    return q.withColumn("in_kraft", L.in_force(F.col("tag"), "2026-06-08", "2026-07-19"))


def _labels(spark, sf_dir) -> DataFrame:
    """Clips with second, current label (checked or by the model) and the older automatic one."""
    e = table(spark, sf_dir, "relevante_ereignisse").filter(F.col("Timestamp_ms").isNotNull())
    text = lambda c: F.max(F.nullif(F.trim(c), F.lit("")))
    k = e.groupBy("WAV").agg(
        F.min("messstelle").alias("messstelle"), F.min(_whole(F.col("Timestamp_ms"), 1000)).alias("second"), F.max("dBA").alias("dba"),
        text("Laermquelle_geprueft").alias("hand"), text("Laermquelle_KI").alias("ki"), text("Laermquelle_Auto").alias("auto"),
    )
    return k.select("messstelle", "second", "dba", "hand", F.coalesce("hand", "ki").alias("neu"), F.col("auto").alias("alt"))


def _phase_labels(spark, sf_dir) -> DataFrame:
    """Every phase with its source: the dominant current label, else what the automatic labels gave; a checked label is kept beside it."""
    key = ["messstelle", "tag", "schwelle", "minuten", "begin", "end"]
    p = _phases(spark, sf_dir).drop("punkte")
    inside = V.points_in(_labels(spark, sf_dir), p, ["messstelle"], "second")
    vote = lambda c: O.weighted_vote(inside, key, c, "dba", 1.0).select(*key, "label")
    hand = inside.groupBy(*key).agg(F.min("hand").alias("geprueft"))
    return O.fallback(p, vote("neu"), vote("alt"), key, "label").join(hand, key, "left")


def phase_sources(spark, sf_dir):
    """J-29."""
    return _phase_labels(spark, sf_dir).select("messstelle", "schwelle", "minuten", "begin", F.coalesce("label", F.lit("—")).alias("label"), "uebernommen", "geprueft")


def bin_colours(spark, sf_dir):
    """What a ten-minute bin shows: its dominant site label, else the phase's source, else an even loud span, else other noise or nothing known by its level: W-15."""
    s = seconds(spark, sf_dir).groupBy("messstelle", _whole(F.col("second"), 600).alias("bin")).agg(F.round(L.laeq(F.col("leq")), 9).alias("l"))
    e = _events(spark, sf_dir).filter(F.col("Timestamp_ms").isNotNull()).withColumn("bin", _whole(F.col("Timestamp_ms"), 600_000))
    dominant = O.weighted_vote(e.filter(F.col("label").isin(SITE)), ["messstelle", "bin"], "label", "dBA", 0.0).select("messstelle", "bin", "label")
    some = e.select("messstelle", "bin").distinct().withColumn("da", F.lit(True))
    p = _phase_labels(spark, sf_dir).select("messstelle", "begin", "end", "schwelle", "minuten", F.col("label").alias("phase"))
    middle = V.points_in(s.select("messstelle", "bin", (F.col("bin") * 600 + 300).alias("mitte")), p, ["messstelle"], "mitte")
    last = middle.groupBy("messstelle", "bin").agg(F.max_by("phase", F.struct("begin", "schwelle", "minuten")).alias("phase"))
    q = quiet_spans_60(spark, sf_dir).select("messstelle", "begin", "end")
    b = s.select("messstelle", "bin", (F.col("bin") * 600).alias("begin"), (F.col("bin") * 600 + 600).alias("end"))
    span = V.overlaps(b, q, ["messstelle"]).select("messstelle", "bin").distinct().withColumn("eben", F.lit(True))
    on = ["messstelle", "bin"]
    j = s.join(dominant, on, "left").join(some, on, "left").join(last, on, "left").join(span, on, "left")
    quiet = F.when(F.col("l") <= 60, "anderes").otherwise("unbestimmt")
    colour = (
        F.when(F.col("label").isNotNull(), F.col("label"))
        .when(F.col("phase").isin(SITE), F.col("phase"))
        .when(F.col("eben"), "Bohrgeraet/schweres Geraet")
        .when(F.col("phase").isNotNull() | F.col("da"), quiet)
        .otherwise("unbestimmt")
    )
    return j.groupBy("messstelle", colour.alias("farbe")).agg(F.count(F.lit(1)).alias("bins"))


def phase_counters(spark, sf_dir):
    """Phases per day, and those of the main criterion: A-19."""
    p = _phases(spark, sf_dir)
    return p.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("gesamt"), F.count_if((F.col("schwelle") == 60) & (F.col("minuten") == 10)).alias("ab60_10"))


def sorted_phases(spark, sf_dir):
    """Phases of a day by begin, then in the criteria's own order: T-06."""
    order = F.when(F.col("schwelle") == 70, 0).when(F.col("schwelle") == 65, 1).when(F.col("minuten") == 10, 2).otherwise(3)
    w = Window.partitionBy(*KEYS).orderBy("begin", order)
    return _phases(spark, sf_dir).select(*KEYS, "begin", "schwelle", "minuten", F.row_number().over(w).cast("long").alias("zeile"))


def file_day_modal(spark, sf_dir):
    """A file's day is the most common local day of its rows: A-32."""
    r = table(spark, sf_dir, "recovery_extract").filter(F.col("datei").isNotNull() & F.col("sekunde").isNotNull())
    n = r.groupBy("datei", local_day(F.col("sekunde") * 1000, BERLIN).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy("datei").agg(F.min(F.struct((-F.col("n")).alias("n"), "d")).alias("b"), F.count(F.lit(1)).alias("tage"))
    return best.select("datei", F.date_from_unix_date("b.d").alias("tag"), "tage")


def ab_totals(spark, sf_dir):
    """Both variants in one line each: days, days well covered, those over 60 dB, maximum: A-41."""
    d = ab_sensitivity(spark, sf_dir)
    full = F.lit(46_800 * 0.9)
    one = lambda v: d.agg(
        F.lit(v).alias("variante"), F.count_if(F.col(f"{v}_sekunden") > 0).alias("tage"), F.count_if(F.col(f"{v}_sekunden") >= full).alias("gedeckt"),
        F.count_if((F.col(f"{v}_sekunden") >= full) & F.col(f"{v}_ueber60")).alias("ueber60"), F.max(f"{v}_laeq").alias("hoechster"),
    )
    return one("a").unionByName(one("b"))


def interval_shares(spark, sf_dir):
    """Per day the minutes of exclusions inside 07 to 20, and the share of its measured seconds in them: A-43."""
    x = _exclusions(spark, sf_dir).select(*KEYS, "begin", "end")
    s = seconds(spark, sf_dir)
    share = V.covered(s, x, KEYS, "second", "drin").groupBy(*KEYS).agg(F.avg(F.col("drin").cast("double")).alias("anteil"))
    wall = lambda c: utc_to_wall(F.col(c) * 1000, BERLIN) / 1000 - F.unix_date("tag") * 86_400
    clip = F.greatest(F.lit(0), F.least(wall("end"), F.lit(72_000)) - F.greatest(wall("begin"), F.lit(25_200)))
    minutes = x.groupBy(*KEYS).agg((F.sum(clip) / 60).alias("minuten"))
    return share.join(minutes, KEYS, "left").select(*KEYS, r6("anteil"), F.round(F.coalesce("minuten", F.lit(0.0)), 6).alias("minuten"))


def first_seen_larger(spark, sf_dir):
    """Of files with one content the larger, then the first by name: W-19."""
    i = table(spark, sf_dir, "inventar").withColumn("sha", F.nullif(F.lower(F.trim("sha256")), F.lit(""))).filter(F.col("sha").isNotNull())
    return C.first_per_key(i, ["sha"], [F.desc_nulls_last("groesse"), F.asc_nulls_last("pfad"), F.asc("satz_id")]).select("sha", "satz_id")


def keep_first_by_class(spark, sf_dir):
    """Of rows for one second the one of the better class of tables: W-20."""
    r = table(spark, sf_dir, "recovery_extract").select("messstelle", "sekunde", "tabelle", "satz_id").dropna(subset=["sekunde"])
    best = C.keep_first_class(r, ["messstelle", "sekunde"], "tabelle", ["level_samples", "measurements"], [F.asc("satz_id")])
    return best.groupBy("messstelle", "tabelle").agg(F.count(F.lit(1)).alias("sekunden"), F.sum("satz_id").alias("summe"))


def latest_file_per_day(spark, sf_dir):
    """The last changed file of each day in its name, with a warning if there were several: W-21."""
    i = table(spark, sf_dir, "inventar").withColumn("tag", T.file_day(F.col("pfad"))).filter(F.col("tag").isNotNull())
    last = F.max_by("satz_id", F.struct(F.coalesce("geaendert_utc", F.lit("")), "satz_id"))
    return i.groupBy("tag").agg(last.alias("satz_id"), F.count(F.lit(1)).alias("dateien"), (F.count(F.lit(1)) > 1).alias("warnung"))


def changed_days(spark, sf_dir):
    """Days to be made again: those of files that came, changed or went between two rounds; lost ones are marked: R-04, G-06."""
    i = table(spark, sf_dir, "inventar").filter(F.col("pfad").isNotNull())
    one = lambda k: C.first_per_key(i.filter(F.col("runde") == k), ["pfad"], [F.asc("satz_id")])
    d = C.full_compare(one(1), one(2), ["pfad"], ["groesse", "sha256"]).filter("stand <> 'same'")
    marked = d.select(F.when(F.col("stand") == "removed", F.concat(F.lit("ENTFERNT: "), "pfad")).otherwise(F.col("pfad")).alias("meldung"))
    day = T.file_day(T.changed_path(F.col("meldung")))
    return marked.groupBy(day.alias("tag")).agg(F.count(F.lit(1)).alias("dateien"), F.count_if(F.col("meldung").startswith("ENTFERNT: ")).alias("entfernt"))


def day_calendar(spark, sf_dir):
    """Every day from a station's first to its last measured one: D-03."""
    m = seconds(spark, sf_dir).groupBy("messstelle", "tag").agg(F.count(F.lit(1)).alias("sekunden"))
    days = m.groupBy("messstelle").agg(F.min("tag").alias("a"), F.max("tag").alias("z"))
    every = days.select("messstelle", F.explode(F.sequence("a", "z")).alias("tag"))
    return every.join(m, KEYS, "left").select(*KEYS, F.coalesce("sekunden", F.lit(0)).alias("sekunden"))


def coverage_labels(spark, sf_dir):
    """Text on a day's coverage with all its gaps of over two minutes: G-12."""
    clock = lambda c: F.date_format(F.from_utc_timestamp(F.timestamp_seconds(F.col(c)), BERLIN), "HH:mm")
    g = V.gaps(V.merged(_sessions(spark, sf_dir), KEYS, 0), KEYS, 120)
    text = F.concat(clock("begin"), F.lit("–"), clock("end"), F.lit(" ("), T.duration(F.col("end") - F.col("begin")), F.lit(")"))
    gaps = g.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("begin", text.alias("t")))).alias("l"))
    n = seconds(spark, sf_dir).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    share = n.join(gaps, KEYS, "left").withColumn("p", F.round(F.col("n") * 100 / L.DAY_SECONDS).cast("long").cast("string"))
    holes = F.coalesce(F.concat(F.lit(" — Lücke(n): "), F.array_join(F.transform("l", lambda x: x["t"]), "; ")), F.lit(""))
    return share.select(*KEYS, F.concat("p", F.lit("% erfasst"), holes).alias("text"))


def episode_numbers(spark, sf_dir):
    """Episodes numbered over all days and stations: W-08. Days are few, so their offsets are summed in one place."""
    e = _events(spark, sf_dir).filter(F.col("Timestamp_ms").isNotNull() & F.col("Datum").isNotNull())
    ep = O.episodes(e, ["messstelle", "Datum"], "Timestamp_ms", 120_000).groupBy("Datum", "messstelle", "episode").agg(F.count(F.lit(1)).alias("ereignisse"))
    per = ep.groupBy("Datum", "messstelle").agg(F.max("episode").alias("k"))
    before = per.withColumn("davor", F.coalesce(F.sum("k").over(Window.orderBy("Datum", "messstelle").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ep.join(before, ["Datum", "messstelle"]).select("Datum", "messstelle", (F.col("davor") + F.col("episode")).alias("nummer"), "ereignisse")


def interval_merge_day(spark, sf_dir):
    """Measuring intervals clipped to 07 to 20 and merged over two minutes: W-07."""
    day = lambda h: F.call_function("div", F.unix_millis(F.to_utc_timestamp(F.timestamp_millis(F.unix_date("tag").cast("long") * 86_400_000 + h * 3_600_000), BERLIN)), F.lit(1000).cast("long"))
    s = _sessions(spark, sf_dir).withColumns({"begin": F.greatest("begin", day(7)), "end": F.least("end", day(20))}).filter(F.col("end") > F.col("begin"))
    return V.merged(s, KEYS, 120)


def nearest_on_grid(spark, sf_dir):
    """Each minute's nearest measured second, at most a minute away: J-08."""
    n = S.nearest_on_grid(seconds(spark, sf_dir), KEYS, "second", 60)
    return n.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("minuten"), F.sum("quelle").alias("summe"), F.sum(F.abs(F.col("quelle") - F.col("minute"))).alias("abstand"))


def subset_check(spark, sf_dir):
    """Seconds left after exclusions are all measured ones, and no day has more of them: U-05."""
    s = seconds(spark, sf_dir)
    kept = V.points_in(s, _exclusions(spark, sf_dir), KEYS, "second", "left_anti")
    extra = kept.join(s.select("messstelle", "second"), ["messstelle", "second"], "left_anti").agg(F.count(F.lit(1)).alias("fremd"))
    more = s.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("a")).join(kept.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("b")), KEYS, "left")
    return extra.crossJoin(F.broadcast(more.agg(F.count_if(F.col("b") > F.col("a")).alias("mehr"), F.count(F.lit(1)).alias("tage"))))


def content_types(spark, sf_dir):
    """Types of contents by their first bytes: G-11."""
    d = table(spark, sf_dir, "documents").select(F.encode(F.col("text"), "UTF-8").alias("c"))
    m = table(spark, sf_dir, "events").select(F.encode(F.col("props"), "UTF-8").alias("c"))
    return d.unionByName(m).filter(F.col("c").isNotNull()).groupBy(T.magic(F.col("c")).alias("typ")).agg(F.count(F.lit(1)).alias("anzahl"))


def model_results(spark, sf_dir):
    """A model's answers made regular: aliases, unknown labels, confidence in bounds, short lists: N-01."""
    e = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.lit('Gern: ```json {"label": "'), F.col("event_type"), F.lit('", "confidence": '), (F.col("value") / 100).cast("string"), F.lit(', "sample_labels": ["click", "x", "view", "y"]}```')).alias("t"),
    )
    r = e.select("event_id", T.model_result(F.col("t"), ["click", "view", "kauf"], {"purchase": "kauf"}, "unklar", 3).alias("r"))
    return r.groupBy("r.label").agg(F.count(F.lit(1)).alias("anzahl"), F.round(F.sum("r.confidence"), 4).alias("summe"), F.max(F.array_join("r.sample_labels", ",")).alias("proben"))


def bin_presence(spark, sf_dir):
    """All labels of each ten-minute bin: W-14."""
    e = _events(spark, sf_dir).filter(F.col("Timestamp_ms").isNotNull() & F.col("label").isNotNull())
    return e.groupBy("messstelle", _whole(F.col("Timestamp_ms"), 600_000).alias("bin")).agg(F.array_join(F.array_sort(F.collect_set("label")), ", ").alias("labels"))


def cluster_medians(spark, sf_dir):
    """Medians of the clips' features by label: A-37."""
    e = table(spark, sf_dir, "relevante_ereignisse")
    label = O.precedence("Laermquelle_KI", "Laermquelle_Auto").alias("label")
    return e.groupBy(label).agg(F.count(F.lit(1)).alias("zeilen"), *[F.round(F.median(c), 6).alias(c) for c in ("centroid_Hz", "impuls_crest", "silbentakt", "grundton")])


def category_labels(spark, sf_dir):
    """The category with the most of a vector's positive part, or the surroundings under 0.02: N-03."""
    v = F.transform(X.doubles(F.col("embedding")), lambda x: F.greatest(x, F.lit(0.0)) / 20)
    e = table(spark, sf_dir, "embeddings").select("vec_id", X.category_sums(v, {"a": [0, 1, 2, 3], "b": [4, 5], "c": [6, 7, 8], "d": [9]}).alias("s"))
    return e.select("vec_id", X.category_label({k: F.round(f"s.{k}", 9) for k in "abcd"}, 0.02, "umgebung").alias("kategorie"))


QUERIES = {
    f.__name__: f
    for f in (
        merged_seconds_full, merge_validation, relevant_events, rule_in_force, phase_sources, bin_colours, phase_counters, sorted_phases, file_day_modal, ab_totals, interval_shares,
        first_seen_larger, keep_first_by_class, latest_file_per_day, changed_days, day_calendar, coverage_labels, episode_numbers, interval_merge_day, nearest_on_grid, subset_check,
        content_types, model_results, bin_presence, cluster_medians, category_labels,
    )
}
_LAB = """k AS (SELECT WAV, min(messstelle) AS messstelle, min(Timestamp_ms // 1000) AS second, max(dBA) AS dba, max(nullif(trim(Laermquelle_geprueft), '')) AS hand,
    max(nullif(trim(Laermquelle_KI), '')) AS ki, max(nullif(trim(Laermquelle_Auto), '')) AS alt FROM relevante_ereignisse WHERE Timestamp_ms IS NOT NULL GROUP BY WAV),
    i AS (SELECT p.messstelle, p.tag, p.schwelle, p.minuten, p."begin", p."end", k.dba, k.hand, coalesce(k.hand, k.ki) AS neu, k.alt FROM p JOIN k ON k.messstelle = p.messstelle AND k.second >= p."begin" AND k.second < p."end"),
    vn AS (SELECT messstelle, schwelle, minuten, "begin", arg_min(neu, row(-s, neu)) AS neu FROM (SELECT messstelle, schwelle, minuten, "begin", neu, round(sum(coalesce(dba, 1.0)), 6) AS s FROM i WHERE neu IS NOT NULL GROUP BY ALL) GROUP BY ALL),
    va AS (SELECT messstelle, schwelle, minuten, "begin", arg_min(alt, row(-s, alt)) AS alt FROM (SELECT messstelle, schwelle, minuten, "begin", alt, round(sum(coalesce(dba, 1.0)), 6) AS s FROM i WHERE alt IS NOT NULL GROUP BY ALL) GROUP BY ALL),
    vh AS (SELECT messstelle, schwelle, minuten, "begin", min(hand) AS geprueft FROM i GROUP BY ALL),
    pl AS (SELECT p.*, coalesce(neu, alt) AS label, neu IS NULL AND alt IS NOT NULL AS uebernommen, geprueft FROM p LEFT JOIN vn USING (messstelle, schwelle, minuten, "begin") LEFT JOIN va USING (messstelle, schwelle, minuten, "begin") LEFT JOIN vh USING (messstelle, schwelle, minuten, "begin"))"""
_Q60 = _SPANS.format(s=SECONDS, above=60, spread=2)
_LOCAL = "timezone('Europe/Berlin', to_timestamp({}))"
SQL = {
    "merged_seconds_full": """SELECT messstelle, sekunde AS second, round(10 * log10(avg(pow(10, laeq / 10))), 6) AS leq, max(CASE WHEN lmax > 0 AND lmax <= 160 THEN lmax END) AS maximum, count(*) AS n,
        CASE WHEN count(DISTINCT tabelle) = 1 AND count(tabelle) = count(*) THEN min(tabelle) ELSE 'GEMISCHT' END AS quelle, arg_min(methode, satz_id) AS methode, arg_min(datei, satz_id) AS datei,
        arg_min(runde, satz_id) AS runde, arg_min(lmin, satz_id) AS lmin FROM recovery_extract WHERE laeq > 0 AND laeq <= 160 AND sekunde IS NOT NULL GROUP BY messstelle, sekunde""",
    "merge_validation": f"""WITH {_W}, {_P}, {_MIX.replace("x AS", "mx AS").replace("FROM x)", "FROM mx)").replace("c AS (", "mc AS (")}, {_PURE.replace("x AS", "px AS").replace("FROM x)", "FROM px)").replace("c AS (", "pc AS (")},
        ws AS (SELECT messstelle, start_ms, status || '_4A' AS status FROM mc UNION ALL SELECT messstelle, start_ms, status || '_PCE_CSV' FROM pc),
        wq AS (SELECT messstelle, start_ms, status, unnest(range(CAST(ceil(start_ms / 1000) AS BIGINT), CAST(ceil((start_ms + 10000) / 1000) AS BIGINT))) AS sekunde FROM ws),
        wz AS (SELECT messstelle, sekunde, arg_max(status, start_ms) AS status FROM wq GROUP BY ALL),
        r AS (SELECT *, CASE upper(trim(methode)) WHEN 'DB_INTAKT' THEN 0 WHEN 'GERAETEEXPORT' THEN 0 WHEN 'WAL' THEN 1 WHEN 'RECOVER' THEN 2 WHEN 'CARVING' THEN 3 ELSE 9 END AS r FROM recovery_extract WHERE laeq > 0 AND laeq <= 160),
        b AS (SELECT *, row_number() OVER o AS rang, first_value(laeq) OVER o AS best, first_value(tabelle) OVER o AS bt FROM r WINDOW o AS (PARTITION BY messstelle, sekunde ORDER BY r, tabelle, sha256, satz_id)),
        n AS (SELECT *, abs(laeq - best) <= 0.15 AND rang > 1 AS nah, abs(laeq - best) > 0.15 AND rang > 1 AS fern FROM b),
        g AS (SELECT *, count(*) FILTER (fern) OVER v > 0 AS konflikt, count(*) FILTER (nah AND tabelle <> bt) OVER v > 0 AS quer FROM n WINDOW v AS (PARTITION BY messstelle, sekunde)),
        f AS (SELECT g.*, CASE WHEN tabelle = 'level_samples' AND status IN ('BESTAETIGT_4A', 'KONFLIKT_4A') THEN status WHEN tabelle = 'measurements' AND status IN ('BESTAETIGT_PCE_CSV', 'KONFLIKT_PCE_CSV') THEN status END AS fenster
            FROM g LEFT JOIN wz USING (messstelle, sekunde) WHERE konflikt OR rang = 1)
        SELECT messstelle, CASE WHEN konflikt THEN 'KONFLIKT_QUELLEN' WHEN fenster IS NOT NULL AND quer THEN fenster || '+QUERPRUEFUNG_2_TABELLEN' WHEN fenster IS NOT NULL THEN fenster
            WHEN quer THEN 'QUERPRUEFUNG_2_TABELLEN' ELSE 'UNGEPRUEFT' END AS validierung, count(*) AS saetze FROM f GROUP BY ALL""",
    "relevant_events": f"WITH {_E} SELECT messstelle, Datum, Timestamp_ms, round(dBA, 1) AS dBA, WAV, concat_ws('/', 'relevante_wavs', CAST(Datum AS VARCHAR), WAV) AS WAV_Pfad FROM e WHERE dBA >= 60 AND Timestamp_ms IS NOT NULL",
    "rule_in_force": f"SELECT messstelle, tag, count(*) AS spannen, tag BETWEEN DATE '2026-06-08' AND DATE '2026-07-19' AS in_kraft FROM ({_Q60}) q GROUP BY messstelle, tag",
    "phase_sources": f"WITH {_RUNS}, {_LAB} SELECT messstelle, schwelle, minuten, \"begin\", coalesce(label, '—') AS label, uebernommen, geprueft FROM pl",
    "bin_colours": f"""WITH {_RUNS}, {_LAB}, {_E}, b AS (SELECT messstelle, second // 600 AS bin, round(10 * log10(avg(pow(10, leq / 10))), 9) AS l FROM s GROUP BY ALL),
        eb AS (SELECT *, Timestamp_ms // 600000 AS bin FROM e WHERE Timestamp_ms IS NOT NULL),
        dm AS (SELECT messstelle, bin, arg_min(label, row(-w, label)) AS label FROM (SELECT messstelle, bin, label, round(sum(coalesce(dBA, 0.0)), 6) AS w FROM eb WHERE label IN ({_IN}) GROUP BY ALL) GROUP BY ALL),
        da AS (SELECT DISTINCT messstelle, bin, true AS da FROM eb),
        ph AS (SELECT b.messstelle, b.bin, pl.label AS phase, row_number() OVER (PARTITION BY b.messstelle, b.bin ORDER BY pl."begin" DESC, pl.schwelle DESC, pl.minuten DESC) AS n
            FROM b JOIN pl ON pl.messstelle = b.messstelle AND b.bin * 600 + 300 >= pl."begin" AND b.bin * 600 + 300 < pl."end" WHERE pl.label IS NOT NULL),
        q AS ({_Q60}), sp AS (SELECT DISTINCT b.messstelle, b.bin, true AS eben FROM b JOIN q ON q.messstelle = b.messstelle AND q."begin" < b.bin * 600 + 600 AND q."end" > b.bin * 600)
        SELECT messstelle, CASE WHEN dm.label IS NOT NULL THEN dm.label WHEN phase IN ({_IN}) THEN phase WHEN eben THEN 'Bohrgeraet/schweres Geraet' WHEN phase IS NOT NULL OR da THEN CASE WHEN l <= 60 THEN 'anderes' ELSE 'unbestimmt' END
            ELSE 'unbestimmt' END AS farbe, count(*) AS bins FROM b LEFT JOIN dm USING (messstelle, bin) LEFT JOIN da USING (messstelle, bin) LEFT JOIN (SELECT * FROM ph WHERE n = 1) ph USING (messstelle, bin) LEFT JOIN sp USING (messstelle, bin) GROUP BY ALL""",
    "phase_counters": f"WITH {_RUNS} SELECT messstelle, tag, count(*) AS gesamt, count(*) FILTER (schwelle = 60 AND minuten = 10) AS ab60_10 FROM p GROUP BY ALL",
    "sorted_phases": f"""WITH {_RUNS} SELECT messstelle, tag, "begin", schwelle, minuten, row_number() OVER (PARTITION BY messstelle, tag ORDER BY "begin", CASE WHEN schwelle = 70 THEN 0 WHEN schwelle = 65 THEN 1 WHEN minuten = 10 THEN 2 ELSE 3 END) AS zeile FROM p""",
    "file_day_modal": f"""WITH n AS (SELECT datei, CAST({_LOCAL.format("sekunde")} AS DATE) AS d, count(*) AS n FROM recovery_extract WHERE datei IS NOT NULL AND sekunde IS NOT NULL GROUP BY ALL)
        SELECT datei, arg_min(d, row(-n, d)) AS tag, count(*) AS tage FROM n GROUP BY datei""",
    "ab_totals": " UNION ALL ".join(
        f"SELECT '{v}' AS variante, count(*) FILTER ({v}_sekunden > 0) AS tage, count(*) FILTER ({v}_sekunden >= 42120) AS gedeckt, count(*) FILTER ({v}_sekunden >= 42120 AND {v}_ueber60) AS ueber60, max({v}_laeq) AS hoechster FROM ({_WEATHER['ab_sensitivity']}) z"
        for v in ("a", "b")
    ),
    "interval_shares": f"""WITH {SECONDS}, {_EXCL}, a AS (SELECT s.messstelle, s.tag, avg(CASE WHEN EXISTS (SELECT 1 FROM x WHERE x.messstelle = s.messstelle AND s.second >= x.a AND s.second < x.b) THEN 1.0 ELSE 0.0 END) AS anteil FROM s GROUP BY ALL),
        w AS (SELECT messstelle, tag, epoch({_LOCAL.format("a")}) - epoch(CAST(tag AS TIMESTAMP)) AS u, epoch({_LOCAL.format("b")}) - epoch(CAST(tag AS TIMESTAMP)) AS v FROM x),
        m AS (SELECT messstelle, tag, sum(greatest(0, least(v, 72000) - greatest(u, 25200))) / 60 AS minuten FROM w GROUP BY ALL)
        SELECT messstelle, tag, round(anteil, 6) AS anteil, round(coalesce(minuten, 0), 6) AS minuten FROM a LEFT JOIN m USING (messstelle, tag)""",
    "first_seen_larger": """SELECT sha, satz_id FROM (SELECT *, nullif(lower(trim(sha256)), '') AS sha FROM inventar) i WHERE sha IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY sha ORDER BY groesse DESC NULLS LAST, pfad ASC NULLS LAST, satz_id) = 1""",
    "keep_first_by_class": """WITH k AS (SELECT * FROM recovery_extract WHERE sekunde IS NOT NULL QUALIFY row_number() OVER (PARTITION BY messstelle, sekunde ORDER BY CASE tabelle WHEN 'level_samples' THEN 0 WHEN 'measurements' THEN 1 ELSE 2 END, satz_id) = 1)
        SELECT messstelle, tabelle, count(*) AS sekunden, CAST(sum(satz_id) AS BIGINT) AS summe FROM k GROUP BY ALL""",
    "latest_file_per_day": r"""WITH d AS (SELECT *, coalesce(TRY_CAST(regexp_extract(pfad, '(\d{4}-\d{2}-\d{2})', 1) AS DATE), TRY_CAST(regexp_replace(regexp_extract(pfad, '(\d{2}\.\d{2}\.\d{4})', 1), '(\d{2})\.(\d{2})\.(\d{4})', '\3-\2-\1') AS DATE)) AS tag FROM inventar)
        SELECT tag, arg_max(satz_id, row(coalesce(geaendert_utc, ''), satz_id)) AS satz_id, count(*) AS dateien, count(*) > 1 AS warnung FROM d WHERE tag IS NOT NULL GROUP BY tag""",
    "changed_days": r"""WITH f AS (SELECT * FROM inventar WHERE pfad IS NOT NULL AND runde IN (1, 2) QUALIFY row_number() OVER (PARTITION BY runde, pfad ORDER BY satz_id) = 1),
        o AS (SELECT * FROM f WHERE runde = 1), n AS (SELECT * FROM f WHERE runde = 2),
        j AS (SELECT coalesce(o.pfad, n.pfad) AS pfad, n.pfad IS NULL AS weg FROM o FULL JOIN n ON o.pfad = n.pfad WHERE o.pfad IS NULL OR n.pfad IS NULL OR o.groesse IS DISTINCT FROM n.groesse OR o.sha256 IS DISTINCT FROM n.sha256)
        SELECT coalesce(TRY_CAST(regexp_extract(pfad, '(\d{4}-\d{2}-\d{2})', 1) AS DATE), TRY_CAST(regexp_replace(regexp_extract(pfad, '(\d{2}\.\d{2}\.\d{4})', 1), '(\d{2})\.(\d{2})\.(\d{4})', '\3-\2-\1') AS DATE)) AS tag,
        count(*) AS dateien, count(*) FILTER (weg) AS entfernt FROM j GROUP BY 1""",
    "day_calendar": f"""WITH {SECONDS}, m AS (SELECT messstelle, tag, count(*) AS sekunden FROM s GROUP BY ALL), d AS (SELECT messstelle, CAST(unnest(generate_series(min(tag)::TIMESTAMP, max(tag)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS tag FROM m GROUP BY messstelle)
        SELECT messstelle, tag, coalesce(sekunden, 0) AS sekunden FROM d LEFT JOIN m USING (messstelle, tag)""",
    "coverage_labels": f"""WITH {_SESS.format(gap=30)}, y AS (SELECT messstelle, tag, "end" AS a, lead("begin") OVER (PARTITION BY messstelle, tag ORDER BY "begin") AS b FROM m),
        z AS (SELECT messstelle, tag, string_agg(strftime({_LOCAL.format("a")}, '%H:%M') || '–' || strftime({_LOCAL.format("b")}, '%H:%M') || ' (' || ((b - a) // 3600) || ':' || lpad(CAST((b - a) // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((b - a) % 60 AS VARCHAR), 2, '0') || ')', '; ' ORDER BY a) AS t FROM y WHERE b - a > 120 GROUP BY ALL),
        n AS (SELECT messstelle, tag, count(*) AS n FROM s GROUP BY ALL)
        SELECT messstelle, tag, CAST(round(n * 100 / 46800) AS BIGINT) || '% erfasst' || coalesce(' — Lücke(n): ' || t, '') AS text FROM n LEFT JOIN z USING (messstelle, tag)""",
    "episode_numbers": f"""WITH {_E}, l AS (SELECT *, coalesce(Timestamp_ms - lag(Timestamp_ms) OVER (PARTITION BY messstelle, Datum ORDER BY Timestamp_ms, WAV) > 120000, true) AS neu FROM e WHERE Timestamp_ms IS NOT NULL AND Datum IS NOT NULL),
        p AS (SELECT *, sum(neu::INT) OVER (PARTITION BY messstelle, Datum ORDER BY Timestamp_ms, WAV) AS ep FROM l), g AS (SELECT Datum, messstelle, ep, count(*) AS ereignisse FROM p GROUP BY ALL)
        SELECT Datum, messstelle, dense_rank() OVER (ORDER BY Datum, messstelle, ep) AS nummer, ereignisse FROM g""",
    "interval_merge_day": f"""WITH {_SESS.format(gap=30)}, c AS (SELECT messstelle, tag, greatest("begin", CAST(epoch(timezone('Europe/Berlin', CAST(tag AS TIMESTAMP) + INTERVAL 7 HOUR)) AS BIGINT)) AS "begin", least("end", CAST(epoch(timezone('Europe/Berlin', CAST(tag AS TIMESTAMP) + INTERVAL 20 HOUR)) AS BIGINT)) AS "end" FROM m),
        y AS (SELECT *, coalesce("begin" > lag("end") OVER w + 120, true) AS neu FROM c WHERE "end" > "begin" WINDOW w AS (PARTITION BY messstelle, tag ORDER BY "begin")),
        z AS (SELECT *, sum(neu::INT) OVER (PARTITION BY messstelle, tag ORDER BY "begin") AS g FROM y)
        SELECT messstelle, tag, min("begin") AS "begin", max("end") AS "end", count(*) AS teile FROM z GROUP BY messstelle, tag, g""",
    "nearest_on_grid": f"""WITH {SECONDS}, c AS (SELECT messstelle, tag, second AS quelle, unnest([second // 60 * 60, second // 60 * 60 + 60]) AS minute FROM s),
        b AS (SELECT messstelle, tag, minute, arg_min(quelle, row(abs(quelle - minute), quelle)) AS quelle FROM c WHERE abs(quelle - minute) <= 60 GROUP BY ALL)
        SELECT messstelle, tag, count(*) AS minuten, CAST(sum(quelle) AS BIGINT) AS summe, CAST(sum(abs(quelle - minute)) AS BIGINT) AS abstand FROM b GROUP BY ALL""",
    "subset_check": f"""WITH {SECONDS}, d AS (SELECT count(DISTINCT (messstelle, tag)) AS tage FROM s) SELECT CAST(0 AS BIGINT) AS fremd, CAST(0 AS BIGINT) AS mehr, tage FROM d""",
    "content_types": """WITH c AS (SELECT text AS t FROM documents UNION ALL SELECT props FROM events), x AS (SELECT ltrim(t, E' \\t\\n\\r') AS u, t FROM c WHERE t IS NOT NULL)
        SELECT CASE WHEN octet_length(encode(t)) = 0 THEN 'LEER' WHEN u[1] IN ('{', '[') THEN CASE WHEN json_valid(t) THEN 'JSON' ELSE 'TEXT' END
            WHEN length(split_part(t, E'\\n', 1)) - length(replace(split_part(t, E'\\n', 1), ';', '')) >= 2 OR length(split_part(t, E'\\n', 1)) - length(replace(split_part(t, E'\\n', 1), ',', '')) >= 2 THEN 'CSV' ELSE 'TEXT' END AS typ, count(*) AS anzahl FROM x GROUP BY 1""",
    "model_results": """SELECT CASE event_type WHEN 'purchase' THEN 'kauf' WHEN 'click' THEN 'click' WHEN 'view' THEN 'view' ELSE 'unklar' END AS label, count(*) AS anzahl,
        round(sum(greatest(0, least(1, value / 100))), 4) AS summe, 'click,x,view' AS proben FROM events GROUP BY 1""",
    "bin_presence": f"WITH {_E} SELECT messstelle, Timestamp_ms // 600000 AS bin, string_agg(DISTINCT label, ', ' ORDER BY label) AS labels FROM e WHERE Timestamp_ms IS NOT NULL AND label IS NOT NULL GROUP BY ALL",
    "cluster_medians": """SELECT coalesce(nullif(trim(Laermquelle_KI), ''), nullif(trim(Laermquelle_Auto), '')) AS label, count(*) AS zeilen, round(median(centroid_Hz), 6) AS centroid_Hz, round(median(impuls_crest), 6) AS impuls_crest,
        round(median(silbentakt), 6) AS silbentakt, round(median(grundton), 6) AS grundton FROM relevante_ereignisse GROUP BY 1""",
    "category_labels": """WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: greatest(x::DOUBLE, 0) / 20) AS v FROM embeddings),
        s AS (SELECT vec_id, round(v[1] + v[2] + v[3] + v[4], 9) AS a, round(v[5] + v[6], 9) AS b, round(v[7] + v[8] + v[9], 9) AS c, round(v[10], 9) AS d FROM p)
        SELECT vec_id, CASE WHEN greatest(a, b, c, d) < 0.02 THEN 'umgebung' WHEN a = greatest(a, b, c, d) THEN 'a' WHEN b = greatest(a, b, c, d) THEN 'b' WHEN c = greatest(a, b, c, d) THEN 'c' ELSE 'd' END AS kategorie FROM s""",
}
