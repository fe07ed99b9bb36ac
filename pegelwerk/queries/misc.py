"""Catalogues, texts, vectors, joins and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pegelwerk.functions import text as T
from pegelwerk.functions import vectors as X
from pegelwerk.operators import cluster as K
from pegelwerk.operators import select as C
from pegelwerk.queries.levels import SECONDS, r6, seconds
from pegelwerk.sources.tables import table

GROUPS = {"a": [0, 1, 2, 3], "b": [4, 5], "c": [6, 7, 8], "d": [9]}


# catalogue
def duplicate_inventory(spark, sf_dir):
    """First finding of each content, and how many copies: S-34."""
    i = table(spark, sf_dir, "inventar")
    sha = F.nullif(F.lower(F.trim("sha256")), F.lit(""))
    g = i.filter(sha.isNotNull()).groupBy(sha.alias("sha")).agg(F.min("satz_id").alias("erstfund"), F.count(F.lit(1)).alias("funde"), F.min("runde").alias("runde"))
    return g.filter("funde > 1")


def catalog_diff(spark, sf_dir):
    """Files of two rounds compared: added, removed, changed: J-23, R-01."""
    i = table(spark, sf_dir, "inventar").filter(F.col("pfad").isNotNull())
    one = lambda k: C.first_per_key(i.filter(F.col("runde") == k), ["pfad"], [F.asc("satz_id")])
    return C.full_compare(one(1), one(2), ["pfad"], ["groesse", "sha256"]).groupBy("stand").agg(F.count(F.lit(1)).alias("dateien"))


def manifest_semi(spark, sf_dir):
    """Recovered rows whose source file is catalogued: O-05, O-08."""
    known = table(spark, sf_dir, "inventar").select(F.lower(F.trim("sha256")).alias("sha256")).distinct()
    r = table(spark, sf_dir, "recovery_extract")
    return r.join(known, "sha256", "left_semi").groupBy("messstelle").agg(F.count(F.lit(1)).alias("saetze"))


def file_days(spark, sf_dir):
    """Days in file names: G-06, S-31."""
    e = table(spark, sf_dir, "relevante_ereignisse")
    return e.groupBy(T.file_day(F.col("WAV_Pfad")).alias("tag")).agg(F.count(F.lit(1)).alias("dateien"), F.countDistinct("WAV").alias("clips"))


def wav_names(spark, sf_dir):
    """Instants in clip names against the given ones."""
    e = table(spark, sf_dir, "relevante_ereignisse")
    n = T.wav_instant(F.col("WAV"))
    return e.groupBy(n.isNull().alias("ohne_zeit"), (n == F.col("Timestamp_ms")).alias("gleich")).agg(F.count(F.lit(1)).alias("zeilen"))


def hash_harvest(spark, sf_dir):
    """Hashes in any text: G-05."""
    m = table(spark, sf_dir, "manifest").select(F.concat_ws(" ", "file", "url", "sha256").alias("text"))
    return m.select(F.explode(T.hashes(F.col("text"))).alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("anzahl"))


def number_ranges(spark, sf_dir):
    """Numbers in text: G-03."""
    m = table(spark, sf_dir, "manifest").select("file", T.number_range(F.regexp_extract("file", r"([^/]*)$", 1)).alias("z"))
    return m.select("file", "z.unten", "z.oben", "z.mitte")


def json_extract(spark, sf_dir):
    """JSON in text: N-01."""
    e = table(spark, sf_dir, "events").select("event_type", T.model_answer(F.concat(F.lit("Antwort: ```"), "props", F.lit("```")), "k int").alias("j"))
    return e.groupBy("event_type").agg(F.sum("j.k").alias("summe"), F.count("j.k").alias("anzahl"))


def regex_parse_names(spark, sf_dir):
    """Parts of paths: G-01, G-06."""
    m = table(spark, sf_dir, "manifest")
    part = lambda k: F.regexp_extract("file", r"^raw/lauf_(\d+)_(\d+)/(\d+)_([a-z]+)_(\d+)_(\d+)\.zip$", k)
    return m.groupBy(part(4).alias("produkt"), F.lpad(part(5), 6, "0").alias("station")).agg(F.count(F.lit(1)).alias("dateien"), F.sum("bytes").alias("bytes"))


def formats(spark, sf_dir):
    """Durations, decimal commas and bars: G-09."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return p.select("p_partkey", T.duration(F.col("p_size") * 997).alias("dauer"), T.bar(F.col("p_size") / 50.0).alias("balken"))


def signatures(spark, sf_dir):
    """Content signatures: N-02, N-07."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))


# vectors
def category_scores(spark, sf_dir):
    """Sums by category, best one, top 3: N-03, M-07, T-03."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform(X.doubles(F.col("embedding")), lambda x: F.abs(x)).alias("v"))
    s = X.category_sums(F.col("v"), GROUPS)
    e = e.select("vec_id", s.alias("s"), X.weighted_top3(F.col("v")).alias("top3"), X.top(F.col("v"), 3)[0]["index"].cast("int").alias("groesster"))
    return e.select("vec_id", *[F.round(f"s.{k}", 6).alias(k) for k in GROUPS], r6("top3"), "groesster")


def cosine_similarity(spark, sf_dir):
    """Similarity of each vector to its label's mean: M-08, A-37."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", X.doubles(F.col("embedding")).alias("v"))
    m = e.groupBy("label").agg(X.mean_vector(F.col("v"), 64).alias("m"))
    return e.join(m, "label").select("vec_id", F.round(X.cosine(F.col("v"), F.col("m")), 6).alias("aehnlichkeit"))


def representatives(spark, sf_dir):
    """Rows at given places of the similarity ranking: W-16."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.round(X.doubles(F.col("embedding"))[0], 6).alias("s"))
    return K.representatives(e, "label", "s", "vec_id").select("label", "vec_id", F.col("platz").cast("long").alias("platz"))


def cluster_vote(spark, sf_dir):
    """Majority label per cluster of equal leading element, with gate: A-37, L-05."""
    e = table(spark, sf_dir, "embeddings").select("label", X.top(F.transform(X.doubles(F.col("embedding")), lambda x: F.abs(x)), 1)[0]["index"].cast("int").alias("cluster"))
    c = K.consensus(e, "cluster", "label")
    return c.select("cluster", "mitglieder", "label", r6("anteil"), K.gate(F.col("anteil"), F.lit(0.5), F.col("anteil"), F.col("anteil") == 1, F.col("label") == 0).alias("urteil"))


def cosine_kmeans(spark, sf_dir):
    """Sizes of spherical clusters: L-03."""
    c = K.cosine_kmeans(table(spark, sf_dir, "embeddings"), "embedding", 10)
    return c.groupBy("cluster").agg(F.count(F.lit(1)).alias("mitglieder"), F.round(F.avg("aehnlichkeit"), 6).alias("aehnlichkeit"))


def random_projection(spark, sf_dir):
    """Projected unit vectors: M-09."""
    p = K.random_projection(table(spark, sf_dir, "embeddings"), "embedding", 64)
    return p.select("vec_id", F.round(X.norm(F.col("projektion")), 6).alias("laenge"), F.round(F.col("projektion")[0], 6).alias("erstes"))


# joins and sets
def join_inner(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("summe"))


def join_left(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return c.join(o, o.o_custkey == c.c_custkey, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


def join_semi_anti(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    on = o.o_custkey == c.c_custkey
    return c.join(o, on, "left_semi").select("c_custkey", F.lit("mit").alias("art")).unionByName(c.join(o, on, "left_anti").select("c_custkey", F.lit("ohne").alias("art")))


def join_full(spark, sf_dir):
    e = table(spark, sf_dir, "relevante_ereignisse").groupBy("messstelle").agg(F.count(F.lit(1)).alias("ereignisse"))
    s = table(spark, sf_dir, "sessions").groupBy("messstelle").agg(F.count(F.lit(1)).alias("sitzungen"))
    return e.join(s, "messstelle", "full_outer").select("messstelle", "ereignisse", "sitzungen")


def join_cross(spark, sf_dir):
    """Fixed small dimensions only."""
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    return r.select("r_name").crossJoin(F.broadcast(n.select("n_name")))


def join_positional(spark, sf_dir):
    """i-th clip with i-th sample of each station and hour where both have as many: J-28."""
    h = lambda c: F.floor(F.col(c) / 3_600_000).alias("h")
    e = table(spark, sf_dir, "relevante_ereignisse").filter("Timestamp_ms IS NOT NULL").groupBy("WAV").agg(F.min("messstelle").alias("messstelle"), F.min("Timestamp_ms").alias("t"))
    a = table(spark, sf_dir, "alt_export").select("messstelle", F.unix_millis(F.trim("Zeit").try_cast("timestamp")).alias("t"), "satz_id", "Quelle").filter("upper(trim(Quelle)) = 'GEMISCHT' AND t IS NOT NULL")
    out = []
    for df, k in ((e, "WAV"), (a, "satz_id")):
        df = df.withColumn("h", h("t"))
        w = Window.partitionBy("messstelle", "h")
        out.append(df.select("messstelle", "h", k, F.row_number().over(w.orderBy("t", k)).alias("i"), F.count(F.lit(1)).over(w).alias("n")))
    return out[0].join(out[1], ["messstelle", "h", "i", "n"]).select("messstelle", "WAV", "satz_id")


def sort_topk(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


def set_operations(spark, sf_dir):
    """Days of samples and events: union, intersection, difference: U-01 to U-06."""
    a = table(spark, sf_dir, "level_samples").select("messstelle", F.floor(F.col("at") / 86_400_000).alias("tag"))
    b = table(spark, sf_dir, "relevante_ereignisse").filter("Timestamp_ms IS NOT NULL").select("messstelle", F.floor(F.col("Timestamp_ms") / 86_400_000).alias("tag"))
    n = lambda df, k: df.agg(F.count(F.lit(1)).alias("tage")).select(F.lit(k).alias("art"), "tage")
    return n(a.union(b).distinct(), "vereinigt").union(n(a.intersect(b), "gemeinsam")).union(n(a.subtract(b), "nur_a")).union(n(b.subtract(a), "nur_b"))


def asof_offsets(spark, sf_dir):
    """A clip's level at its second, else +1, -1, +2, -2 seconds: J-06."""
    e = table(spark, sf_dir, "relevante_ereignisse").filter("Timestamp_ms IS NOT NULL").groupBy("WAV").agg(F.min("messstelle").alias("messstelle"), F.min(F.floor(F.col("Timestamp_ms") / 1000)).alias("t"))
    tries = F.array(*[F.struct(F.lit(k).alias("rang"), F.lit(d).alias("d")) for k, d in enumerate((0, 1, -1, 2, -2))])
    e = e.withColumn("x", F.explode(tries)).select("WAV", "messstelle", (F.col("t") + F.col("x.d")).alias("second"), "x.rang")
    j = e.join(seconds(spark, sf_dir).select("messstelle", "second", "leq"), ["messstelle", "second"])
    return j.groupBy("WAV").agg(F.min(F.struct("rang", "leq")).alias("b")).select("WAV", F.col("b.rang").alias("rang"), F.round("b.leq", 6).alias("leq"))


def page_chunks(spark, sf_dir):
    """A station's days in pages of 28 rows: T-08."""
    d = seconds(spark, sf_dir).select("messstelle", "tag").distinct()
    row = F.row_number().over(Window.partitionBy("messstelle").orderBy("tag")) - 1
    return d.select("messstelle", "tag", F.call_function("div", row, F.lit(28)).cast("long").alias("seite"))


def weekday_compare(spark, sf_dir):
    """Weekdays against weekends: A-33, D-07."""
    s = seconds(spark, sf_dir)
    d = s.groupBy("messstelle", "tag").agg((10 * F.log10(F.avg(F.pow(F.lit(10.0), F.col("leq") / 10)))).alias("l"))
    return d.groupBy(F.dayofweek("tag").isin(1, 7).alias("wochenende")).agg(F.count(F.lit(1)).alias("tage"), F.round(F.avg("l"), 6).alias("mittel"), F.round(F.min("l"), 6).alias("kleinstes"), F.round(F.max("l"), 6).alias("groesstes"))


def timeofday_profile(spark, sf_dir):
    """Mean curve over the day in minutes: A-34, J-08."""
    s = seconds(spark, sf_dir).groupBy("messstelle", "tag", F.floor(F.col("sod") / 60).alias("minute")).agg((10 * F.log10(F.avg(F.pow(F.lit(10.0), F.col("leq") / 10)))).alias("l"))
    return s.groupBy("minute").agg(F.round(F.avg("l"), 6).alias("mittel"), F.count(F.lit(1)).alias("kurven"))


def minmax_days(spark, sf_dir):
    """Quietest and loudest day of each station: A-34, T-04."""
    s = seconds(spark, sf_dir)
    d = s.groupBy("messstelle", "tag").agg(F.round(10 * F.log10(F.avg(F.pow(F.lit(10.0), F.col("leq") / 10))), 6).alias("l"))
    return d.groupBy("messstelle").agg(F.min(F.struct("l", "tag")).alias("a"), F.min(F.struct((-F.col("l")).alias("l"), "tag")).alias("z")).select("messstelle", F.col("a.tag").alias("leisester"), F.col("z.tag").alias("lautester"))


QUERIES = {
    f.__name__: f
    for f in (
        duplicate_inventory, catalog_diff, manifest_semi, file_days, wav_names, hash_harvest, number_ranges, json_extract, regex_parse_names, formats, signatures,
        category_scores, cosine_similarity, representatives, cluster_vote, cosine_kmeans, random_projection,
        join_inner, join_left, join_semi_anti, join_full, join_cross, join_positional, sort_topk, set_operations, asof_offsets, page_chunks,
        weekday_compare, timeofday_profile, minmax_days,
    )
}
_V = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: abs(x::DOUBLE)) AS v, embedding::DOUBLE[] AS d FROM embeddings)"
_DL = "d AS (SELECT messstelle, tag, 10 * log10(avg(pow(10, leq / 10))) AS l FROM s GROUP BY ALL)"
SQL = {
    "duplicate_inventory": "SELECT lower(trim(sha256)) AS sha, min(satz_id) AS erstfund, count(*) AS funde, min(runde) AS runde FROM inventar WHERE trim(sha256) <> '' GROUP BY 1 HAVING count(*) > 1",
    "catalog_diff": """WITH o AS (SELECT * FROM inventar WHERE runde = 1 AND pfad IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pfad ORDER BY satz_id) = 1), n AS (SELECT * FROM inventar WHERE runde = 2 AND pfad IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pfad ORDER BY satz_id) = 1)
        SELECT CASE WHEN o.pfad IS NULL THEN 'added' WHEN n.pfad IS NULL THEN 'removed' WHEN o.groesse IS NOT DISTINCT FROM n.groesse AND o.sha256 IS NOT DISTINCT FROM n.sha256 THEN 'same' ELSE 'changed' END AS stand, count(*) AS dateien FROM o FULL JOIN n ON o.pfad = n.pfad GROUP BY 1""",
    "manifest_semi": "SELECT messstelle, count(*) AS saetze FROM recovery_extract WHERE sha256 IN (SELECT lower(trim(sha256)) FROM inventar) GROUP BY 1",
    "file_days": "SELECT TRY_CAST(regexp_extract(WAV_Pfad, '(\\d{4}-\\d{2}-\\d{2})', 1) AS DATE) AS tag, count(*) AS dateien, count(DISTINCT WAV) AS clips FROM relevante_ereignisse GROUP BY 1",
    "wav_names": "WITH n AS (SELECT *, CAST(nullif(regexp_extract(WAV, '(\\d{13})', 1), '') AS BIGINT) AS n FROM relevante_ereignisse) SELECT n IS NULL AS ohne_zeit, n = Timestamp_ms AS gleich, count(*) AS zeilen FROM n GROUP BY ALL",
    "hash_harvest": "SELECT lower(h) AS hash, count(*) AS anzahl FROM (SELECT unnest(regexp_extract_all(concat_ws(' ', file, url, sha256), '\\b([0-9a-fA-F]{64})\\b', 1)) AS h FROM manifest) GROUP BY 1",
    "number_ranges": "WITH n AS (SELECT file, list_transform(regexp_extract_all(regexp_extract(file, '([^/]*)$', 1), '(\\d+(?:[.,]\\d+)?)', 1), lambda x: replace(x, ',', '.')::DOUBLE) AS n FROM manifest) SELECT file, list_min(n) AS unten, list_max(n) AS oben, (list_min(n) + list_max(n)) / 2 AS mitte FROM n",
    "json_extract": "SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS INT)) AS BIGINT) AS summe, count(json_extract(props, '$.k')) AS anzahl FROM events GROUP BY 1",
    "regex_parse_names": "WITH p AS (SELECT *, regexp_extract(file, '^raw/lauf_(\\d+)_(\\d+)/(\\d+)_([a-z]+)_(\\d+)_(\\d+)\\.zip$', 4) AS produkt, regexp_extract(file, '^raw/lauf_(\\d+)_(\\d+)/(\\d+)_([a-z]+)_(\\d+)_(\\d+)\\.zip$', 5) AS s FROM manifest) SELECT produkt, lpad(s, 6, '0') AS station, count(*) AS dateien, CAST(sum(bytes) AS BIGINT) AS bytes FROM p GROUP BY ALL",
    "formats": "SELECT p_partkey, printf('%d:%02d:%02d', p_size * 997 // 3600, p_size * 997 // 60 % 60, p_size * 997 % 60) AS dauer, repeat('█', CAST(floor(p_size / 50.0 * 10 + 0.5) AS INT)) || repeat('░', 10 - CAST(floor(p_size / 50.0 * 10 + 0.5) AS INT)) AS balken FROM part",
    "signatures": "SELECT doc_id, sha256(text) AS hash FROM documents",
    "category_scores": f"""WITH {_V}, t AS (SELECT *, list_reverse_sort(v) AS s FROM v) SELECT vec_id, {', '.join('round(' + ' + '.join(f'v[{i + 1}]' for i in idx) + f', 6) AS {k}' for k, idx in GROUPS.items())},
        round(s[1] + 0.25 * s[2] + 0.10 * s[3], 6) AS top3, CAST(list_position(v, s[1]) - 1 AS INT) AS groesster FROM t""",
    "cosine_similarity": f"""WITH {_V}, m AS (SELECT label, [{', '.join(f'avg(d[{k}])' for k in range(1, 65))}] AS m FROM v GROUP BY label) SELECT vec_id, round(list_cosine_similarity(d, m), 6) AS aehnlichkeit FROM v JOIN m USING (label)""",
    "representatives": """WITH r AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY round(embedding[1]::DOUBLE, 6) DESC, vec_id) - 1 AS platz, count(*) OVER (PARTITION BY label) AS n FROM embeddings)
        SELECT label, vec_id, platz FROM r WHERE platz IN (round_even(0.0 * (n - 1), 0), round_even(0.1::DOUBLE * (n - 1), 0), round_even(0.25 * (n - 1), 0), round_even(0.4::DOUBLE * (n - 1), 0), round_even(0.65::DOUBLE * (n - 1), 0), round_even(0.85::DOUBLE * (n - 1), 0))""",
    "cluster_vote": f"""WITH {_V}, c AS (SELECT label, CAST(list_position(v, list_max(v)) - 1 AS INT) AS cluster FROM v), n AS (SELECT cluster, label, count(*) AS n FROM c GROUP BY ALL),
        b AS (SELECT cluster, sum(n) AS m, arg_min(label, row(-n, label)) AS label, max(n) / sum(n) AS a FROM n GROUP BY cluster)
        SELECT cluster, CAST(m AS BIGINT) AS mitglieder, label, round(a, 6) AS anteil, CASE WHEN CASE WHEN label = 0 THEN a >= 0.8 AND a = 1 ELSE a >= 0.6 END THEN 'automatisch' ELSE 'pruefen' END AS urteil FROM b""",
    "join_inner": "SELECT c_nationkey, count(*) AS n, round(sum(o_totalprice), 2) AS summe FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1",
    "join_left": "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1",
    "join_semi_anti": "SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'mit' ELSE 'ohne' END AS art FROM customer",
    "join_full": "WITH e AS (SELECT messstelle, count(*) AS ereignisse FROM relevante_ereignisse GROUP BY 1), s AS (SELECT messstelle, count(*) AS sitzungen FROM sessions GROUP BY 1) SELECT messstelle, ereignisse, sitzungen FROM e FULL JOIN s USING (messstelle)",
    "join_cross": "SELECT r_name, n_name FROM region, nation",
    "join_positional": """WITH e AS (SELECT WAV, min(messstelle) AS messstelle, min(Timestamp_ms) AS t FROM relevante_ereignisse WHERE Timestamp_ms IS NOT NULL GROUP BY WAV),
        a AS (SELECT messstelle, epoch_ms(TRY_CAST(trim(Zeit) AS TIMESTAMPTZ)) AS t, satz_id FROM alt_export WHERE upper(trim(Quelle)) = 'GEMISCHT' AND TRY_CAST(trim(Zeit) AS TIMESTAMPTZ) IS NOT NULL),
        x AS (SELECT *, t // 3600000 AS h, row_number() OVER (PARTITION BY messstelle, t // 3600000 ORDER BY t, WAV) AS i, count(*) OVER (PARTITION BY messstelle, t // 3600000) AS n FROM e),
        y AS (SELECT *, t // 3600000 AS h, row_number() OVER (PARTITION BY messstelle, t // 3600000 ORDER BY t, satz_id) AS i, count(*) OVER (PARTITION BY messstelle, t // 3600000) AS n FROM a)
        SELECT x.messstelle, WAV, satz_id FROM x JOIN y ON x.messstelle = y.messstelle AND x.h = y.h AND x.i = y.i AND x.n = y.n""",
    "sort_topk": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
    "set_operations": """WITH a AS (SELECT messstelle, "at" // 86400000 AS tag FROM level_samples), b AS (SELECT messstelle, Timestamp_ms // 86400000 AS tag FROM relevante_ereignisse WHERE Timestamp_ms IS NOT NULL)
        SELECT 'vereinigt' AS art, count(*) AS tage FROM (FROM a UNION FROM b) UNION ALL SELECT 'gemeinsam', count(*) FROM (FROM a INTERSECT FROM b) UNION ALL SELECT 'nur_a', count(*) FROM (FROM a EXCEPT FROM b) UNION ALL SELECT 'nur_b', count(*) FROM (FROM b EXCEPT FROM a)""",
    "asof_offsets": f"""WITH {SECONDS}, e AS (SELECT WAV, min(messstelle) AS messstelle, min(Timestamp_ms // 1000) AS t FROM relevante_ereignisse WHERE Timestamp_ms IS NOT NULL GROUP BY WAV), o(rang, d) AS (VALUES (0, 0), (1, 1), (2, -1), (3, 2), (4, -2))
        SELECT WAV, CAST(rang AS INT) AS rang, round(leq, 6) AS leq FROM e, o, s WHERE s.messstelle = e.messstelle AND s.second = e.t + o.d QUALIFY row_number() OVER (PARTITION BY WAV ORDER BY rang) = 1""",
    "page_chunks": f"WITH {SECONDS}, d AS (SELECT DISTINCT messstelle, tag FROM s) SELECT messstelle, tag, (row_number() OVER (PARTITION BY messstelle ORDER BY tag) - 1) // 28 AS seite FROM d",
    "weekday_compare": f"WITH {SECONDS}, {_DL} SELECT dayofweek(tag) IN (0, 6) AS wochenende, count(*) AS tage, round(avg(l), 6) AS mittel, round(min(l), 6) AS kleinstes, round(max(l), 6) AS groesstes FROM d GROUP BY 1",
    "timeofday_profile": f"WITH {SECONDS}, m AS (SELECT messstelle, tag, sod // 60 AS minute, 10 * log10(avg(pow(10, leq / 10))) AS l FROM s GROUP BY ALL) SELECT minute, round(avg(l), 6) AS mittel, count(*) AS kurven FROM m GROUP BY 1",
    "minmax_days": f"WITH {SECONDS}, {_DL} SELECT messstelle, arg_min(tag, row(round(l, 6), tag)) AS leisester, arg_min(tag, row(-round(l, 6), tag)) AS lautester FROM d GROUP BY 1",
}
