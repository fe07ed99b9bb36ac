import io
import sqlite3
import zipfile

import pytest
from pyspark.sql import functions as F

from pegelwerk.functions import text as T
from pegelwerk.sources import archives, meter, sinks, weather_files


def test_meter_csv(spark, tmp_path):
    (tmp_path / "2024-07-05 a.csv").write_text('"FileName",x\n1,07-05-2024,08:00:00,61.5\n2,07-05-2024,08:00:01,"62"\nx,1,2,3\n3,07-05-2024\n4,bad,08:00:02,1\n5,07-05-2024,08:00:00,63.5\n')
    (tmp_path / "2024-07-05 a (1).csv").write_text("1,07-05-2024,08:00:05,99\n")
    rows = meter.meter_csv(spark, str(tmp_path))
    got = rows.orderBy("pos").collect()
    assert [(r.second, r.sod, r.leq) for r in got] == [(1720159200, 28800, 61.5), (1720159201, 28801, None), (None, None, 1.0), (1720159200, 28800, 63.5)]
    level = lambda how: {r.second: r.leq for r in meter.one_per_second(rows, how).collect()}
    assert level("first") == {1720159200: 61.5} and level("last") == {1720159200: 63.5}
    assert 61.5 < level("mean")[1720159200] < 63.5
    assert meter.meter_csv(spark, str(tmp_path), copies=True).count() == 5
    assert meter.file_sessions(rows).first().end == 1720159202


def test_app_csv(spark, tmp_path):
    f = tmp_path / "laermprotokoll_2024-07-05.csv"
    head = "Zeit;LAeq_dB;LAFmax_dB;Samples;Quelle;Flags\r\n"
    lines = ["2024-07-05T08:00:00+02:00;61,5;70,1;9;PCE_323;0", "2024-07-05T08:00:01;61,5;;9;PCE_323;0", "2024-07-05T08:00:02Z;61,5;;9;KEINE_VERBINDUNG;0", "2024-07-05T08:00:03Z;61,5;;9;GEMISCHT;8", "2024-07-05T08:00:04Z;61,5;;0;GEMISCHT;", "2024-07-05T08:00:05Z;NaN;;3;GEMISCHT;4"]
    f.write_bytes(("﻿" + head + "\r\n".join(lines)).encode())
    got = [(r.leq if r.leq == r.leq else None, r.grund) for r in meter.app_csv(spark, str(f)).orderBy(F.col("grund")).collect()]
    assert {g for _, g in got} == {None, "zeit", "keine_verbindung", "flags", "pegel"}
    s = tmp_path / "Session_1.csv"
    s.write_text("Zeit;Pegel_dB;Samples;Quelle\n2024-07-05T08:00:00Z;55,5;1;PCE_323\n")
    assert meter.app_csv(spark, str(s)).first().leq == 55.5
    (tmp_path / "bad.csv").write_text("Zeit;LAeq_dB\n1;2\n")
    with pytest.raises(ValueError, match="Quelle"):
        meter.app_csv(spark, str(tmp_path / "bad.csv"))


def test_day_report_and_order(spark):
    df = spark.createDataFrame([("Kopf\n-----\nZeit: 08:00:01\nAmplitude: 0,5\n--------\nZeit: 9:30:00\nAmplitude: 1\n-----\nnichts",)], "t string")
    assert [(x.sod, x.amplitude) for x in df.select(meter.day_report(F.col("t"))).first()[0]] == [(28801, 0.5), (34200, 1.0)]
    files = spark.createDataFrame([("x/b.csv", 5), ("x/a.csv", 9), ("y/laermprotokoll_1.csv", 1)], "pfad string, groesse int")
    assert [r.pfad for r in meter.input_order(files).orderBy("vorrang").collect()] == ["y/laermprotokoll_1.csv", "x/a.csv", "x/b.csv"]


def zipped(names):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for n, d in names.items():
            z.writestr(n, d)
    return out.getvalue()


def test_archives(spark, tmp_path):
    inner = zipped({"clip.txt": "Zeit: 1"})
    (tmp_path / "a.zip").write_bytes(zipped({"in/b.zip": inner, "x.txt": "Hallo", "../out.txt": "x", "gross.txt": "y" * 5000}))
    (tmp_path / "bad.zip").write_bytes(b"PK\x03\x04 nothing")
    (tmp_path / "copy.zip").write_bytes(b"PK\x03\x04 nothing")
    rows = {r.pfad.rsplit("/", 1)[-1] if "!" not in r.pfad else r.pfad.split("!", 1)[1]: r for r in archives.members(spark, str(tmp_path), budget=4000, texts=".txt").collect()}
    assert rows["in/b.zip!clip.txt"].text == "Zeit: 1" and rows["x.txt"].status == "ok"
    assert rows["../out.txt"].status == "unsicherer_pfad" and rows["gross.txt"].status == "zu_gross" and rows["bad.zip"].status == "defekt"
    inv = archives.files(spark, str(tmp_path))
    assert inv.filter("typ = 'ZIP'").count() == 3
    assert archives.marked_duplicates(inv, "pfad").filter("duplikat_von IS NOT NULL").count() == 1
    m = inv.select("pfad", "sha256").withColumn("sha256", F.when(F.col("pfad").contains("bad"), "0").otherwise(F.upper("sha256")))
    assert {r.befund for r in archives.manifest_files(m, inv).collect()} == {"ok", "anderer_inhalt"}


def test_sqlite(spark, tmp_path):
    for n in ("a", "b"):
        con = sqlite3.connect(tmp_path / f"{n}.sqlite")
        con.execute("CREATE TABLE level_samples (id INTEGER, at INTEGER, levelDb REAL, source TEXT)")
        con.executemany("INSERT INTO level_samples VALUES (?, ?, ?, ?)", [(1, 5, 60.0, "PCE_323"), (2, 6, None, None)])
        con.commit()
        con.close()
    sqlite3.connect(tmp_path / "empty.sqlite").close()
    df = archives.sqlite_table(spark, str(tmp_path), "SELECT id, at, levelDb, source FROM level_samples WHERE at >= 5", "id long, at long, levelDb double, source string")
    assert df.count() == 4 and archives.has_columns(df, "id", "at") and not archives.has_columns(df, "flags")
    assert archives.sqlite_schema(spark, str(tmp_path)).count() == 8


def test_weather(spark, tmp_path):
    (tmp_path / "meta.txt").write_text("Stations_ID;Parameter;Parameterbeschreibung;Einheit\n 15; RWS_10;Summe der Niederschlagshoehe der letzten 10 Min;mm\n 15; FF_10;Windgeschwindigkeitsmittel;m/sec\n 15; RWS_IND_10;Niederschlagsindikator;numerischer Code\nLegende: x\n")
    rows = weather_files.description(spark, str(tmp_path / "meta.txt")).collect()
    assert weather_files.column_of(rows, "precipitation", "rain_mm") == "RWS_10"
    assert weather_files.column_of(rows, "precipitation", "rain_indicator") == "RWS_IND_10" and weather_files.column_of(rows, "wind", "wind_mean_ms") == "FF_10"
    with pytest.raises(ValueError):
        weather_files.column_of(rows, "extreme_wind", "gust_ms")
    (tmp_path / "p.txt").write_text("STATIONS_ID;MESS_DATUM;  QN;RWS_10;eor\n 15;202610250050; 3; 0.1;eor\n 15;202610250100; 3;-999;eor\n 15;190001010000;3;1;eor\n")
    p = weather_files.product(spark, str(tmp_path / "p.txt"), {"rain_mm": "RWS_10"}, "rain", "recent")
    assert [(r.ende, r.station, r.rain_mm, r.rain_qn) for r in p.orderBy("ende").collect()] == [(1792889400, "00015", 0.1, 3.0), (1792890000, "00015", None, 3.0)]
    assert weather_files.repeated(p.union(p)).count() == 2
    assert p.first().rain_status == "qualitätsgeprüft" and p.first().rain_station == "00015"
    late = weather_files.product(spark, str(tmp_path / "p.txt"), {"rain_mm": "RWS_10"}, "rain", "x.txt", "recent")
    assert late.first().rain_status == "vorläufig, Qualitätsprüfung nicht abgeschlossen" and late.first().rain_origin == "x.txt"
    assert weather_files.unique(p).count() == 2
    with pytest.raises(Exception, match="stamp twice"):
        weather_files.unique(p.union(p)).count()
    old = p.filter("ende = 1792889400").withColumn("rain_mm", F.lit(9.0))
    both = weather_files.merged_classes({"now": p, "historical": old})
    assert [r.rain_mm for r in both.orderBy("ende").collect()] == [9.0, None]
    assert [r.rain_mm for r in weather_files.on_grid(spark, 1792888800, 1792890600, 600, [p]).orderBy("ende").collect()] == [0.1, None, None]
    (tmp_path / "s.txt").write_text("Stations_id von bis hoehe breite laenge name\n----\n00015 20000101 20260101 10 53.5 10.0 Muster x\n00016 20000101 20260101 10 53.0 10.0 Anders x\n")
    s = weather_files.stations(spark, str(tmp_path / "s.txt"), 53.0, 10.0).collect()
    assert [r.station for r in s] == ["00016", "00015"] and 55 < s[1].km < 56


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", 1, None), ("2024-01-02", 2, "x")], "tag string, k int, t string")
    sinks.write_csv(df, str(tmp_path / "c"), ["k", "t"], mark=True)
    text = "".join(p.read_text() for p in (tmp_path / "c").glob("part-*"))
    assert text.startswith("﻿k;t") and "1;\n" in text
    sinks.write_days(df, str(tmp_path / "d"))
    sinks.write_days(df.filter("k = 2").withColumn("k", F.lit(9)), str(tmp_path / "d"))
    assert {r.k for r in spark.read.parquet(str(tmp_path / "d")).collect()} == {1, 9}
    sinks.replace(df, str(tmp_path / "r"))
    sinks.replace(df.filter("k = 1"), str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1
    once = sinks.upsert(df, df.filter("k = 2").withColumn("t", F.lit("neu")), ["k"])
    assert {(r.k, r.t) for r in once.collect()} == {(1, None), (2, "neu")}
    assert sinks.pruned(df.union(df), df.filter("k = 1"), "k").count() == 1
    sinks.append(df, str(tmp_path / "a"))
    sinks.append(df, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4


def test_texts(spark):
    def f(c, *v):
        return spark.createDataFrame([(x,) for x in v], "x string").select(c(F.col("x")).alias("y")).collect()

    v = f(T.video_parts, "PXL_20240705_08_30_Balkon 60-65 dBA.mp4", "PXL_20240705_083012345.mp4", "PXL_20241399_08_30.mp4", "x.mp4")
    assert (v[0].y.tag, v[0].y.zeit, v[0].y.ort, v[0].y.db) == ("2024-07-05", "08:30", "Balkon", "60-65")
    assert (v[1].y.zeit, v[1].y.ort, v[1].y.db) == ("08:30", "—", "") and v[2].y is None and v[3].y is None
    assert [r.y for r in f(T.wav_instant, "clip-1729884043313-x.wav", "a.wav")] == [1729884043313, None]
    assert [str(r.y) for r in f(T.file_day, "a/2024-07-05 x.csv", "Laermprotokoll_05.07.2024.zip", "x")] == ["2024-07-05", "2024-07-05", "None"]
    assert f(lambda c: T.model_answer(c, "k int"), 'so: ```{"k": 3}```', "nichts")[0].y.k == 3
    assert f(T.shortened, "Kurz. " + "lang " * 60)[0].y == "Kurz."
    assert T.unmangled("GerÃ¤t") == "Gerät" and T.unmangled("Gerät") == "Gerät" and T.unmangled(None) is None
    assert f(T.number_range, "60,5 bis 70", "ohne")[0].y.mitte == 65.25


def test_small_ones(spark):
    from pegelwerk.functions import levels as L
    from pegelwerk.sources import workbooks

    df = spark.createDataFrame([("2024-01-01", "Schlafzimmer Nord"), ("2024-06-01", "Balkon")], "tag string, ort string")
    r = df.select(L.regime(F.col("tag").cast("date"), [("2024-02-01", "neu"), ("2025-01-01", "neuer")], "alt").alias("a"), T.room(F.col("ort"), {"schlaf": "innen", "balkon": "aussen"}).alias("b")).collect()
    assert [tuple(x) for x in r] == [("alt", "innen"), ("neu", "aussen")]
    assert T.unmangled_tree({"GerÃ¤t": ["Ã¼", 3]}) == {"Gerät": ["ü", 3]}
    assert sinks.blanked(df, ["ort", "fehlt"]).filter("ort IS NULL").count() == 2
    assert "| 2024-01-01 | Schlafzimmer Nord |" in sinks.report("x", df)
    assert workbooks.newest_version(["a_V2.xlsx", "a_V10.xlsx", "b.xlsx"]) == "a_V10.xlsx"


def test_more_of_weather(spark, tmp_path):
    (tmp_path / "w.csv").write_text("interval_end_berlin,interval_start_berlin,rain_mm,precipitation_station\n2026-10-25 02:50:00+02:00,2026-10-25 02:40:00+02:00,0.1,00015\n2026-10-25 02:00:00+01:00,2026-10-25 02:50:00+02:00,,00015\n")
    got = weather_files.processed(spark, str(tmp_path / "w.csv")).orderBy("ende").collect()
    assert [(r.ende, r.anfang, r.rain_mm, r.precipitation_station) for r in got] == [(1792889400, 1792888800, 0.1, "00015"), (1792890000, 1792889400, None, "00015")]
    folder = tmp_path / "m"
    folder.mkdir()
    texts = {"Metadaten_Geographie_15.txt": "Stations_id;Stationshoehe;Name\n 15; 12; Muster\nerzeugt am\n", "Metadaten_Geraete_Wind_15.txt": "Stations_ID;Geraet\n15;Schale\n", "sonst.txt": "x"}
    (folder / "Meta_15.zip").write_bytes(zipped(texts))
    rows = {r.art: (r.station, r.werte) for r in weather_files.metadata(spark, str(folder)).collect()}
    assert rows == {"geographie": ("00015", {"Stations_id": "15", "Stationshoehe": "12", "Name": "Muster"}), "geraet": ("00015", {"Stations_ID": "15", "Geraet": "Schale"})}


def test_first_found_and_patience(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "wav string")
    zips = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "wav string, inhalt int")
    folder = spark.createDataFrame([("a", 9), ("b", 3), ("c", 4), ("c", 5)], "wav string, inhalt int")
    got = {r.wav: (r.inhalt, r.fundort, r.befund) for r in archives.first_found(wanted, [zips, folder], "wav", "inhalt").collect()}
    assert got == {"a": (1, 0, "ok"), "b": (3, 1, "ok"), "c": (None, None, "mehrdeutig"), "d": (None, None, "fehlt")}
    left = [2]

    def read():
        left[0] -= 1
        if left[0] >= 0:
            raise OSError("busy")
        return "da"

    assert archives.patient(read, wait_s=0.001) == "da"
    with pytest.raises(OSError):
        archives.patient(lambda: open("/nicht/da"), tries=2, wait_s=0.001)


def test_nested_archives_share_one_budget():
    data = zipped({"a.zip": zipped({"x.txt": "x" * 900}), "b.txt": "y" * 900})
    states = [r[5] for r in archives.unpack("z", data, 5, [2500], None)]
    assert states == ["ok", "ok", "zu_gross"]


def test_caches(spark, tmp_path):
    from pegelwerk.sources import caches

    df = spark.createDataFrame([("a", [0.1, 0.2]), ("b", [0.3, 0.4])], "WAV string, probs array<float>")
    df.write.parquet(str(tmp_path / "p"))
    assert caches.probabilities(spark, str(tmp_path / "p"), 2).count() == 2
    with pytest.raises(Exception, match="wrong length"):
        caches.probabilities(spark, str(tmp_path / "p"), 3).collect()
    df.union(df).write.parquet(str(tmp_path / "q"))
    with pytest.raises(Exception, match="twice"):
        caches.probabilities(spark, str(tmp_path / "q"), 2).collect()
    s = spark.createDataFrame([("a", "m1", "v1", ["x", "y"]), ("b", "m1", "v2", ["x", "y"]), ("c", "m1", "v1", ["y", "x"]), ("d", None, "v1", ["x", "y"])], "WAV string, modell string, prompt_version string, kategorien array<string>")
    assert [r.WAV for r in caches.scores(s, "m1", "v1", ["x", "y"]).collect()] == ["a"]
    (tmp_path / "pos.csv").write_bytes("\ufeffDatum;Umgebung;Position\r\n2024-01-01;aussen;Nord\r\n2024-01-01;aussen;Sued\r\nkein;;\r\n2024-01-02;;Ost\r\n".encode())
    p = caches.by_day(spark, str(tmp_path / "pos.csv"), caches.POSITIONS)
    assert {(str(r.Datum), r.Position, r.Hinweis) for r in p.collect()} == {("2024-01-01", "Sued", None), ("2024-01-02", "Ost", None)}
    assert caches.by_day(spark, str(tmp_path / "pos.csv"), caches.POSITIONS, one=False).count() == 3
    days = p.select("Datum").union(spark.sql("SELECT DATE '2024-01-03' AS Datum"))
    full = caches.with_positions(days, p, "Nord")
    assert full.count() == 3 and full.filter("Position = 'Nord'").count() == 1 and caches.with_positions(days, full, "West").count() == 3
    (tmp_path / "i.csv").write_text("Datum,Timestamp_ms,WAV,dBA_Dauermessung\n2024-01-01,5,a.wav,61.5\n2024-01-01,x,b.wav,61\n2024-01-01,5,,61\n2024-01-01,7,c.wav,\n")
    assert [r.WAV for r in caches.index(spark, str(tmp_path / "i.csv")).collect()] == ["a.wav"]
    v = spark.createDataFrame([("a", "d1", 30_000), ("b", "d1", 80_000), ("c", "d2", 5), ("d", None, None)], "datei string, tag string, sod int")
    w = spark.createDataFrame([("d1", 25_200, 72_000)], "tag string, von int, bis int")
    assert {r.datei: r.belegart for r in caches.video_audit(v, w).collect()} == {"a": "grafik", "b": "messtag", "c": "ohne_messung", "d": "nicht_erkannt"}


def test_more_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", None)], "pfad string, tag string")
    sinks.write_variants({"vergleich": df, "ausschluesse": df.limit(0)}, {"schwelle": 55, "name": "ü"}, str(tmp_path / "v"))
    assert spark.read.text(str(tmp_path / "v/einstellungen")).first()[0] == '{"name": "ü", "schwelle": 55}'
    assert spark.read.csv(str(tmp_path / "v/vergleich"), sep=";", header=True).count() == 3
    one = lambda *v: spark.createDataFrame([(x,) for x in v], "pfad string")
    assert {r.pfad for r in sinks.carried(one("a", "b"), one("b", "c"), one("a"), "pfad").collect()} == {"b", "c"}
    gone, days = sinks.quarantined(df, one("a"), "pfad", "tag")
    assert {r.pfad for r in gone.collect()} == {"b", "c"} and [r.tag for r in days.collect()] == ["2024-01-02"]
    items = spark.createDataFrame([("x", 1), ("y", 1), ("z", 2), ("w", 3)], "wav string, cluster int")
    v = spark.createDataFrame([(1, "Saege", 0.9, "automatisch"), (2, "Bagger", 0.5, "pruefen")], "cluster int, kandidat string, konfidenz double, urteil string")
    t = sinks.cluster_package(items, v, "cluster", "wav")
    assert {(r.wav, r.label) for r in t["zuordnung"].collect()} == {("x", "Saege"), ("y", "Saege"), ("z", None), ("w", None)}
    assert [r.cluster for r in t["pruefliste"].collect()] == [2, 3] and tuple(t["lauf"].first()) == (3, 4, 2)


def test_phases_in_order(spark):
    from pegelwerk.operators import intervals as V

    rows = [("ok", 1, 2), ("ok", 3, 4), ("ok", 5, None), ("zwei", 1, 2), ("zwei", 3, 4), ("folge", 1, 9), ("folge", 3, 10), ("folge", 11, 12), ("ende", 1, 0), ("ende", 3, 4), ("ende", 5, 6), ("offen", 1, None), ("offen", 3, 4), ("offen", 5, 6)]
    df = spark.createDataFrame(rows, "k string, begin int, end int")
    assert {r.k: r.befund for r in V.valid_phases(df, ["k"]).collect()} == {"ok": "ok", "zwei": "anzahl", "folge": "folge", "ende": "ende", "offen": "offen"}


def test_types_and_texts(spark):
    head = {b"": "LEER", b"SQLite format 3\x00x": "SQLITE", b"\x37\x7f\x06\x82abc": "SQLITE_WAL", b"\xd9\xd5\x05\xf9\x20\xa1\x63\xd7": "SQLITE_JOURNAL", b"\x1f\x8bx": "GZIP", b"RIFF1234WAVEfmt": "AUDIO_WAV",
            b"PK\x05\x06": "ZIP", b"\xff\xfe\x00": "BINAER_UNBEKANNT", b" {\"a\": 1}": "JSON", b"{kaputt": "TEXT", "a;b;c\n1;2;3".encode(): "CSV", "Größe".encode(): "TEXT", b"RIFF1234AVI ": "TEXT"}
    df = spark.createDataFrame([(k, v) for k, v in head.items()], "c binary, t string")
    assert [(bytes(r.c), r.t, r.m) for r in df.select("c", "t", T.magic(F.col("c")).alias("m")).collect() if r.t != r.m] == []
    x = spark.createDataFrame([("Standortwechsel gegen 9:05 Uhr",), ("Wechsel 25:00",), ("Wechsel: 13:30",), ("nichts 12:00",)], "t string")
    assert [r[0] for r in x.select(T.change_of_place(F.col("t"))).collect()] == ["09:05", None, "13:30", None]
    n = spark.createDataFrame([(999,), (1500,), (23_800_000_000,)], "n bigint")
    assert [r[0] for r in n.select(T.size(F.col("n"))).collect()] == ["999 B", "1,5 kB", "23,8 GB"]
    p = spark.createDataFrame([("Südostbalkon Tür geschlosse",), ("XSüdostbalkon",), ("NW Balkon",)], "p string")
    assert [r[0] for r in p.select(T.repaired_place(F.col("p"))).collect()] == ["SO-Balkon Tür geschlossen", "XSüdostbalkon", "NW-Balkon"]
