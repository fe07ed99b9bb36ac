"""Known values of the measuring rules on tiny frames."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from pegelwerk.functions import levels as L
from pegelwerk.operators import intervals as V
from pegelwerk.operators import recovery as R
from pegelwerk.operators import rolling, seconds
from pegelwerk.operators import select as C
from pegelwerk.operators import votes
from pegelwerk.operators import weather as W


def one(spark, c):
    return spark.range(1).select(c).first()[0]


def series(spark, pairs):
    return spark.createDataFrame([("m", s, None if v is None else float(v)) for s, v in pairs], "k string, second bigint, leq double")


def test_energetic_mean(spark):
    df = spark.createDataFrame([(50.0,), (70.0,), (None,)], "x double")
    assert df.agg(L.laeq(F.col("x"))).first()[0] == pytest.approx(67.0329137812)
    assert df.limit(0).agg(L.laeq(F.col("x"))).first()[0] is None
    assert one(spark, L.level_of(F.lit(-1.0))) is None


def test_loudest_hour(spark):
    pairs = [(s, 80 if s < 1800 else 40) for s in range(7200) if not 1800 <= s < 2600]
    r = rolling.loudest_hour(series(spark, pairs), ["k"]).first()
    assert (r.ende, r.sekunden) == (3599, 2800)
    assert r.laeq == pytest.approx(10 * math.log10((1800 * 1e8 + 1000 * 1e4) / 2800))
    assert rolling.loudest_hour(series(spark, [(s, 80) for s in range(1799)]), ["k"]).count() == 0


def test_duration_phases(spark):
    n = lambda pairs, ex=None: V.duration_phases(series(spark, pairs), ["k"], ex).collect()
    loud = lambda a, b: [(s, 61) for s in range(a, b)]
    assert len(n(loud(0, 600))) == 1
    assert len(n(loud(0, 599))) == 0
    assert len(n([(s, 60) for s in range(900)])) == 0
    assert len(n(loud(0, 600) + loud(660, 1200))) == 1  # a minute without samples bridges
    split = n(loud(0, 300) + [(s, 40) for s in range(300, 360)] + loud(360, 1200))  # a quiet one does not
    assert [r.begin for r in split] == [360]
    ex = spark.createDataFrame([("m", 300, 301)], "k string, begin bigint, end bigint")
    assert len(n(loud(0, 600), ex)) == 0


def test_source_selection(spark):
    rows = spark.createDataFrame([(1, "PCE_323", 70.0), (2, "GEMISCHT", 95.0), (3, "GEMISCHT", 98.0), (4, "MIKROFON", 50.0), (5, "UNBEKANNT", 50.0)], "s int, q string, l double")
    better = spark.createDataFrame([(2, 60.0)], "s int, l double")
    got = {(r.s, r.l, r.ersetzt) for r in C.replace_mixed(rows, better, ["s"], "q", "l", "PCE_323", "GEMISCHT").collect()}
    assert got == {(1, 70.0, False), (2, 60.0, True)}


def test_unknown_flags_are_excluded(spark):
    df = spark.createDataFrame([(None,), (0,), (4,), (1,), (8,)], "f int")
    assert [r[0] for r in df.select(L.countable_flags(F.col("f"))).collect()] == [False, True, True, False, False]


@pytest.mark.parametrize("x, name", [(2.49, "leicht"), (2.5, "mäßig"), (10.0, "mäßig"), (10.01, "stark"), (float("nan"), "unbekannt"), (None, "unbekannt")])
def test_rain_class(spark, x, name):
    assert one(spark, L.rain_class(F.lit(x).cast("double"))) == name


def bins(spark, rain):
    return spark.createDataFrame([("s", 600 * (k + 1), x) for k, x in rain], "st string, ende bigint, regen double")


def test_rain_runs(spark):
    run = lambda rain: {(r.a, r.b) for r in W.runs(bins(spark, rain), ["st"], "ende", F.col("regen") > 0, 600, 1, F.col("regen").isNotNull()).filter("lauf IS NOT NULL").groupBy("lauf").agg(F.min("ende").alias("a"), F.max("ende").alias("b")).collect()}
    assert run([(2, 0.1), (3, 0.0), (4, 2.0)]) == {(1800, 3000)}  # a known dry bin bridges
    assert run([(2, 0.1), (3, None), (4, 2.0)]) == {(1800, 1800), (3000, 3000)}
    assert run([(2, 0.1), (4, 2.0)]) == {(1800, 1800), (3000, 3000)}  # a missing one does not
    assert run([(2, 0.1), (3, 0.0), (4, 0.0), (5, 2.0)]) == {(1800, 1800), (3600, 3600)}
    assert run([(2, 0.0)]) == set()


def test_circular_mean(spark):
    df = spark.createDataFrame([(350.0, 2.0), (10.0, 2.0)], "d double, w double")
    v = df.agg(W.circular_mean(F.col("d"), F.col("w"))).first()[0]
    assert min(v, 360 - v) == pytest.approx(0, abs=1e-9)
    assert df.agg(W.circular_mean(F.col("d"), F.lit(0.0))).first()[0] is None
    opposite = spark.createDataFrame([(0.0, 1.0), (180.0, 1.0)], "d double, w double")
    assert opposite.agg(W.circular_mean(F.col("d"), F.col("w"))).first()[0] is None


def test_half_open_intervals(spark):
    p = spark.createDataFrame([("k", x) for x in (99, 100, 1299, 1300)], "k string, s bigint")
    i = spark.createDataFrame([("k", 100, 1300), ("k", 5000, 5000), ("k", None, 7)], "k string, begin bigint, end bigint")
    assert {r.s for r in V.points_in(p, i, ["k"], "s", "left_semi").collect()} == {100, 1299}
    assert {r.s for r in V.points_in(p, i, ["k"], "s", "left_anti", 7).collect()} == {99, 1300}


def test_overlaps_are_found_once(spark):
    a = spark.createDataFrame([("k", 0, 10_000)], "k string, begin bigint, end bigint")
    b = spark.createDataFrame([("k", 9_000, 20_000), ("k", 10_000, 10_001)], "k string, begin bigint, end bigint")
    assert [(r.b_begin, r.gemeinsam) for r in V.overlaps(a, b, ["k"], 100).collect()] == [(9000, 1000)]


def test_lower_bound_of_a_rainless_day(spark):
    df = spark.createDataFrame([("d", s, 61.0, s < 600, False) for s in range(0, 46_800, 20)], "tag string, second bigint, leq double, regen boolean, wind boolean")
    r = W.sensitivity(df, ["tag"], "regen", "wind").first()
    assert r.b_untergrenze == pytest.approx(61 + 10 * math.log10(r.b_sekunden / 46_800)) and r.grund == "Niederschlag"


def test_window_checks_and_reconstruction(spark):
    w = spark.createDataFrame([("k", 0, 87.8, 5), ("k", 1000, 60.0, 3), ("k", 2000, None, 1)], "k string, start_ms bigint, leq double, n int")
    s = spark.createDataFrame([("k", 10, 70.0, "P"), ("k", 20, 70.0, "P"), ("k", 30, 90.0, "M"), ("k", 40, 90.0, "M"), ("k", 50, 90.0, "M"), ("k", 1500, 80.0, "M")], "k string, t bigint, l double, q string")
    ws = R.window_samples(s, ["k"], "t", "l", "q", "P", "M", 1000)
    got = {r.start_ms: (r.status, r.gleich) for r in R.check_windows(w, ws, ["k"], "leq", "n", False).collect()}
    assert got == {0: ("BESTAETIGT", True), 1000: ("KONFLIKT", False), 2000: ("NICHT_PRUEFBAR", None)}
    rec = {r.start_ms: (r.ergebnis, r.unten) for r in R.reconstruct(w.join(ws, ["k", "start_ms"], "left"), "leq", "n").collect()}
    assert rec[1000] == ("UNMOEGLICH", None) and rec[2000][0] == "NICHT_BERECHENBAR" and rec[0][0] == "BERECHNET"


def test_merge_by_priority(spark):
    rows = [(0, 1, 70.0, "a"), (0, 2, 70.05, "b"), (1, 1, 65.0, "a"), (1, 2, 75.0, "b"), (2, 1, 60.0, "b")]
    m = C.merge_by_priority(spark.createDataFrame(rows, "s int, r int, l double, t string"), ["s"], "l", ["r"], "t")
    got = {(x.s, x.rang): (x.gleiche, x.konflikt, x.querpruefung) for x in m.collect()}
    assert got[0, 1] == (1, False, True) and got[1, 1] == (0, True, False) and got[2, 1] == (0, False, False)


def test_labels(spark):
    df = spark.createDataFrame([(" ", None, "auto"), ("hand", "ki", "auto"), (None, "ki", "")], "h string, k string, a string")
    assert [r[0] for r in df.select(votes.precedence("h", "k", "a")).collect()] == ["auto", "hand", "ki"]
    rows = spark.createDataFrame([("d", "x", 70.0), ("d", "y", None), ("d", "y", None), ("d", None, 99.0)], "tag string, l string, w double")
    assert votes.weighted_vote(rows, ["tag"], "l", "w", 1.0).first().anteile == "x 97%, y 3%"
    assert votes.weighted_vote(rows, ["tag"], "l", "w", 100.0).first().label == "y"


def test_guarded_update_is_idempotent(spark):
    rows = spark.createDataFrame([("w1", "2024-01-01", "a", None), ("w2", "2023-01-01", "a", None), ("w3", "2024-01-01", "a", "hand")], "wav string, tag string, label string, hand string")
    new = spark.createDataFrame([(w, "neu") for w in ("w1", "w2", "w3")], "wav string, v string")
    once = C.guarded_update(rows, new, "wav", "label", "hand", "v", F.col("tag") >= "2024-01-01")
    got = {r.wav: (r.label, r.konflikt) for r in once.collect()}
    assert got == {"w1": ("neu", False), "w2": ("a", False), "w3": ("a", True)}
    twice = C.guarded_update(once.drop("konflikt"), new, "wav", "label", "hand", "v", F.col("tag") >= "2024-01-01")
    assert {(r.wav, r.label) for r in twice.collect()} == {(k, v[0]) for k, v in got.items()}


def test_interval_order(spark):
    i = spark.createDataFrame([("k", 0, 5), ("k", 4, 9), ("k", 20, 10), ("k", 30, None), ("k", 40, 50)], "k string, begin int, end int")
    assert [r.befund for r in V.ordered_fault(i, ["k"]).orderBy("begin").collect()] == ["ok", "folge", "ende", "ok", "offen"]


def test_takt_and_days(spark):
    s = series(spark, [(k, 50 + k % 5) for k in range(13)])
    r = seconds.takt_maximum(s, ["k"]).first()
    assert (r.lr, r.takte) == (pytest.approx(54.0), 2)
    d = seconds.with_local(spark.createDataFrame([(1729987200,), (1730077199,)], "second bigint"), "Europe/Berlin").collect()
    assert {x.tag for x in d} >= {date(2024, 10, 27)}


def test_rain_runs_over_shards(spark):
    """Runs that cross the shards' borders, of any length, against a plain loop."""
    import random

    r = random.Random(2)
    rain = [(k, r.choice([0.0, 0.0, None, 0.1, 0.2, 0.3])) for k in range(200) if r.random() > 0.03]
    want, cur, dry = [], [], []
    for k, x in rain:
        whole = cur and k - cur[-1] == len(dry) + 1 and all(v is not None for _, v in dry) and len(dry) <= 1
        if x:
            if whole:
                cur.append(k)
            else:
                want, cur = [*want, (cur[0], cur[-1])] if cur else want, [k]
            dry = []
        else:
            dry.append((k, x))
    want.append((cur[0], cur[-1]))
    df = bins(spark, rain)
    for shard in (1, 2, 3, 7, 4096):
        g = W.runs(df, ["st"], "ende", F.col("regen") > 0, 600, 1, F.col("regen").isNotNull(), shard).filter("lauf IS NOT NULL").groupBy("lauf").agg(F.min("ende").alias("a"), F.max("ende").alias("b"))
        assert sorted((x.a // 600 - 1, x.b // 600 - 1) for x in g.collect()) == want, shard
