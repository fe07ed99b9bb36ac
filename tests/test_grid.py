import random

from pyspark.sql import functions as F

from pegelwerk.operators import grid


def test_gaps_against_brute_force(spark):
    r = random.Random(1)
    rows = [(s, seg, r.randrange(0, 3_000_000)) for s in ("a", "b", None) for seg in (1, 2) for _ in range(60)] + [("a", 1, None)] * 3
    df = spark.createDataFrame(rows, "s string, seg int, t bigint")
    filled = grid.steps(df, ["s", "seg"], "t", 60, {"n": F.count(F.lit(1))})
    for shard in (1, 7, 240):
        got = {tuple(x) for x in grid.missing(filled, ["s", "seg"], 60, shard).collect()}
        want = set()
        for s in ("a", "b", None):
            for seg in (1, 2):
                have = {t // 60_000 * 60 for x, y, t in rows if x == s and y == seg and t is not None}
                want |= {(s, seg, m) for m in range(min(have), max(have), 60) if m not in have}
        assert got == want
    whole = grid.regular(filled, ["s", "seg"], 60)
    assert whole.filter("is_missing").count() == len(want) and whole.filter("NOT is_missing AND n IS NULL").count() == 0


def test_negative_times_and_empty(spark):
    df = spark.createDataFrame([("a", -150_000), ("a", 1)], "s string, t bigint")
    filled = grid.steps(df, ["s"], "t", 60, {"n": F.count(F.lit(1))})
    assert sorted(x.step_s for x in grid.missing(filled, ["s"], 60).collect()) == [-120, -60]
    assert grid.missing(filled.limit(0), ["s"], 60).count() == 0
