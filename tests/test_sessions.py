import random

import pytest

from pegelwerk.operators.sessions import NEVER, cut, forest, session_tree


def brute(rows, gap):
    out, cur, key = [], [], None
    for ms, t, day, e, v in sorted((x for x in rows if None not in (x[0], x[1], x[3])), key=lambda x: (x[0], x[1], x[3])):
        if cur and ms == key and t - cur[-1][0] <= gap and day is not None and day == cur[-1][3]:
            cur.append((t, e, v, day))
        else:
            cur, key = [(t, e, v, day)], ms
            out.append((ms, cur))
    best = lambda c: min(c, key=lambda x: (-(float("-inf") if x[2] is None else x[2]), x[0], x[1]))[1]
    return sorted((ms, c[0][0], c[-1][0], len(c), best(c)) for ms, c in out)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice(["a", "a", "a", "b", None]), r.choice([None] + [r.randrange(0, 6_000)] * 20), r.choice(["x", "x", "x", "y", None]), f"e{i:03}", r.choice([None, 1.0, 2.0, 3.0])) for i in range(250)]
    df = spark.createDataFrame(rows, "ms string, t bigint, day string, e string, v double")
    for chunk, fan in ((50, 2), (400, 4), (10_000, 64)):
        tree = session_tree(df, ["ms"], "t", "e", "v", "day", chunk, fan).cache()
        for gap in (0, 5, 20, 60, 10_000):
            got = sorted((x.ms, x.start_ms, x.end_ms, x.events, x.best_key) for x in cut(tree, gap).collect())
            assert got == brute(rows, gap), (chunk, fan, gap)
        tree.unpersist()


def test_monotone_pauses(spark):
    """The worst case for the spines: pauses that only grow."""
    t = [k * (k + 1) // 2 for k in range(300)]
    df = spark.createDataFrame([("a", x, "d", f"e{i:03}", 1.0) for i, x in enumerate(t)], "ms string, t bigint, day string, e string, v double")
    tree = session_tree(df, ["ms"], "t", "e", "v", "day", 1000, 4)
    assert cut(tree, 100).count() == 300 - 100


def test_forest_closes_everything():
    closed, rest = forest([(NEVER, -1, i, i, 1, None, i, f"{i}", "") for i in range(3)], NEVER)
    assert len(closed) == 3 and not rest


def test_spines_are_short():
    """Open pieces are bounded by the span of time, not by the number of events; equal pauses leave three."""
    piece = lambda b, i: (b, -1, i, i, 1, None, i, str(i), "")
    _, even = forest([piece(-1, 0), *[piece(10, 10 * i) for i in range(1, 5_000)]])
    assert len(even) <= 3
    r = random.Random(5)
    t, pieces = 0, [piece(-1, 0)]
    for _ in range(20_000):
        p = r.randrange(1, 5_000)
        t += p
        pieces.append(piece(p, t))
    assert len(forest(pieces)[1]) < 60
    up, t = [piece(-1, 0)], 0
    for p in [x for x in range(1, 2_000) for _ in range(3)]:  # pauses that only grow, each three times
        t += p
        up.append(piece(p, t))
    assert len(forest(up)[1]) <= 2_001


def test_limits_that_come_back(spark):
    """A run of another day between two runs of one day keeps them apart, in every round."""
    days = "xxyyxxyx"
    df = spark.createDataFrame([("a", 10 * i, d, f"e{i}", None) for i, d in enumerate(days)], "ms string, t bigint, day string, e string, v double")
    for chunk, fan in ((10, 2), (40, 2), (1000, 64)):
        got = sorted(x.events for x in cut(session_tree(df, ["ms"], "t", "e", "v", "day", chunk, fan), 1000).collect())
        assert got == [1, 1, 2, 2, 2]


def test_settings_keep_what_they_cut(spark):
    r = random.Random(9)
    rows = [("a", r.randrange(0, 5_000), "x", f"e{i:03}", float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "ms string, t bigint, day string, e string, v double")
    few = session_tree(df, ["ms"], "t", "e", "v", "day", 500, 3, settings=[30, 5])
    assert few.count() < session_tree(df, ["ms"], "t", "e", "v", "day", 500, 3).count()
    for gap in (5, 30):
        assert sorted((x.ms, x.start_ms, x.end_ms, x.events, x.best_key) for x in cut(few, gap).collect()) == brute(rows, gap)


def test_empty(spark):
    df = spark.createDataFrame([], "ms string, t bigint, day string, e string, v double")
    assert cut(session_tree(df, ["ms"], "t", "e", "v", "day"), 10).count() == 0
