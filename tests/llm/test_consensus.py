import random

import pytest
from pyspark.sql import functions as F

from pegelwerk.llm.consensus import STEP, distance, place, representatives, tokens


def survivor(values, weights):
    """The whole vote of one group in plain Python; values in order of trust."""
    seed = min(range(len(values)), key=lambda i: (-weights[i], i))
    table: dict = {}
    for v, w in zip(values, weights):
        for c, t in place(tokens(values[seed]), tokens(v)):
            table.setdefault(c, {}).setdefault(t, 0)
            table[c][t] += w
    total, own = round(sum(weights), 9), dict(place(tokens(values[seed]), tokens(values[seed])))
    consensus = []
    for c in sorted(table):
        t = min(table[c], key=lambda t: (-round(table[c][t], 9), own.get(c) != t, t))
        none = round(total - sum(table[c].values()), 9)
        if round(table[c][t], 9) > none or c % STEP == 0 and round(table[c][t], 9) == none:
            consensus.append(t)
    away = [distance(tokens(v), consensus) for v in values]
    return away.index(min(away))


def test_tokens():
    assert tokens("46.54 dB_x") == ["46", ".", "54", " ", "dB", "_", "x"]
    assert tokens("") == []


def test_place():
    assert place("a b c".split(), "a b c".split()) == [(STEP, "a"), (2 * STEP, "b"), (3 * STEP, "c")]
    assert place("a b c".split(), "a x c".split()) == [(STEP, "a"), (2 * STEP, "x"), (3 * STEP, "c")]
    assert place("a c".split(), "a y z c".split()) == [(STEP, "a"), (STEP + 1, "y"), (STEP + 2, "z"), (2 * STEP, "c")]
    assert place("a b c".split(), ["c"]) == [(3 * STEP, "c")]
    assert place([], ["q"]) == [(1, "q")] and place(["q"], []) == []


def test_a_majority_decides_alone():
    r = random.Random(0)
    for _ in range(300):
        values = list(dict.fromkeys("".join(r.choice("ab1. ") for _ in range(r.randrange(0, 9))) for _ in range(r.randrange(1, 9))))
        assert survivor(values, [0.5**k for k in range(len(values))]) == 0
        heavy = r.randrange(len(values))
        assert survivor(values, [len(values) if k == heavy else 1 for k in range(len(values))]) == heavy


def test_votes_win_token_by_token():
    values = ["Halle 12 Nord", "Halle 13 Nord", "Halle 12 Sued", "Hall 12 Nord"]
    assert survivor(values, [1, 1, 1, 1]) == 0
    assert survivor(values[1:] + values[:1], [1, 1, 1, 1]) == 3
    assert survivor(["Tor 1", "Tor 2", "Tor 2 "], [1.0, 0.8, 0.7]) == 1


def rows(seed):
    r = random.Random(seed)
    pick = lambda *v: r.choice(v)
    return [(pick("k1", "k1", "k2", "k3", None), i, pick(1, 2, None), pick(1.5, 2.5, float("nan"), None), pick("a b", "a c", "", "  ", None)) for i in range(120)] + [("alone", 999, 1, 1.0, "x")]


@pytest.mark.parametrize("seed", range(2))
def test_precedence_against_brute_force(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, "key string, id bigint, rang int, x double, s string").withColumn("_group", F.lit("clash"))
    order = [F.coalesce(F.col("rang").cast("long"), F.lit(99))]
    got = {(g.group, g.field, g.row_id) for g in representatives(df, ["key"], "id", order, ["x", "s"]).collect()}
    want = set()
    for k in ("k1", "k2", "k3"):
        members = [d for d in data if d[0] == k]
        for name, at in (("x", 3), ("s", 4)):
            full = [d for d in members if d[at] is not None and d[at] == d[at] and (not isinstance(d[at], str) or d[at].strip())]
            if full:
                want.add((min(d[1] for d in members), name, min(full, key=lambda d: (d[2] or 99, d[1]))[1]))
    assert got == want


def test_votes_against_brute_force(spark):
    """Groups of 1 to 500 different values go the same way."""
    r = random.Random(4)
    data, want = [], set()
    for g, n in enumerate([1, 2, 2, 3, 3, 5, 8, 16, 17, 17, 40, 500]):
        word = lambda: r.choice(["nord", "sued", "ost"])
        made = [f"Halle {r.randrange(12, 15 + n)} {word()}{r.choice(['', ' b', ' tor 3'])}" for _ in range(n + 3)]
        members = [(f"k{g}", 1000 * g + i, r.randrange(0, 3), v) for i, v in enumerate(made)]
        data += members
        best: dict = {}
        for _, i, rang, v in members:
            b = best.setdefault(v, [(rang, i), 0.0])
            b[0], b[1] = min(b[0], (rang, i)), b[1] + 1 / (1 + rang)
        order = sorted(best, key=lambda v: best[v][0])
        at = order[survivor(order, [round(best[v][1], 9) for v in order])]
        want.add((1000 * g, best[at][0][1], at))
    df = spark.createDataFrame(data, "key string, id bigint, rang int, s string")
    got = {(x.group, x.row_id, x.value) for x in representatives(df, ["key"], "id", [F.col("rang").cast("long")], ["s"], "vote").collect()}
    assert got == want


def test_votes_of_many_values_are_all_counted(spark):
    """Sixty values for one place; most agree on what the most trusted do not have."""
    data = [("k", i, 0, f"wert {i} nord" if i < 16 else f"wert {i} sued") for i in range(60)] + [("k", 60, 0, "wert 7 sued"), ("k", 61, 0, "wert 7 sued")]
    df = spark.createDataFrame(data, "key string, id bigint, rang int, s string")
    order = [F.col("rang").cast("long")]
    got = representatives(df, ["key"], "id", order, ["s"], "vote").collect()
    assert [(g.group, g.value, g.row_id) for g in got] == [(0, "wert 7 sued", 60)]
    assert representatives(df.limit(0), ["key"], "id", order, ["s"], "vote").count() == 0
    assert representatives(df.limit(0), ["key"], "id", order, ["s"]).count() == 0


def test_a_key_with_most_rows(spark):
    data = [("k", i, i % 3, f"v{i % 500}") for i in range(3000)]
    df = spark.createDataFrame(data, "key string, id bigint, rang int, s string")
    for weights in ("first", "vote"):
        assert representatives(df, ["key"], "id", [F.col("rang").cast("long")], ["s"], weights).count() == 1
    assert representatives(df, ["key"], "id", [F.col("rang").cast("long")], ["s"]).first().row_id == 0


def test_strict_precedence_goes_through_alignment_vote_and_distance(spark, sf_dir):
    """Halving weights: groups of all sizes, also beyond what a double can halve; and p5_found takes this way."""
    from pegelwerk.llm.consensus import vote
    from pegelwerk.llm.p05 import p5_found

    r = random.Random(6)
    data, want = [], set()
    for g, n in enumerate([1, 2, 2, 3, 5, 9, 25, 1200]):
        values = list(dict.fromkeys(f"Tor {r.randrange(n * 3)} {r.choice(['nord', 'sued b', ''])}" for _ in range(n)))
        ranks = r.sample(range(10_000), len(values))
        data += [(g, v, (k, k), 1.0) for v, k in zip(values, ranks)]
        order = sorted(range(len(values)), key=lambda i: ranks[i])
        at = order[survivor([values[i] for i in order], [0.5**k for k in range(len(order))])] if n < 30 else order[0]
        want.add((g, values[at], ranks[at]))
    df = spark.createDataFrame(data, "g int, value string, _rank struct<o0: bigint, id: bigint>, _w double")
    best = vote(df, ["g"], "first")
    assert {(x.g, x.value, x._rank.id) for x in best.collect()} == want
    for plan in (best, p5_found(spark, sf_dir)):
        assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") >= 2
