import random

import pytest

from pegelwerk.llm.nearest import nearest


def brute(left, rights, tol):
    out = {}
    for key, ent, t in left:
        for name, rows in rights.items():
            c = [(abs(t - rt), rid) for rent, rt, rid in rows if None not in (rent, rt, rid, t, ent, key) and rent == ent and abs(t - rt) <= tol] if None not in (key, ent, t) else []
            if c:
                best = min(c)
                k = (key, name)
                out[k] = min(out.get(k, best), best)
    return {(k, n, i, d) for (k, n), (d, i) in out.items()}


def check(spark, seed):
    r = random.Random(seed)
    ents = ["a"] * 6 + ["b", "c", None]
    span = 40_000
    left = [(f"k{i}" if i % 17 else None, r.choice(ents), r.choice([None, *[r.randrange(span) for _ in range(9)]])) for i in range(150)]
    rights = {n: [(r.choice(ents), r.choice([None, *[r.randrange(span) // 50 * 50 for _ in range(9)]]), r.randrange(10_000)) for _ in range(400)] for n in ("x", "y")}
    ldf = spark.createDataFrame(left, "key string, entity string, t bigint")
    rdf = {n: spark.createDataFrame(v, "entity string, t bigint, id bigint") for n, v in rights.items()}
    got = {tuple(x) for x in nearest(ldf, rdf, 500, 3, shard_ms=3000).collect()}
    assert got == brute(left, rights, 500)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    check(spark, seed)


def test_neighbours_in_different_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        check(spark, 9)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_empty_and_inclusive(spark):
    none = spark.createDataFrame([], "entity string, t bigint, id bigint")
    left = spark.createDataFrame([("k", "a", 10_000)], "key string, entity string, t bigint")
    assert nearest(left, {"x": none}, 500, 2).count() == 0
    right = spark.createDataFrame([("a", 5_000, 7), ("a", 15_000, 3), ("a", 15_001, 1)], "entity string, t bigint, id bigint")
    assert [tuple(x) for x in nearest(left, {"x": right}, 5_000, 2).collect()] == [("k", "x", 3, 5000)]
    assert nearest(left.limit(0), {"x": right}, 500, 2).count() == 0


def test_partner_at_the_tolerance_in_the_next_batch():
    import pyarrow as pa

    from pegelwerk.llm.nearest import _merge

    rows = [("a", 0, -1, -1, "e"), ("a", 5000, 0, 3, None), ("a", 5000, 1, 4, None)]
    kinds = {"entity": pa.string(), "t": pa.int64(), "side": pa.int32(), "id": pa.int64(), "key": pa.string()}
    batches = [pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(r, kinds.values())], names=list(kinds)) for r in rows]
    found = {tuple(r.values()) for b in _merge(5000, ["x", "y"])(iter(batches)) for r in b.to_pylist()}
    assert found == {("e", "x", 3, 5000), ("e", "y", 4, 5000)}
