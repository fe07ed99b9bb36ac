import math
import random

from pyspark.sql import functions as F

from pegelwerk.operators.charts import implausible

FIELDS = ["laeq", "lmin", "lmax"]
SCHEMA = "id bigint, s string, t bigint, laeq double, lmin double, lmax double, extra string"


def series(seed, n=4000, t0=1_000_000):
    r = random.Random(seed)
    out = []
    for k in range(n):
        base = 50 + r.gauss(0, 0.4)
        out.append([k, "a", t0 + k, base, base - 1 - abs(r.gauss(0, 0.3)), base + 1 + abs(r.gauss(0, 0.3)), "x"])
    return out


def shift(row, d):
    for k in (3, 4, 5):
        row[k] += d


def test_spikes_are_flagged_and_noise_is_not(spark):
    data = series(1)
    spikes = {500, 1200, 1201, 1202, 2000, 3300}
    for k in spikes:
        shift(data[k], 25)
    shift(data[2500], -30)
    spikes.add(2500)
    data[700][5] += 40  # only the maximum
    spikes.add(700)
    for k in range(1500, 1540):  # noise that swells and fades
        shift(data[k], 20 * math.sin(math.pi * (k - 1500) / 40))
    for k in range(2800, 4000):  # another level for good
        shift(data[k], 15)
    df = spark.createDataFrame([tuple(x) for x in data], SCHEMA)
    for shard in (700, 14_400):
        got = {x.row_id for x in implausible(df, "s", "t", "id", FIELDS, shard_s=shard, halo_s=120).filter("spike").collect()}
        assert got == spikes


def test_stuck_stretches_over_shard_borders(spark):
    data = series(2)
    for k in range(1980, 2030):
        data[k][3] = 50.5
    for k in range(3000, 3006):  # chance
        data[k][4] = 49.0
    df = spark.createDataFrame([tuple(x) for x in data], SCHEMA)
    got = {x.row_id for x in implausible(df, "s", "t", "id", FIELDS, shard_s=2000, halo_s=100).filter("stuck").collect()}
    assert got == set(range(1980, 2030))


def test_limits_and_nulls(spark):
    nan = float("nan")
    rows = [(1, 50.0, 49.0, 51.0), (2, 0.0, 0.0, 0.0), (3, None, None, None), (4, nan, 49.0, 51.0), (5, 170.0, 1.0, 200.0), (6, 50.0, 51.0, 52.0), (7, None, 52.0, 51.0), (8, 160.0, 160.0, 160.0), (9, -3.0, None, None)]
    df = spark.createDataFrame(rows, "id bigint, laeq double, lmin double, lmax double")
    for source, at in (("a", 5), (None, 5), ("a", None)):  # limits hold without a station or a time, too
        got = implausible(df.select("*", F.lit(source).cast("string").alias("s"), F.lit(at).cast("bigint").alias("t")), "s", "t", "id", FIELDS, ("lmin", "laeq", "lmax"))
        assert {r.row_id for r in got.filter("impossible").collect()} == {2, 5, 9}
        assert {r.row_id for r in got.filter("contradicting").collect()} == {6, 7}


def test_odd_tables(spark):
    rows = [(1, None, 5, 50.0, 49.0, 51.0, "x"), (2, "a", None, 50.0, 49.0, 51.0, "x"), (3, "a", 5, None, None, None, None), (4, "b", 5, 50.0, None, 51.0, "x"), (5, "b", 5, 50.0, None, 51.0, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert implausible(df, "s", "t", "id", FIELDS).count() == 0
    assert implausible(df.limit(0), "s", "t", "id", FIELDS).count() == 0
    clash = df.withColumnRenamed("extra", "shard").withColumn("own", F.lit(1))
    assert implausible(clash, "s", "t", "id", FIELDS).count() == 0


def narrow(seed, spread, n=4000):
    r = random.Random(seed)
    return [[k, "a", 1_000_000 + k, b, b - 0.5 - abs(r.gauss(0, spread)), b + 0.5 + abs(r.gauss(0, spread)), "x"] for k in range(n) for b in [50 + r.gauss(0, spread)]]


def test_limits_follow_the_source(spark):
    rows, want = [], set()
    for s, spread in enumerate((0.2, 0.35, 0.5)):
        data = narrow(s, spread)
        for k, scales in ((300, 9.5), (900, -10), (1500, 12), (2100, -15), (2101, -14), (3900, 15)):
            shift(data[k], scales * spread)
            want.add((str(s), k))
        for k in range(2500, 2520):  # a noise with steep edges, 5 dB a second
            shift(data[k], min(5 * (k - 2499), 25, 5 * (2520 - k)))
        rows += [(k + s * 10_000, str(s), *x) for k, _, *x in data]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(str(x.row_id // 10_000), x.row_id % 10_000) for x in implausible(df, "s", "t", "id", FIELDS).filter("spike").collect()}
    assert got == want


def test_bursts_that_return_and_copies_of_a_second(spark):
    data, want = narrow(5, 0.4), set()
    for a, n in ((500, 13), (1500, 40)):  # slightly varying, back at the old level
        for k in range(a, a + n):
            shift(data[k], 20)
            want.add(k)
    for k in range(2500, 2505):  # recovered three times
        shift(data[k], 20)
        want.add(k)
        for c in (1, 2):
            data.append([10_000 * c + k, *data[k][1:3], *[y + 0.1 * c for y in data[k][3:6]], "x"])
            want.add(10_000 * c + k)
    shift(data[2800], -15)  # a group of many copies
    want.add(2800)
    for c in range(20):
        data.append([100_000 + c, *data[2800][1:]])
        want.add(100_000 + c)
    for k in range(3200, 4000):  # another level for good, with an error near the old one
        shift(data[k], 12)
    shift(data[3230], -12)
    want.add(3230)
    df = spark.createDataFrame([tuple(x) for x in data], SCHEMA)
    got = {x.row_id for x in implausible(df, "s", "t", "id", FIELDS).filter("spike").collect()}
    assert got == want


def test_short_segments_are_judged_by_what_is_around(spark):
    data, want = narrow(6, 0.4), set()
    keep = set(range(1000)) | {1100, 1200, 1201} | set(range(1300, 1308)) | set(range(1400, 1500)) | set(range(1600, 4000))
    for k in (1100, 1201, 1301, 1303, 1305, 1307, 1400, 1401, 1402, 1403, 1404, 1405, 1499):  # alone; one of two; half of eight; next to outages
        shift(data[k], 35)
        want.add(k)
    for k in range(1600, 4000):  # another level after the outage
        shift(data[k], 6)
    wide = narrow(7, 0.4, 1500)  # a reading every 40 s, with another level for good
    for k, x in enumerate(wide):
        x[0], x[1], x[2] = 10_000 + k, "b", 1_000_000 + 40 * k
        if k >= 900:
            shift(x, 15)
    for k in (50, 700, 1200, 1201):
        shift(wide[k], 20)
        want.add(10_000 + k)
    df = spark.createDataFrame([tuple(data[k]) for k in sorted(keep)] + [tuple(x) for x in wide], SCHEMA)
    got = {x.row_id for x in implausible(df, "s", "t", "id", FIELDS).filter("spike").collect()}
    assert got == want
