from datetime import date, datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from pegelwerk.operators import instants as I

BERLIN = ZoneInfo("Europe/Berlin")


def ms(y, mo, d, h=0, mi=0, s=0, frac=0, tz=timezone.utc, fold=0):
    return int(datetime(y, mo, d, h, mi, s, tzinfo=tz, fold=fold).timestamp()) * 1000 + frac


CASES = [
    ("2023-03-06T17:50:51.966461+00:00", None, ms(2023, 3, 6, 17, 50, 51, 966)),
    ("2023/03/13 15:18:54 UTC", None, ms(2023, 3, 13, 15, 18, 54)),
    ("20230315T114658Z", None, ms(2023, 3, 15, 11, 46, 58)),
    ("02.01.2025 17:59", None, ms(2025, 1, 2, 17, 59, tz=BERLIN)),
    ("02.05.2023 08:02:52 MESZ", None, ms(2023, 5, 2, 6, 2, 52)),
    ("2023-03-24 08:28:58 CET", None, ms(2023, 3, 24, 7, 28, 58)),
    ("2023-04-18T13:46:30.603+0800", None, ms(2023, 4, 18, 5, 46, 30, 603)),
    ("2025-10-26T02:22:07.035-0700", None, ms(2025, 10, 26, 9, 22, 7, 35)),
    ("Oct 13, 2025 2:24:05 PM UTC", None, ms(2025, 10, 13, 14, 24, 5)),
    ("Nov 11, 2023 12:03:46 AM UTC", None, ms(2023, 11, 11, 0, 3, 46)),
    ("Sat, 08 Nov 2025 17:35:46 GMT", None, ms(2025, 11, 8, 17, 35, 46)),
    ("2023-03-20T06:50:38.800321051Z", None, ms(2023, 3, 20, 6, 50, 38, 800)),
    ("1679796464.917", None, 1679796464917),
    ("1679796464", None, 1679796464000),
    ("1680979956349276", None, 1680979956349),
    ("05.02.11", date(2024, 1, 5), ms(2024, 1, 5, 5, 2, 11, tz=BERLIN)),
    ("5.02 Uhr", date(2024, 1, 5), ms(2024, 1, 5, 5, 2, tz=BERLIN)),
    ("050036", date(2024, 1, 5), ms(2024, 1, 5, 5, 0, 36, tz=BERLIN)),
    ("05h03m58s", date(2024, 7, 5), ms(2024, 7, 5, 5, 3, 58, tz=BERLIN)),
    ("T00:02:08", date(2024, 7, 5), ms(2024, 7, 5, 0, 2, 8, tz=BERLIN)),
    ("12:25:14 AM", date(2024, 7, 5), ms(2024, 7, 5, 0, 25, 14, tz=BERLIN)),
    ("8:25:09 p.m.", date(2024, 7, 5), ms(2024, 7, 5, 20, 25, 9, tz=BERLIN)),
    ("00:24:03,8", date(2024, 7, 5), ms(2024, 7, 5, 0, 24, 3, 800, tz=BERLIN)),
    ("01:49:43+09:00", date(2024, 7, 5), ms(2024, 7, 4, 16, 49, 43)),
    ("03:26:46+02", date(2024, 7, 5), ms(2024, 7, 5, 1, 26, 46)),
    # a repeated hour is the first one unless the text says otherwise
    ("02:30:00", date(2024, 10, 27), ms(2024, 10, 27, 0, 30)),
    ("2A:41:41", date(2025, 10, 26), ms(2025, 10, 26, 0, 41, 41)),
    ("2B:03:42", date(2024, 10, 27), ms(2024, 10, 27, 1, 3, 42)),
    ("02:30:00 MEZ", date(2024, 10, 27), ms(2024, 10, 27, 1, 30)),
    # a skipped hour has the offset before the change
    ("02:30:00", date(2024, 3, 31), ms(2024, 3, 31, 1, 30)),
    # a date in the text wins
    ("06.03.2023 07:23:28", date(2020, 1, 1), ms(2023, 3, 6, 7, 23, 28, tz=BERLIN)),
    ("2023-03-06T07:15:12+01:00", date(2020, 1, 1), ms(2023, 3, 6, 6, 15, 12)),
    # nothing to read
    ("", date(2024, 1, 5), None),
    ("gestern", date(2024, 1, 5), None),
    ("25:00:00", date(2024, 1, 5), None),
    ("31.02.2024 10:00", None, None),
    ("10:00", None, None),
    (None, date(2024, 1, 5), None),
    ("x" * 100_000, date(2024, 1, 5), None),
]


def test_texts(spark):
    rows = [(k, t, d) for k, (t, d, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "k int, t string, d date")
    for zone in ("UTC", "America/New_York"):  # the session's zone has no say
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = {r.k: r.u for r in df.select("k", I.to_utc(I.parse_text(F.col("t"), F.col("d")), "Europe/Berlin").alias("u")).collect()}
        bad = [(CASES[k], got[k]) for k in got if got[k] != CASES[k][2]]
        assert not bad
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("value, expected", [(1678082458, 1678082458000), (1678082458714, 1678082458714), (1678082458714999, 1678082458714), (1678088277566879472, 1678088277566), (None, None)])
def test_epochs(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v bigint")
    assert df.select(I.parse_epoch(F.col("v"))).first()[0] == expected


def wall(u):
    return int(datetime.fromtimestamp(u / 1000, BERLIN).replace(tzinfo=timezone.utc).timestamp() * 1000)


def test_zone_by_reference_changes_in_mid_series(spark):
    """A station's clock is in Berlin for ten days and in UTC from then on; another one has no reference."""
    rows = []
    for d in range(20):
        for k in range(6):
            u = ms(2024, 6, 1 + d, 8 + k)
            rows.append(("a", d, wall(u) if d < 10 else u, None if k == 5 else u, "Europe/Berlin", u))
            rows.append(("b", d, wall(u), None, "Europe/Berlin", u))
    rows.append((None, 0, wall(u), u, "Europe/Berlin", u))
    rows.append(("a", 0, None, u, "Europe/Berlin", u))
    df = spark.createDataFrame(rows, "q string, d int, w bigint, ref bigint, z string, truth bigint")
    got = I.by_reference(df, ["q", "d"], "w", "ref", "z")
    assert got.filter(F.col("w").isNotNull() & (I.wall_to_utc(F.col("w"), F.col("zone")) != F.col("truth"))).count() == 0
    h = {(r.q, r.von, r.bis, r.zone) for r in I.history(got.dropna(subset=["q"]), "q", "d").collect()}
    assert h == {("a", 0, 9, "Europe/Berlin"), ("a", 10, 19, "UTC"), ("b", 0, 19, "Europe/Berlin")}


def test_zone_by_order_of_sessions(spark):
    """Sessions one after the other; two of them state the wrong zone. Repeated hours and lonely sessions keep the statement."""
    rows, wrong = [], {7: "Europe/Berlin", 25: "UTC"}
    for k in range(30):  # through the night and over the end of summer time
        a, b = ms(2024, 10, 26, 14) + k * 1_800_000, ms(2024, 10, 26, 14) + k * 1_800_000 + 1_700_000
        zone = "Europe/Berlin" if k % 2 else "UTC"
        local = zone == "Europe/Berlin"
        if k in wrong:
            zone, local = wrong[k], wrong[k] == "UTC"
        rows.append(("a", k, wall(a) if local else a, wall(b) if local else b, zone))
    rows += [("far", 100, ms(2024, 1, 1), ms(2024, 1, 2), "UTC"), (None, 101, 0, 0, "UTC"), ("a", 102, None, None, "UTC")]
    df = spark.createDataFrame(rows, "q string, s bigint, a bigint, b bigint, z string")
    got = {r.s: (r.z, r.zone) for r in I.by_order(df, "q", "s", "a", "b", "z").collect()}
    assert len(got) == len(rows)
    assert {s for s, (z, zone) in got.items() if z != zone} == set(wrong)


def test_zone_between_known_instants(spark):
    """Fetches every few minutes over several stretches; in one of them bare texts are in Berlin."""
    rows = []
    for k in range(400):
        u = ms(2024, 6, 1) + k * 300_000
        bare = k % 3 == 0
        rows.append((k, (wall(u) if 100 <= k < 200 else u) if bare else None, None if bare else u, "UTC"))
    rows.append((None, ms(2024, 6, 1), None, "UTC"))
    df = spark.createDataFrame(rows, "s bigint, w bigint, known bigint, z string")
    got = {r.s: r.zone for r in I.between_known(df, "s", "w", "known", "z", block=100, halo=10).collect()}
    assert len(got) == 401 and {s for s, z in got.items() if z != "UTC"} == set(range(100, 200))


def test_empty(spark):
    df = spark.createDataFrame([], "q string, s bigint, a bigint, b bigint, z string")
    assert I.by_order(df, "q", "s", "a", "b", "z").count() == 0
    assert I.by_reference(df, ["q"], "a", "b", "z").count() == 0
    assert I.between_known(df, "s", "a", "b", "z").count() == 0
