"""Copies of a clip with fields emptied."""

import datetime
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

DAY = datetime.date(2024, 1, 10)
NOON = 1_704_884_400_000  # 2024-01-10 12:00 in Berlin


@pytest.fixture
def tables(spark, sf_dir, tmp_path):
    """The tables with these events alone: rows of (WAV, messstelle, Datum, Uhrzeit, Timestamp_ms, dBA)."""

    def make(events, **others):
        for p in Path(sf_dir).glob("*.parquet"):
            if p.stem not in {"relevante_ereignisse", *others}:
                shutil.copy(p, tmp_path / p.name)
        for name, rows in {"relevante_ereignisse": events, **others}.items():
            kinds = dict(spark.read.parquet(f"{sf_dir}/{name}.parquet").dtypes)
            df = spark.createDataFrame(rows[1:], ", ".join(f"{c} {kinds[c]}" for c in rows[0]))
            df.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in rows[0]}).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make


HEAD = ("WAV", "messstelle", "Datum", "Uhrzeit", "Timestamp_ms", "dBA")


def test_p6_reads_every_copy(spark, tables):
    events = [HEAD]
    for wav, copies in {
        "blank": [(DAY, " "), (DAY, "12:00:00")],
        "empty": [(DAY, "12:00:00"), (DAY, "")],
        "unreadable": [(DAY, "12 ?"), (DAY, "12:00:00")],
        "apart": [(DAY, ""), (None, "12:00:00")],
        "nulls": [(DAY, None), (None, None), (DAY, "12:00:00")],
        "nothing": [(DAY, " "), (DAY, None)],
    }.items():
        events += [(wav, "a", d, u, None, 50.0) for d, u in copies]
    got = entry.queries()["p6_found"](spark, tables(events)).filter("tabelle = 'relevante_ereignisse'").collect()
    assert {(r.schluessel, r.utc_ms) for r in got} == {(w, NOON) for w in ("blank", "empty", "unreadable", "apart", "nulls")}


def test_emptied_copies_of_a_clip(spark, tables):
    at = NOON
    events = [HEAD] + [(w, m, d, None, at + 1000 * k, 50.0 + k) for k, w in enumerate("abc") for m, d in (("st", DAY), ("st", None), (None, DAY))]
    sf = tables(events)
    assert [tuple(r) for r in entry.queries()["p4_found"](spark, sf).collect()] == [("st", at, at + 2000, 3, "c")]
