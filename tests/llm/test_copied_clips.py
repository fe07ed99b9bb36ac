"""Copies of a clip with fields emptied, against the readings near it."""

import datetime
import shutil
from pathlib import Path

from pyspark.sql import functions as F

from pegelwerk.llm.p02 import p2_found

DAY, AT = datetime.date(2024, 1, 10), 1_704_884_400_000


def test_emptied_copies_of_a_clip(spark, sf_dir, tmp_path):
    clips = [(w, m, d, AT + 1000 * k) for k, w in enumerate("abc") for m, d in (("st", DAY), ("st", None), (None, DAY))]
    tables = {"relevante_ereignisse": (("WAV", "messstelle", "Datum", "Timestamp_ms"), clips), "level_samples": (("id", "messstelle", "at"), [(7, "st", AT)])}
    for p in Path(sf_dir).glob("*.parquet"):
        if p.stem not in tables:
            shutil.copy(p, tmp_path / p.name)
            continue
        kinds = dict(spark.read.parquet(str(p)).dtypes)
        head, rows = tables[p.stem]
        df = spark.createDataFrame(rows, ", ".join(f"{c} {kinds[c]}" for c in head))
        df.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in head}).write.parquet(str(tmp_path / p.name))
    got = p2_found(spark, str(tmp_path)).filter("tabelle = 'level_samples'").collect()
    assert sorted((r.wav, r.partner_id) for r in got) == [("a", 7), ("b", 7), ("c", 7)]
