"""The dealt queries over tables with nulls everywhere, repeated rows, clashing extra columns, and over empty tables."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

FOUND = [n for n in entry.queries() if n.endswith("_found") or n.startswith("p7_c")]
EXTRA = ["_group", "_rank", "shard", "own", "t", "row_id", "_b", "utc_ms", "gap", "start", "tokens", "_by", "_rang", "spans", "wert", "distance"]


@pytest.fixture(scope="module")
def odd(spark, sf_dir, tmp_path_factory):
    """Every table: as it is, once more, and each row again with one column null; with extra columns."""
    out = tmp_path_factory.mktemp("odd")
    empty = tmp_path_factory.mktemp("empty")
    for p in Path(sf_dir).glob("*.parquet"):
        df = spark.read.parquet(str(p))
        df.limit(0).write.parquet(str(empty / p.name))
        if p.stem in ("lineitem", "orders", "customer", "part", "embeddings", "events", "vertrauen"):
            shutil.copy(p, out / p.name)
            continue
        some = df.limit(60)
        rows = df.unionByName(some)
        for c, kind in df.dtypes:
            rows = rows.unionByName(some.limit(15).withColumn(c, F.lit(None).cast(kind)))
            if kind == "double":
                rows = rows.unionByName(some.limit(5).withColumn(c, F.lit(float("nan"))))
            if kind == "string":
                rows = rows.unionByName(some.limit(5).withColumn(c, F.lit(" ")))
        have = {c.lower() for c in df.columns}
        rows.withColumns({c: F.lit("clash") for c in EXTRA if c.lower() not in have}).write.parquet(str(out / p.name))
    return str(out), str(empty)


@pytest.mark.parametrize("name", FOUND)
def test_odd(spark, odd, name):
    df = entry.queries()[name](spark, odd[0])
    rows = df.collect()
    assert rows
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
        assert all(v is not None for r in rows for k, v in r.asDict().items() if k != "lautester_clip")


@pytest.mark.parametrize("name", FOUND)
def test_empty(spark, odd, name):
    assert entry.queries()[name](spark, odd[1]).count() == 0
