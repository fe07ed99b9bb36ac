"""Cutting lineage in the folder that all executors share, and broadcasts of checked size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's own folder under spark.checkpoint.dir.

    Where none is set, a temporary one is made on a single machine (tests); on a cluster that is an
    error, since executors do not share the driver's disk.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="pegelwerk-checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and checkpointed in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared folder as a table: later steps read only the columns they need."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, most: int = 100_000, most_bytes: int = 8 << 20) -> DataFrame:
    """df, computed once, with a broadcast hint if it has at most ``most`` rows and ``most_bytes`` of text; else as it is, for a shuffled join."""
    df = cut(df)
    text = [F.octet_length(c) for c, kind in df.dtypes if kind == "string"]
    size = sum((F.coalesce(x, F.lit(0)) for x in text), F.lit(0))
    n, b = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= most and b <= most_bytes else df
