"""Streaming forms of the roll-ups, sessions and bins.

The batch operators keep no state; these keep it under a watermark.  Late rows beyond
the watermark are dropped by Spark and counted in the query's progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pegelwerk.functions import levels as L


def second_rollup(samples: DataFrame, late: str = "1 minute") -> DataFrame:
    """Stream of (messstelle, zeit, levelDb) -> per station and second: n, laeq, lmin, lmax."""
    x = F.col("levelDb")
    return (
        samples.filter(L.valid(x))
        .withWatermark("zeit", late)
        .groupBy("messstelle", F.window("zeit", "1 second").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), L.laeq(x).alias("laeq"), F.min(x).alias("lmin"), F.max(x).alias("lmax"))
        .select("messstelle", F.unix_seconds("w.start").alias("second"), "n", "laeq", "lmin", "lmax")
    )


def sessions(events: DataFrame, gap: str = "2 minutes", late: str = "10 minutes") -> DataFrame:
    """Stream of (messstelle, zeit) -> sessions with at most ``gap`` between neighbours."""
    return (
        events.withWatermark("zeit", late)
        .groupBy("messstelle", F.session_window("zeit", gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("ereignisse"), F.min("zeit").alias("start"), F.max("zeit").alias("ende"))
        .drop("w")
    )


def bins(events: DataFrame, width: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Stream of (messstelle, zeit, label, dBA) -> weight of each label in each bin."""
    return (
        events.withWatermark("zeit", late)
        .groupBy("messstelle", F.window("zeit", width).alias("w"), "label")
        .agg(F.sum(F.coalesce("dBA", F.lit(0.0))).alias("gewicht"), F.count(F.lit(1)).alias("clips"))
        .select("messstelle", F.unix_seconds("w.start").alias("start"), "label", "gewicht", "clips")
    )


def sliding_laeq(samples: DataFrame, late: str = "1 minute") -> DataFrame:
    """Level of the minute that ends at each ten seconds."""
    return (
        samples.filter(L.valid(F.col("levelDb")))
        .withWatermark("zeit", late)
        .groupBy("messstelle", F.window("zeit", "60 seconds", "10 seconds").alias("w"))
        .agg(L.laeq(F.col("levelDb")).alias("laeq"), F.count(F.lit(1)).alias("n"))
        .select("messstelle", F.unix_seconds("w.end").alias("ende"), "laeq", "n")
    )


def new_files(spark, path: str, schema: str, checkpoint: str, into: str):
    """Reads files that arrived since the last run, appends them, and stops: an unchanged folder is no work."""
    stream = spark.readStream.schema(schema).parquet(path)
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").option("path", into).start()
