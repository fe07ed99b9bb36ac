"""Irregular readings onto a regular grid, with missing steps marked.

The series of one source is cut at the caller's segments (such as local days) and
then into time shards of fixed length.  Each shard gives a summary (its filled steps,
the first and the last of them); a prefix scan over the few summaries of a segment
carries the last filled step to the next shard that has readings; then every shard
fills its own gaps, and the one before its first reading, independently of all others.
The readings are read and combined once; a shard's summary has at most ``shard_steps``
steps, so no task sees more of a source than that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pegelwerk.operators.instants import _whole


def steps(readings: DataFrame, keys: list[str], t_ms: str, step_s: int, values: dict[str, Column]) -> DataFrame:
    """readings -> one row per keys and filled step: keys, step_s (its start), values.

    Combined on the map side, so a source with a third of all rows shuffles one row per
    step and task.  Null times are dropped.
    """
    start = _whole(F.col(t_ms), step_s * 1000) * step_s
    return readings.filter(F.col(t_ms).isNotNull()).groupBy(*keys, start.alias("step_s")).agg(*[c.alias(k) for k, c in values.items()])


def gaps(filled: DataFrame, keys: list[str], step_s: int, shard_steps: int = 240) -> DataFrame:
    """filled steps (keys, step_s) -> (keys, first_missing_s, last_missing_s), one row per gap.

    ``keys`` include the segment: nothing is filled between segments, before the first
    or after the last filled step of one.  Filled steps must be distinct.
    """
    shard = _whole(F.col("step_s"), step_s * shard_steps).alias("_shard")
    rows = filled.select(*keys, "step_s", shard)
    summary = rows.groupBy(*keys, "_shard").agg(F.array_sort(F.collect_set("step_s")).alias("_steps"))
    summary = summary.withColumns({"_first": F.col("_steps")[0], "_last": F.element_at("_steps", -1)})
    scan = Window.partitionBy(*keys).orderBy("_shard")
    carried = summary.withColumn("_carry", F.lag("_last").over(scan))
    before = F.concat(F.array(F.coalesce("_carry", "_first")), "_steps")
    between = F.zip_with(before, "_steps", lambda a, b: F.struct((a + step_s).alias("first_missing_s"), (b - step_s).alias("last_missing_s")))
    wide = F.filter(between, lambda g: F.coalesce(g["first_missing_s"] <= g["last_missing_s"], F.lit(False)))
    return carried.select(*keys, F.explode(wide).alias("g")).select(*keys, "g.*")


def missing(filled: DataFrame, keys: list[str], step_s: int, shard_steps: int = 240) -> DataFrame:
    """One row per missing step: (keys, step_s)."""
    g = gaps(filled, keys, step_s, shard_steps)
    return g.select(*keys, F.explode(F.sequence("first_missing_s", "last_missing_s", F.lit(step_s).cast("long"))).alias("step_s"))


def regular(filled: DataFrame, keys: list[str], step_s: int, shard_steps: int = 240) -> DataFrame:
    """filled and missing steps together; ``is_missing`` marks the latter, their values are null."""
    absent = missing(filled, keys, step_s, shard_steps).withColumn("is_missing", F.lit(True))
    return filled.withColumn("is_missing", F.lit(False)).unionByName(absent, allowMissingColumns=True)
