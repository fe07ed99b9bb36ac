"""From samples to seconds, from seconds to days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pegelwerk.functions import levels as L
from pegelwerk.operators.instants import _whole, utc_to_wall


def uniform(c: str, otherwise: str) -> Column:
    """The group's only value (aggregate), else the given one; nulls break uniformity."""
    same = (F.min(c) == F.max(c)) & (F.count(c) == F.count(F.lit(1)))
    return F.when(same, F.min(c)).otherwise(F.lit(otherwise))


def rollup(samples: DataFrame, keys: list[str], t_ms: str, level: str, row_id: str, source: str | None = None) -> DataFrame:
    """Samples -> one row per keys and second: n, laeq, lmin, lmax, last sample, id range.

    Invalid levels are dropped.  Partial aggregates; ``letzter`` is the level at the largest (time, id).
    """
    x = F.col(level)
    second = _whole(F.col(t_ms).cast("long"), 1000)
    extra = [uniform(source, "GEMISCHT").alias("quelle")] if source else []
    return (
        samples.filter(L.valid(x))
        .groupBy(*keys, second.alias("second"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            L.laeq(x).alias("laeq"),
            F.min(x).alias("lmin"),
            F.max(x).alias("lmax"),
            F.max_by(x, F.struct(t_ms, row_id)).alias("letzter"),
            F.min(row_id).alias("id_von"),
            F.max(row_id).alias("id_bis"),
            *extra,
        )
    )


def merge_seconds(rows: DataFrame, keys: list[str], second: str, leq: str, maximum: str) -> DataFrame:
    """Several rows of one second become one: energetic mean, largest maximum."""
    m = F.col(maximum)
    return (
        rows.filter(L.valid(F.col(leq)) & F.col(second).isNotNull())
        .groupBy(*keys, F.col(second).cast("long").alias("second"))
        .agg(L.laeq(F.col(leq)).alias("leq"), F.max(F.when(L.valid(m), m)).alias("maximum"), F.count(F.lit(1)).alias("n"))
    )


def merge_full(rows: DataFrame, keys: list[str], second: str, leq: str, maximum: str, source: str, others: list[str], order: str) -> DataFrame:
    """``merge_seconds`` with provenance: the only source or GEMISCHT, and of each other column the first value that is there, by ``order``."""
    m = F.col(maximum)
    return (
        rows.filter(L.valid(F.col(leq)) & F.col(second).isNotNull())
        .groupBy(*keys, F.col(second).cast("long").alias("second"))
        .agg(
            L.laeq(F.col(leq)).alias("leq"), F.max(F.when(L.valid(m), m)).alias("maximum"), F.count(F.lit(1)).alias("n"), uniform(source, "GEMISCHT").alias("quelle"),
            *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in others],
        )
    )


def nearest_on_grid(rows: DataFrame, keys: list[str], second: str, step: int) -> DataFrame:
    """(keys, minute, quelle): each grid point with the nearest measured second, at most ``step`` away; of equally near ones the earlier.

    A second can only be nearest to the grid points around it, so nothing is joined and partial results are combined.
    """
    low = _whole(F.col(second), step) * step
    c = rows.select(*keys, F.col(second).alias("_q"), F.explode(F.array(low, low + step)).alias("minute"))
    best = F.min(F.struct(F.abs(F.col("_q") - F.col("minute")).alias("d"), "_q"))
    return c.groupBy(*keys, "minute").agg(best.alias("b")).select(*keys, "minute", F.col("b._q").alias("quelle"))


def with_local(df: DataFrame, zone: str, second: str = "second") -> DataFrame:
    """Adds the local day (date) and second of day."""
    wall = utc_to_wall(F.col(second) * 1000, zone)
    return df.withColumns(
        {"tag": F.date_from_unix_date(_whole(wall, 86_400_000).cast("int")), "sod": (F.pmod(wall, F.lit(86_400_000).cast("long")) / 1000).cast("int")}
    )


def day_metrics(seconds: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys: measured seconds, coverage, tier, LAeq, maximum, exceeded level L1, seconds and share over 55."""
    x = F.col("leq")
    n = F.count(F.lit(1))
    return seconds.groupBy(*keys).agg(
        n.alias("sekunden"),
        (n / L.DAY_SECONDS).alias("abdeckung"),
        L.tier(n / L.DAY_SECONDS).alias("stufe"),
        L.laeq(x).alias("laeq"),
        F.max("maximum").alias("lmax"),
        F.percentile(x, 0.99).alias("l1"),
        F.count_if(x > 55).alias("ueber55"),
        F.avg((x > 55).cast("double")).alias("anteil55"),
    )


def takt_maximum(seconds: DataFrame, keys: list[str], block: int = 5) -> DataFrame:
    """``lr``, the energetic mean of the maxima of blocks of consecutive measured values (the rest of a day is dropped), and ``ki``, what it lies above the LAeq.

    ``keys`` must bound the group (such as station and day): its rows are numbered in one task.
    """
    k = F.row_number().over(Window.partitionBy(*keys).orderBy("second")) - 1
    blocks = seconds.withColumn("_b", F.floor(k / block)).groupBy(*keys, "_b").agg(F.max("leq").alias("m"), F.count(F.lit(1)).alias("c"))
    out = blocks.filter(F.col("c") == block).groupBy(*keys).agg(L.laeq(F.col("m")).alias("lr"), F.count(F.lit(1)).alias("takte"))
    level = seconds.groupBy(*keys).agg(L.laeq(F.col("leq")).alias("_l"))
    return out.join(level, keys).withColumn("ki", F.col("lr") - F.col("_l")).drop("_l")
