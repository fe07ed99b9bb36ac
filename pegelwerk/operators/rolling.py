"""Rolling windows over sparse seconds.

Missing seconds are never written out.  A range frame over sparse rows equals the
rolling window over a dense grid at measured seconds; where a window may also end at
an unmeasured second, it is enough to look at the seconds at which the window's content
changes.  All windows are partitioned by keys that bound a group, such as station and
day, so a station with a third of all rows is many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pegelwerk.functions import levels as L


def rolling_laeq(seconds: DataFrame, keys: list[str], span: int = 60, least: int = 20) -> DataFrame:
    """LAeq of the ``span`` seconds that end at each measured second, null under ``least`` values."""
    w = Window.partitionBy(*keys).orderBy("second").rangeBetween(-(span - 1), 0)
    n = F.count("leq").over(w)
    return seconds.withColumn("rollend", F.when(n >= least, L.level_of(F.avg(L.energy(F.col("leq"))).over(w))))


def centred(seconds: DataFrame, keys: list[str], span: int = 30, least: int = 15) -> DataFrame:
    """Mean and sample deviation of [t - span / 2, t + span / 2 - 1] at each measured second."""
    w = Window.partitionBy(*keys).orderBy("second").rangeBetween(-(span // 2), span - span // 2 - 1)
    n = F.count("leq").over(w)
    return seconds.withColumns(
        {"mittel": F.when(n >= least, F.avg("leq").over(w)), "streuung": F.when(n >= least, F.stddev_samp("leq").over(w))}
    )


def loudest_hour(seconds: DataFrame, keys: list[str], least: int = 1800, strict_start: bool = True, span: int = 3600, bounds: tuple[str, str] | None = None) -> DataFrame:
    """Per keys the loudest window of ``span`` seconds: its last second, valid seconds and LAeq.

    Windows need ``least`` measured seconds.  With ``strict_start`` the first window starts at
    the first measured second; else windows may be shorter at the start.  None ends after the last
    measured second, but the first full one.  Of equally loud windows the earliest wins.  ``bounds`` are columns with a
    day's first second and the one after its last: only seconds inside count, and windows end inside.

    Energies are summed as decimals: what has left the window leaves no residue, however loud it was.
    """
    day_end = F.lit(None).cast("long")
    if bounds:
        seconds = seconds.filter((F.col("second") >= F.col(bounds[0])) & (F.col("second") < F.col(bounds[1])))
        day_end = F.col(bounds[1]).cast("long")
    w = Window.partitionBy(*keys)
    first, last = F.min("second").over(w), F.max("second").over(w)
    known = seconds.filter(F.col("leq").isNotNull()).select(*keys, "second", L.energy(F.col("leq")).cast("decimal(28,9)").alias("e"), first.alias("_first"), last.alias("_last"), day_end.alias("_day_end"))
    # the window's content as a running sum: a second enters at its time and leaves a span later
    step = lambda t, sign: F.struct(t.alias("t"), (F.col("e") if sign > 0 else -F.col("e")).alias("e"), F.lit(sign).alias("n"))
    start = F.when(F.col("second") == F.col("_first"), F.struct((F.col("_first") + (span - 1)).alias("t"), F.lit(0).cast("decimal(28,9)").alias("e"), F.lit(0).alias("n")))
    steps = F.explode(F.array_compact(F.array(step(F.col("second"), 1), step(F.col("second") + span, -1), start)))
    moves = known.select(*keys, "_first", "_last", "_day_end", steps.alias("x")).select(*keys, "_first", "_last", "_day_end", "x.*")
    frame = Window.partitionBy(*keys).orderBy("t").rangeBetween(Window.unboundedPreceding, 0)
    ends = moves.select(*keys, "_first", "_last", "_day_end", "t", F.sum("e").over(frame).cast("double").alias("e"), F.sum("n").over(frame).alias("n"))
    earliest = F.col("_first") + (span - 1 if strict_start else 0)
    ends = ends.filter((F.col("t") >= earliest) & (F.col("t") <= F.greatest(F.col("_last"), F.col("_first") + (span - 1))) & (F.col("n") >= least))
    ends = ends.filter(F.coalesce(F.col("t") < F.col("_day_end"), F.lit(True)))
    # rounded, so that the same content summed in another order is the same window
    best = ends.groupBy(*keys).agg(F.max(F.struct(F.round(L.level_of(F.col("e") / F.col("n")), 9).alias("laeq"), (-F.col("t")).alias("t"), "n")).alias("b"))
    return best.select(*keys, (-F.col("b.t")).alias("ende"), F.col("b.n").alias("sekunden"), F.col("b.laeq").alias("laeq"))
