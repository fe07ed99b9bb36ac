"""Runs of seconds as intervals, and joins with intervals.

Intervals are half open, [begin, end), in whole seconds.  Every window is partitioned by
keys that bound a group (station and day, ...); a join between points and intervals, or
between intervals, gets an equality: both sides carry the time buckets they touch, so
neither a cross join nor a nested loop over a hot key is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pegelwerk.functions import levels as L
from pegelwerk.operators.instants import _whole, local_day, wall_to_utc


def islands(points: DataFrame, keys: list[str], at: str, gap: int, least: int = 0, aggs: dict[str, Column] | None = None) -> DataFrame:
    """Points at most ``gap`` apart form one run -> keys, begin, end, punkte and the given aggregates.

    ``end`` is one after the last point; runs whose last point lies less than ``least`` after their
    first are dropped.
    """
    w = Window.partitionBy(*keys).orderBy(at)
    new = F.coalesce(F.col(at) - F.lag(at).over(w) > gap, F.lit(True)).cast("int")
    runs = points.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w))
    out = runs.groupBy(*keys, "_run").agg(
        F.min(at).alias("begin"), (F.max(at) + 1).alias("end"), F.count(F.lit(1)).alias("punkte"), *[c.alias(k) for k, c in (aggs or {}).items()]
    )
    return out.filter(F.col("end") - 1 - F.col("begin") >= least).drop("_run")


def merged(intervals: DataFrame, keys: list[str], gap: int = 0) -> DataFrame:
    """Union of intervals that overlap or lie at most ``gap`` apart -> keys, begin, end, teile."""
    w = Window.partitionBy(*keys).orderBy("begin", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("begin") > reach + gap, F.lit(True)).cast("int")
    runs = intervals.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "_run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"), F.count(F.lit(1)).alias("teile")).drop("_run")


def gaps(intervals: DataFrame, keys: list[str], least: int = 0) -> DataFrame:
    """Between neighbouring intervals that don't overlap: keys, begin, end of what is longer than ``least``."""
    w = Window.partitionBy(*keys).orderBy("begin")
    after = F.lead("begin").over(w)
    return intervals.select(*keys, F.col("end").alias("begin"), after.alias("_e")).filter(F.col("_e") - F.col("begin") > least).withColumnRenamed("_e", "end")


def by_day(intervals: DataFrame, zone: str) -> DataFrame:
    """Intervals cut at local midnight, with ``tag``, the local day of each piece; empty and null ones go.

    So what follows is grouped by source and day, and no window holds a source's whole time.
    """
    day = lambda c: local_day(F.col(c) * 1000, zone)
    midnight = lambda d: F.call_function("div", wall_to_utc(d.cast("long") * 86_400_000, zone), F.lit(1000).cast("long"))
    days = intervals.filter(F.col("end") > F.col("begin")).withColumn("_e", F.col("end") - 1)
    days = days.withColumn("_d", F.explode(F.sequence(day("begin"), day("_e"))))
    out = days.withColumns({"begin": F.greatest("begin", midnight(F.col("_d"))), "end": F.least("end", midnight(F.col("_d") + 1))})
    return out.withColumn("tag", F.date_from_unix_date("_d")).drop("_d", "_e")


def _buckets(begin: Column, end: Column, width: int) -> Column:
    """Every bucket that [begin, end) touches; none for empty or null intervals."""
    some = F.coalesce(end > begin, F.lit(False))
    return F.when(some, F.sequence(_whole(begin, width), _whole(end - 1, width))).otherwise(F.array().cast("array<bigint>"))


def points_in(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, how: str = "inner", width: int = 3600) -> DataFrame:
    """Join of points with the intervals of the same keys that contain them; how: inner, left_semi or left_anti.

    A point may lie in several intervals; under inner each gives a row.
    """
    p = points.withColumn("_b", _whole(F.col(at).cast("long"), width))
    i = intervals.withColumn("_ib", F.explode(_buckets(F.col("begin").cast("long"), F.col("end").cast("long"), width)))
    for k in keys:
        i = i.withColumnRenamed(k, f"_i_{k}")
    on = [F.col("_b") == F.col("_ib"), F.col(at) >= F.col("begin"), F.col(at) < F.col("end"), *[F.col(k) == F.col(f"_i_{k}") for k in keys]]
    return p.join(i, on, how).drop("_b", "_ib", *[f"_i_{k}" for k in keys])


def covered(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, name: str, width: int = 3600) -> DataFrame:
    """points with ``name``: some interval of the same keys contains them. Each point stays one row, repeated ones too.

    Intervals are clipped to the time buckets they touch; those of one bucket become one list, looked up by its key.
    """
    i = intervals.select(*keys, F.col("begin").cast("long").alias("_a"), F.col("end").cast("long").alias("_z"))
    i = i.withColumn("_b", F.explode(_buckets(F.col("_a"), F.col("_z"), width)))
    # a bucket holds no more different pieces than it has units
    i = i.select(*keys, "_b", F.greatest("_a", F.col("_b") * width).alias("a"), F.least("_z", (F.col("_b") + 1) * width).alias("z"))
    lists = i.groupBy(*keys, "_b").agg(F.collect_set(F.struct("a", "z")).alias("_l"))
    p = points.withColumn("_b", _whole(F.col(at).cast("long"), width)).join(lists, [*keys, "_b"], "left")
    inside = F.exists("_l", lambda x: (F.col(at) >= x["a"]) & (F.col(at) < x["z"]))
    return p.withColumn(name, F.coalesce(inside, F.lit(False))).drop("_b", "_l")


def overlaps(a: DataFrame, b: DataFrame, keys: list[str], width: int = 3600) -> DataFrame:
    """Pairs of intervals of the same keys that overlap, with their common seconds; b's bounds become b_begin, b_end.

    A pair is kept in the bucket where its common part begins only, so it is found once.
    """
    x = a.withColumn("_b", F.explode(_buckets(F.col("begin").cast("long"), F.col("end").cast("long"), width)))
    y = b.withColumnsRenamed({"begin": "b_begin", "end": "b_end"})
    y = y.withColumn("_b", F.explode(_buckets(F.col("b_begin").cast("long"), F.col("b_end").cast("long"), width)))
    both = x.join(y, [*keys, "_b"]).filter((F.col("begin") < F.col("b_end")) & (F.col("end") > F.col("b_begin")))
    common = F.greatest("begin", "b_begin")
    return both.filter(F.col("_b") == _whole(common.cast("long"), width)).withColumn("gemeinsam", F.least("end", "b_end") - common).drop("_b")


def spans(seconds: DataFrame, keys: list[str], above: float = 70.0, spread: float = 4.0, gap: int = 15, least: int = 60) -> DataFrame:
    """Runs of even, loud noise: rolling mean above, rolling deviation below, gaps bridged.

    The rolling values are taken at measured seconds; bounds are measured seconds too.
    """
    from pegelwerk.operators.rolling import centred

    # rounded, so that a window at the very threshold does not hang on the order of summation
    loud = centred(seconds, keys).filter((F.round("mittel", 9) > above) & (F.round("streuung", 9) < spread))
    x = F.col("leq")
    return islands(loud, keys, "second", gap, least - 1, {"leq": L.laeq(x), "lmax": F.max(x)})


def duration_phases(
    seconds: DataFrame, keys: list[str], exclusions: DataFrame | None = None, threshold: float = 60.0, minutes: int = 10, above_s: int = 600
) -> DataFrame:
    """Long loud phases: runs of minutes whose energetic mean reaches the threshold.

    Neighbouring minutes belong together if their samples are at most 61 s apart; one minute without
    any sample may lie between, a measured quiet minute or an excluded second ends the phase.  A phase
    needs ``minutes`` minutes and ``above_s`` seconds above the threshold.  Exclusions (keys, begin,
    end) must be merged; they are applied before minutes are formed.
    """
    keyed = seconds.withColumn("_seg", F.lit(0).cast("long"))
    if exclusions is not None:
        # the segment of a second: how many exclusions have ended; excluded seconds disappear
        marks = exclusions.select(*keys, F.col("end").alias("second"), F.lit(None).cast("double").alias("leq"), F.lit(1).alias("_m"))
        free = points_in(seconds, exclusions, keys, "second", "left_anti").select(*keys, "second", "leq", F.lit(0).alias("_m"))
        w = Window.partitionBy(*keys).orderBy("second", F.desc("_m"))
        keyed = free.unionByName(marks).withColumn("_seg", F.sum("_m").over(w)).filter(F.col("_m") == 0)
    part = [*keys, "_seg"]
    x = F.col("leq")
    m = keyed.filter(x.isNotNull()).groupBy(*part, _whole(F.col("second"), 60).alias("_min")).agg(
        F.avg(L.energy(x)).alias("e"),
        F.min("second").alias("_first"),
        F.max("second").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.count_if(x > threshold).alias("_over"),
    )
    high = F.col("e") >= 10 ** (threshold / 10) * (1 - 1e-12)
    w = Window.partitionBy(*part).orderBy("_min")
    # the minute before in the whole series: if it isn't high, or too far off, a phase begins
    far = (F.col("_min") - F.lag("_min").over(w) > 2) | (F.col("_first") - F.lag("_last").over(w) > 61)
    new = (high & F.coalesce(far | ~F.lag(high).over(w), F.lit(True))).cast("int")
    m = m.withColumn("_high", high).withColumn("_new", new).withColumn("_run", F.sum("_new").over(w)).filter("_high")
    out = m.groupBy(*part, "_run").agg(
        F.min("_first").alias("begin"), (F.max("_last") + 1).alias("end"), F.count(F.lit(1)).alias("minuten"), F.sum("_n").alias("gemessen"), F.sum("_over").alias("ueber")
    )
    out = out.filter((F.col("minuten") >= minutes) & (F.col("ueber") >= above_s))
    return out.select(*keys, "begin", "end", "minuten", "gemessen", "ueber", (F.col("end") - F.col("begin") - F.col("gemessen")).alias("luecken"))


def valid_phases(intervals: DataFrame, keys: list[str], expected: int = 3) -> DataFrame:
    """keys, befund: ok, or the first fault: 'anzahl' if there are not exactly ``expected``, else that of ``ordered_fault`` (the last may be open)."""
    f = ordered_fault(intervals, keys)
    first = F.min_by("befund", F.when(F.col("befund") != "ok", F.struct("begin")))
    g = f.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), first.alias("_f"))
    return g.select(*keys, F.when(F.col("_n") != expected, "anzahl").otherwise(F.coalesce("_f", F.lit("ok"))).alias("befund"))


def ordered_fault(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Sequential check: 'ende' if an interval ends before it begins, 'folge' if it begins before the one before ended, else 'ok'.

    A null end is open and only valid for the last one ('offen' otherwise).
    """
    w = Window.partitionBy(*keys).orderBy("begin")
    before = F.lag("end").over(w)
    first = F.lag("begin").over(w).isNull()
    return intervals.withColumn(
        "befund",
        F.when(F.col("end") < F.col("begin"), "ende").when(~first & before.isNull(), "offen").when(F.col("begin") < before, "folge").otherwise("ok"),
    )
