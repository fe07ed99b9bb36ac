"""Checks of exported windows against samples, reconstruction, targets and balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pegelwerk.functions import levels as L
from pegelwerk.operators.instants import _whole


def window_samples(samples: DataFrame, keys: list[str], t_ms: str, level: str, source: str, meter: str, microphone: str, window_ms: int) -> DataFrame:
    """Samples -> per keys and window: counts and energies of meter and microphone."""
    x, is_meter, is_mic = F.col(level), F.col(source) == meter, F.col(source) == microphone
    e = L.energy(x)
    return (
        samples.filter(L.valid(x) & (is_meter | is_mic))
        .groupBy(*keys, (_whole(F.col(t_ms), window_ms) * window_ms).alias("start_ms"))
        .agg(
            F.count_if(is_meter).alias("n_meter"),
            F.count_if(is_mic).alias("n_mikro"),
            F.sum(F.when(is_meter, e).otherwise(0.0)).alias("e_meter"),
            F.sum(F.when(is_mic, e).otherwise(0.0)).alias("e_mikro"),
        )
    )


def check_windows(windows: DataFrame, samples: DataFrame, keys: list[str], level: str, count: str, pure: bool, tolerance: float = 0.15) -> DataFrame:
    """Exported level against the mean of all samples of the window (``pure``: of the meter's only).

    status: BESTAETIGT or KONFLIKT by the tolerance, NICHT_PRUEFBAR without samples or level.
    """
    w = windows.join(samples, [*keys, "start_ms"], "left")
    n = F.coalesce("n_meter", F.lit(0)) + (F.lit(0) if pure else F.coalesce("n_mikro", F.lit(0)))
    e = F.col("e_meter") + (F.lit(0.0) if pure else F.col("e_mikro"))
    # rounded: a difference at the very tolerance must not hang on the order of summation
    delta = F.round(L.level_of(F.when(n > 0, e / n)) - F.col(level), 9)
    status = F.when(delta.isNull(), "NICHT_PRUEFBAR").when(F.abs(delta) <= tolerance, "BESTAETIGT").otherwise("KONFLIKT")
    return w.withColumns({"status": status, "delta": delta, "n_proben": n, "gleich": F.when(delta.isNotNull(), n == F.col(count))})


def reconstruct(windows: DataFrame, level: str, count: str, rounding: float = 0.05) -> DataFrame:
    """Meter level from the mixed level, the number of samples and the microphone's energy, with the bounds that rounding allows.

    Informative only.  A bound whose energy isn't positive is null.
    """
    n = F.col(count) - F.col("n_mikro")
    possible = F.col(level).isNotNull() & (F.col("n_mikro") > 0) & (n > 0)

    def at(x: Column) -> Column:
        rest = F.col(count) * L.energy(x) - F.col("e_mikro")
        return F.when(possible & (rest > 0), L.level_of(rest / n))

    x = F.col(level)
    out = windows.withColumns({"mitte": at(x), "unten": at(x - rounding), "oben": at(x + rounding), "n_rest": n})
    return out.withColumn("ergebnis", F.when(~F.coalesce(possible, F.lit(False)), "NICHT_BERECHENBAR").when(F.col("mitte").isNull(), "UNMOEGLICH").otherwise("BERECHNET"))


def inherit(windows: DataFrame, keys: list[str], status: Column, window_s: int, order: str) -> DataFrame:
    """One exported row covers ``window_s`` seconds: (keys, second, status); of overlapping rows the later in ``order`` wins."""
    first = F.ceil(F.col("start_ms") / 1000)
    last = F.ceil((F.col("start_ms") + window_s * 1000) / 1000) - 1
    s = windows.select(*keys, order, status.alias("status"), F.explode(F.sequence(first, last)).alias("second"))
    return s.groupBy(*keys, "second").agg(F.max_by("status", order).alias("status"))


def previous(rows: DataFrame, keys: list[str], at: str, shard: int) -> DataFrame:
    """rows with ``vor``, the value of ``at`` before in the same keys: windows over shards of ``shard`` units, and a prefix scan over the shards' last values."""
    from pyspark.sql import Window

    cut = rows.withColumn("_s", _whole(F.col(at).cast("long"), shard))
    ends = cut.groupBy(*keys, "_s").agg(F.max(at).alias("_z"))
    carry = ends.select(*keys, "_s", F.lag("_z").over(Window.partitionBy(*keys).orderBy("_s")).alias("_c"))
    w = Window.partitionBy(*keys, "_s").orderBy(at)
    return cut.join(carry, [*keys, "_s"]).withColumn("vor", F.coalesce(F.lag(at).over(w), "_c")).drop("_s", "_c")


def modal_gap(rows: DataFrame, keys: list[str], t_ms: str) -> DataFrame:
    """Most common positive gap between neighbours, in whole seconds, at least 1; of equally common ones the smaller.

    Neighbours are looked up per day, with the last row of the day before carried over, so a source is many tasks.
    """
    d = previous(rows.select(*keys, t_ms).dropna(), keys, t_ms, 86_400_000).select(*keys, (F.col(t_ms) - F.col("vor")).alias("_d")).filter("_d > 0")
    counts = d.groupBy(*keys, "_d").agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col("_d").alias("d"))).alias("b"))
    return best.select(*keys, F.greatest(F.lit(1), F.round(F.col("b.d") / 1000).cast("long")).alias("fenster_s"))


def stratified_sample(rows: DataFrame, keys: list[str], row_id: str, k: int, seed: int) -> DataFrame:
    """At most ``k`` rows per keys, by a seeded hash of the id; tasks keep k of a group before the shuffle."""
    from pegelwerk.operators.votes import top_per_group

    return top_per_group(rows, keys, [F.md5(F.concat_ws(":", F.col(row_id).cast("string"), F.lit(str(seed)))), F.col(row_id)], k).drop("rang")
