"""Weather bins: runs, events, exclusions, sensitivity, totals, circular means.

A bin is named by its end; it covers (end - width, end].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pegelwerk.functions import levels as L
from pegelwerk.operators.instants import _whole


def runs(bins: DataFrame, keys: list[str], end: str, active: Column, width: int, bridge: int = 0, known: Column | None = None, shard_bins: int = 4096) -> DataFrame:
    """bins with ``lauf`` for active bins and the known inactive ones they bridge: the end of the run's first bin.

    At most ``bridge`` inactive bins may lie between active ones, all present, regular and known;
    a missing bin always splits.  Bins outside of runs have a null ``lauf``.

    Whether a bin continues a run shows within ``bridge`` + 1 bins of it.  So a source is cut into
    shards of time that also see that much of their neighbours; the beginning of a run that came from
    earlier shards is carried over by a prefix scan over the shards.  No window holds a source's whole time.
    """
    known = F.lit(True) if known is None else F.coalesce(known, F.lit(False))
    span, halo = shard_bins * width, (bridge + 1) * width
    home = _whole(F.col(end).cast("long"), span)
    near = F.sequence(_whole(F.col(end) - halo, span), _whole(F.col(end) + halo, span))
    b = bins.withColumns({"_a": F.coalesce(active, F.lit(False)), "_k": known, "_home": home}).withColumn("_s", F.explode(near))
    w = Window.partitionBy(*keys, "_s").orderBy(end)
    upto, before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    # running counts of bins and of unknown ones: equal counts of the latter mean that all between are known
    b = b.withColumns({"_p": F.row_number().over(w), "_u": F.sum((~F.col("_k")).cast("int")).over(upto)})
    b = b.withColumn("_l", F.last(F.when(F.col("_a"), F.struct(end, "_p", "_u")), ignorenulls=True).over(before))
    steps = F.col("_p") - F.col("_l._p")
    unknown = F.col("_u") - F.when(F.col("_k"), 0).otherwise(1) - F.col("_l._u")
    joined = (steps - 1 <= bridge) & (F.col(end) - F.col(f"_l.{end}") == steps * width) & ((steps == 1) | (unknown == 0))
    b = b.withColumn("_new", F.when(F.col("_a"), ~F.coalesce(joined, F.lit(False))))
    # a bridged bin belongs to the run if the next active one continues it
    b = b.withColumn("_in", F.col("_a") | ~F.coalesce(F.first("_new", ignorenulls=True).over(after), F.lit(True)))
    own = b.filter(F.col("_s") == F.col("_home"))
    begun = F.when(F.col("_new"), F.col(end))
    own = own.withColumn("_b", F.last(begun, ignorenulls=True).over(upto))
    last = own.groupBy(*keys, "_s").agg(F.max(begun).alias("_m"))
    scan = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*keys, "_s", F.max("_m").over(scan).alias("_c"))
    same = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in (*keys, "_s")]
    out = own.alias("x").join(carry.alias("y"), same).select("x.*", "y._c")
    return out.withColumn("lauf", F.when(F.col("_in"), F.coalesce("_b", "_c"))).select(*bins.columns, "lauf")


def complete_sum(value: Column, expected: Column | int) -> Column:
    """Sum that is null unless all expected bins have a value (aggregate)."""
    return F.when(F.count(value) == expected, F.sum(value))


def circular_mean(degrees: Column, weight: Column) -> Column:
    """Weighted mean direction (aggregate); null without resultant, or if a direction has no weight."""
    r = F.radians(degrees)
    there = degrees.isNotNull()
    x, y = F.sum(F.when(there, F.cos(r) * weight)), F.sum(F.when(there, F.sin(r) * weight))
    full = F.count(F.when(there & weight.isNotNull(), 1)) == F.count(degrees)
    return F.when(full & (F.hypot(x, y) > 1e-9), F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0)))


def sensitivity(seconds: DataFrame, keys: list[str], rain: str, wind: str) -> DataFrame:
    """Day metrics without rain, without wind, without both, side by side: one pass of conditional aggregates."""
    e, n_ref = L.energy(F.col("leq")), L.DAY_SECONDS
    cases = {"a": F.lit(True), "ohne_regen": ~F.col(rain), "ohne_wind": ~F.col(wind), "b": ~(F.col(rain) | F.col(wind))}
    aggs = [F.count_if(F.col(rain)).alias("regen_s"), F.count_if(F.col(wind)).alias("wind_s")]
    for k, c in cases.items():
        aggs += [F.count_if(c).alias(f"{k}_sekunden"), F.avg(F.when(c, e)).alias(f"_{k}")]
    d = seconds.groupBy(*keys).agg(*aggs)
    for k in cases:
        n, level = F.col(f"{k}_sekunden"), F.round(L.level_of(F.col(f"_{k}")), 9)
        d = d.withColumns({f"{k}_laeq": level, f"{k}_stufe": L.tier_of_count(n), f"{k}_ueber55": F.coalesce(level > 55, F.lit(False)), f"{k}_ueber60": F.coalesce(level > 60, F.lit(False))})
        d = d.withColumn(f"{k}_untergrenze", L.lower_bound(F.col(f"{k}_laeq"), n)).drop(f"_{k}")
    changed = F.lit(False)
    for k in ("stufe", "ueber55", "ueber60"):
        for v in ("ohne_regen", "ohne_wind", "b"):
            changed = changed | (F.col(f"a_{k}") != F.col(f"{v}_{k}"))
    reason = F.concat_ws(" + ", F.when(F.col("regen_s") > 0, "Niederschlag"), F.when(F.col("wind_s") > 0, "Wind"))
    return d.withColumns({"differenz": F.col("b_laeq") - F.col("a_laeq"), "geaendert": changed, "grund": F.when(reason == "", "kein Ausschluss").otherwise(reason)})


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371.0088 * F.asin(F.sqrt(h))
