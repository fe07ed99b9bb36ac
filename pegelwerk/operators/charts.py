"""Implausible readings: robust exponentially weighted control charts per source.

The readings of each source are cut into time shards that overlap by a halo, so a
source with a third of all rows is many shards, each judged by itself:

* physical limits: a level outside of (0, 160], or fields that contradict each other;
* control chart: mean and scale follow the readings with exponential weights; a reading
  outside of the control limits is suspected and clipped before it updates them.  The
  limits are multiples of the source's own scale, with a floor of a few steps of its
  resolution, and wider where the level moves steadily (the median of five steps).  The
  chart runs forwards and backwards, and a reading is flagged only if both suspect it:
  a jump up and back is an error, while noise that swells and fades, or a level that
  changes for good, is near its neighbours on at least one side.  Suspected
  readings are a new level only if it stays for more than ``stay_s``;
* run lengths: a counter of equal readings; a stretch is stuck if it is longer than
  equal readings of that source could run by chance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pegelwerk.operators.instants import _whole


def chart(x, t, starts, least, wide: float, weight: float, width: float, hold: int, stay_s: int, scale: float):
    """Flags of a forward chart over a list of readings; ``starts`` are positions after a gap, ``least`` is each reading's least limit.

    Suspected readings are followed by a second chart.  It takes over, with its flags, once they are more than ``hold`` seconds
    over more than ``stay_s``; if the level comes back before, they stay flagged.

    After a gap the level is the median of the next readings that are within ``wide`` of the level before; of what comes
    next by itself only if that is enough and most of it is elsewhere.
    """
    flags, inner = bytearray(len(x)), bytearray(len(x))
    slow, floor, wider = 0.02, 0.05, False
    begin, held, last, new, far = -1, 0, None, 0.0, 0
    nexts = iter([*sorted(starts), len(x) + 1])
    start = next(nexts)
    middle = lambda ahead: sorted(ahead)[len(ahead) // 2]
    mean = middle(x)
    for i, v in enumerate(x):
        wider = i == start
        if wider:
            start = next(nexts)
            ahead = x[i : min(i + 25, start)]
            near = [y for y in ahead if -wide <= y - mean <= wide]
            if 4 * len(near) < len(ahead) and len({*t[i : min(i + 25, start)]}) >= 9:
                mean, begin = middle(ahead), -1
            elif near:
                mean, begin = middle(near[:9]), -1
        e = v - mean
        a = e if e >= 0 else -e
        bound = width * scale
        if bound < least[i]:
            bound = least[i]
        # after a long stretch one reading near the old level is no return
        if a <= bound and (begin < 0 or held <= hold or abs(middle(x[i : i + 9]) - mean) <= bound):
            mean += weight * e
            scale += slow * ((a if a < 3 * scale else 3 * scale) - scale)
            if scale < floor:
                scale = floor
            begin = -1
            continue
        flags[i] = 1
        if begin < 0:
            begin, held, last, new, far = i, 0, None, middle(x[i : i + 9]), 0
        if t[i] != last:  # copies of a second are one
            held, last = held + 1, t[i]
            far += 1
            if held <= hold:
                mean += weight * (scale if e > 0 else -scale)
        reach = wide if wider and wide > bound else bound
        if -reach <= v - new <= reach:
            inner[i], far = 0, 0
            new += weight * (v - new)
        else:
            inner[i] = 1
            if far > hold:
                new, far = v, 0
        if held > hold and abs(t[i] - t[begin]) > stay_s:
            flags[begin : i + 1] = inner[begin : i + 1]
            mean, begin = new, -1
    return flags


def _judge(fields: list[str], ordered: tuple[str, ...], p: dict):
    import math

    import numpy as np
    import pyarrow as pa

    def least_limits(t, x, scale):
        """Each reading's least limit: steps of the resolution, and how fast the level moves steadily around it."""
        values = np.unique(x.round(6))
        floor = max(p["limit"], p["steps"] * float(np.median(np.diff(values))) if len(values) > 1 else 0.0)
        first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])  # one reading a second
        if len(first) < 6:
            return np.full(len(x), floor)
        # lmin and lmax have long tails: how far single readings stand out on both sides
        step = np.diff(x[first])
        alone = np.where(step[1:] * step[:-1] < 0, np.minimum(np.abs(step[1:]), np.abs(step[:-1])), 0.0)
        floor = max(floor, min(p["tail"] * float(np.subtract(*np.quantile(alone, (0.99, 0.9)))), 2 * p["width"] * scale))
        # two edges of an error don't move the median of five steps; a swelling noise does
        fives = lambda d: np.abs(np.median(np.lib.stride_tricks.sliding_window_view(d, 5), axis=1))
        slope = fives(step)
        # nor do errors in every other second move that of steps over two seconds
        slope = np.minimum(slope, np.pad(fives((step[1:] + step[:-1]) / 2), (0, 1), "edge") if len(step) > 5 else slope)
        near = np.lib.stride_tricks.sliding_window_view(np.pad(slope, (6, 6)), 8).max(axis=1)[: len(first)]
        return np.maximum(floor, p["moving"] / p["weight"] * near)[np.cumsum(np.r_[True, t[1:] != t[:-1]]) - 1]

    def spikes(t, x):
        """Both charts, only where a jump could take a reading out of the limits."""
        jump = np.abs(np.diff(x))
        out = np.zeros(len(x), bool)
        # in one segment the distance from an exponentially weighted mean stays below the largest jump / weight;
        # after a gap one chart may be farther off, but not both, and a flag needs both
        if not len(jump) or jump.max() <= p["limit"] * p["weight"] * 0.999:
            return out
        scale = max(float(np.median(jump)), 0.1)
        gaps = np.flatnonzero(np.diff(t) > p["gap_s"]) + 1
        least = least_limits(t, x, scale)
        # over a gap the level wanders: as steps over gaps show, or the spread of the readings
        wide = 3 * 1.4826 * float(np.median(np.abs(x - np.median(x)))) if len(gaps) < 20 else p["width"] * float(np.median(jump[gaps - 1]))
        wide += max(p["width"] * scale, float(least.min()))
        args = (p["weight"], p["width"], p["hold"], p["stay_s"], scale)
        ahead = np.frombuffer(chart(x.tolist(), t.tolist(), [0, *gaps.tolist()], least.tolist(), wide, *args), np.uint8)
        if not ahead.any():
            return out
        back = np.frombuffer(chart(x[::-1].tolist(), t[::-1].tolist(), [0, *(len(x) - gaps).tolist()], least[::-1].tolist(), wide, *args), np.uint8)[::-1]
        return (ahead & back).astype(bool)

    def stuck(t, x):
        """Rows of stretches of one value that are longer than chance allows here; by second."""
        out = np.zeros(len(x), bool)
        first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])  # copies of a second don't lengthen a run
        ts, xs = t[first], x[first]
        change = np.flatnonzero(np.r_[True, xs[1:] != xs[:-1]])
        length = np.diff(np.r_[change, len(xs)])
        if length.max(initial=0) < p["run_least"]:
            return out
        short = length < p["run_least"]
        equal = (length[short] - 1).sum() + 1.0
        repeat = min(equal / max(length[short].sum(), 2.0), 0.9)
        limit = max(p["run_least"], math.ceil(math.log(p["run_chance"]) / math.log(repeat)))
        for k in np.flatnonzero(length >= limit):
            a, b = change[k], change[k] + length[k] - 1
            out |= (t >= ts[a]) & (t <= ts[b]) & (x == xs[a])
        return out

    def run(key, tbl):
        t, rid = tbl.column("t").to_numpy(), tbl.column("row_id").to_numpy()
        order = np.lexsort((rid, t))
        t, rid = t[order], rid[order]
        own = tbl.column("own").to_numpy(zero_copy_only=False)[order]
        spike, still, wrong, broken = (np.zeros(len(t), bool) for _ in range(4))
        charted = tbl.column("charted")[0].as_py()
        values = {f: tbl.column(f).to_numpy(zero_copy_only=False).astype(float)[order] for f in fields}
        for x in values.values():
            wrong |= ~np.isnan(x) & ~((x > p["low"]) & (x <= p["high"]))
            ok = np.flatnonzero(np.isfinite(x) & (x > p["low"]) & (x <= p["high"]))
            if len(ok) and charted:
                spike[ok] |= spikes(t[ok], x[ok])
                still[ok] |= stuck(t[ok], x[ok])
        for k, a in enumerate(ordered):
            for b in ordered[k + 1 :]:
                broken |= values[a] > values[b]  # never true of missing values
        take = own & (spike | still | wrong | broken)
        return pa.table({"row_id": rid[take], "impossible": wrong[take], "contradicting": broken[take], "spike": spike[take], "stuck": still[take]})

    return run


def implausible(
    rows: DataFrame,
    source: str,
    t_s: str,
    row_id: str,
    fields: list[str],
    ordered: tuple[str, ...] = (),
    shard_s: int = 14_400,
    halo_s: int = 300,
    **settings: float,
) -> DataFrame:
    """rows -> (row_id, impossible, contradicting, spike, stuck) of rows with at least one of the four.

    A value outside of the limits is impossible; values of ``ordered`` fields that fall in that order
    contradict each other.  Null and NaN are no case.  The rows are read once.

    Times are in whole seconds.  ``weight``: of a new reading in the mean; ``width``: control
    limits as a multiple of the scale, at least ``limit`` dB, ``steps`` steps of the
    resolution, ``tail`` times the last tenth's reach of how far readings stand out, and ``moving`` times what a steady movement takes the chart off;
    ``hold`` and ``stay_s``: more suspected
    seconds than ``hold`` over more than ``stay_s``, without return, are a new level; ``gap_s``: after a longer
    pause the chart looks for its level; ``run_least``, ``run_chance``: a stretch is stuck from so many
    equal readings on, and if chance gives it at most this probability.
    Rows with a null source or time are held against the limits only, rows without id not at all; ids must be unique.
    """
    p = {"weight": 0.5, "limit": 0.5, "width": 6.5, "steps": 4.0, "tail": 5.5, "moving": 2.5, "hold": 12, "stay_s": 120, "gap_s": 5, "low": 0.0, "high": 160.0, "run_least": 12, "run_chance": 1e-8} | settings
    shard = lambda t: _whole(t, shard_s)
    t = F.col(t_s).cast("long")
    charted = F.col(source).isNotNull() & t.isNotNull()
    rid = F.col(row_id).cast("long")
    # rows that can't be charted go anywhere
    slim = rows.dropna(subset=[row_id]).select(
        F.col(source).alias("source"), F.coalesce(t, rid).alias("t"), rid.alias("row_id"), charted.alias("charted"), *[F.col(f).cast("double").alias(f) for f in fields]
    )
    home = shard(F.col("t"))
    # a row near a border is also read, but not judged, by the neighbour
    reach = F.when(F.col("charted"), F.array_distinct(F.array(home, shard(F.col("t") - halo_s), shard(F.col("t") + halo_s)))).otherwise(F.array(home))
    spread = slim.withColumn("shard", F.explode(reach)).withColumn("own", F.col("shard") == home)
    kinds = "row_id long, impossible boolean, contradicting boolean, spike boolean, stuck boolean"
    return spread.groupBy("source", "charted", "shard").applyInArrow(_judge(fields, ordered, p), kinds)
