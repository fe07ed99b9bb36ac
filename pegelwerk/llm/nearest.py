"""Nearest record in time of the same entity, within a tolerance.

Both sides are cut into shards of ``shard_ms`` per entity, so an entity with a third
of all rows is many shards; a left row within the tolerance of a shard's border goes
to both shards.  Each task holds its shards sorted by entity and time and runs one
merge over the stream: it keeps only the rows of the last two tolerances of the
current entity, whatever the length of the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pegelwerk.operators.instants import _whole


def _merge(tolerance: int, names: list[str]):
    """A mapInArrow function over rows (entity, t, side, id) sorted by entity, t, id."""
    import numpy as np
    import pyarrow as pa

    big = np.iinfo(np.int64).max

    def match(ent, t, side, rid, left, final):
        """The finished left rows' nearest right row of each side, by index; -1 without one."""
        # time made monotone over the whole stream: entities are far apart
        new = np.flatnonzero(ent[1:] != ent[:-1]) + 1
        block = np.zeros(len(t), np.int64)
        block[new] = 1
        block = np.cumsum(block)
        for k in range(len(names)):
            r = np.flatnonzero(side == k)
            if len(r):  # of rows at one instant the first has the smallest id
                same = (block[r][1:] == block[r][:-1]) & (t[r][1:] == t[r][:-1])
                r = r[np.r_[True, ~same]]
            if not len(r):
                continue
            at = np.searchsorted(r, left)
            dist, best = np.full(len(left), big), np.full(len(left), -1)
            for step in (-1, 0):
                j = at + step
                ok = (j >= 0) & (j < len(r))
                c = r[np.clip(j, 0, len(r) - 1)]
                ok &= block[c] == block[left]
                d = np.where(ok, np.abs(t[c] - t[left]), big)
                better = (d < dist) | ((d == dist) & (d < big) & (rid[c] < rid[best]))
                dist, best = np.where(better, d, dist), np.where(better, c, best)
            ok = final & (dist <= tolerance)
            yield k, left[ok], best[ok], dist[ok]

    def run(batches):
        tail = None
        for batch in batches:
            tail, found = step(tail, batch, False)
            yield from found
        if tail is not None and len(tail[0]):
            yield from step(tail, None, True)[1]

    def step(tail, batch, last):
        if batch is None:
            ent, t, side, rid, key = tail
        else:
            ent = batch.column("entity").to_numpy(zero_copy_only=False)
            t = batch.column("t").to_numpy()
            side = batch.column("side").to_numpy()
            rid = batch.column("id").to_numpy()
            key = batch.column("key").to_numpy(zero_copy_only=False)
            if tail is not None:
                ent, t, side, rid, key = (np.concatenate(x) for x in zip(tail, (ent, t, side, rid, key)))
        if not len(t):
            return tail, []
        left = np.flatnonzero(side < 0)
        open_ = (ent[left] == ent[-1]) & (t[left] >= t[-1] - tolerance) if not last else np.zeros(len(left), bool)
        out = []
        for k, l, r, d in match(ent, t, side, rid, left, ~open_):
            if len(l):
                out.append(pa.RecordBatch.from_arrays(
                    [pa.array(key[l], pa.string()), pa.array([names[k]] * len(l), pa.string()), pa.array(rid[r]), pa.array(d)],
                    names=["key", "side", "partner_id", "distance"],
                ))
        keep = (ent == ent[-1]) & (t >= t[-1] - 2 * tolerance) & ((side >= 0) | (t >= t[-1] - tolerance))
        return (ent[keep], t[keep], side[keep], rid[keep], key[keep]), out

    return run


def nearest(
    left: DataFrame,
    rights: dict[str, DataFrame],
    tolerance_ms: int,
    partitions: int | None = None,
    shard_ms: int = 600_000,
) -> DataFrame:
    """left (entity, t, key string) and rights (entity, t, id bigint) -> (key, side, partner_id, distance).

    For each left row and each right table the row of the same entity with the least
    distance in time, at most ``tolerance_ms`` (inclusive); of equally near rows the
    smaller id.  Left rows without partner give no row.  Null entities, times and ids
    match nothing.  Without ``partitions`` Spark chooses their number, and adapts it.  Left keys that occur several times give the nearest of all their rows.
    """
    sides = list(rights)
    shard_of = lambda t: _whole(t, shard_ms)
    shards = F.array_distinct(F.transform(F.array(*[F.lit(d) for d in (-tolerance_ms, 0, tolerance_ms)]), lambda d: shard_of(F.col("t") + d)))
    rows = (
        left.select("entity", F.col("t").cast("long").alias("t"), F.lit(-1).alias("side"), F.lit(-1).cast("long").alias("id"), "key")
        .dropna(subset=["entity", "t", "key"])
        .withColumn("shard", F.explode(shards))
    )
    for k, name in enumerate(sides):
        right = rights[name].select("entity", F.col("t").cast("long").alias("t"), F.lit(k).alias("side"), F.col("id").cast("long").alias("id"), F.lit(None).cast("string").alias("key"))
        rows = rows.unionByName(right.dropna(subset=["entity", "t", "id"]).withColumn("shard", shard_of(F.col("t"))))
    merged = (
        rows.repartition(*([partitions] if partitions else []), "entity", "shard")
        .sortWithinPartitions("entity", "t", "id")
        .drop("shard")
        .mapInArrow(_merge(tolerance_ms, sides), "key string, side string, partner_id long, distance long")
    )
    best = F.min(F.struct("distance", "partner_id"))
    return merged.groupBy("key", "side").agg(best.alias("b")).select("key", "side", "b.partner_id", "b.distance")
