"""Clusters of vectors on the sphere: projection, k-means, votes, representatives, gates."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pegelwerk.functions import vectors as X


def random_projection(rows: DataFrame, vector: str, size: int, dims: int = 64, seed: int = 42) -> DataFrame:
    """``projektion``: log-scaled, standardised, projected and normalised; null vectors stay null.

    Means and deviations are one aggregate over all rows (2 x ``size`` numbers reach the driver); the matrix of dims x size comes
    from the seed, in each task, and is applied to whole Arrow batches.
    """
    scaled = F.transform(X.doubles(F.col(vector)), lambda x: F.signum(x) * F.log1p(F.abs(x)))
    s = rows.withColumn("_s", scaled)
    each = s.select(F.posexplode("_s").alias("k", "x")).groupBy("k").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("d")).filter(F.col("k") < size)
    stats = {r.k: (r.m or 0.0, r.d or 0.0) for r in each.collect()}
    mean, dev = ([stats.get(k, (0.0, 0.0))[i] for k in range(size)] for i in (0, 1))

    @F.pandas_udf("array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np

        matrix = np.random.default_rng(seed).standard_normal((dims, size)) / np.sqrt(dims)
        m, d = np.array(mean), np.array(dev)
        scale = np.divide(1.0, d, out=np.zeros(size), where=d > 1e-12)
        for vs in batches:
            at = np.flatnonzero(vs.notna().to_numpy())
            out = pd.Series([None] * len(vs), dtype=object)
            if len(at):
                p = ((np.vstack([vs.iloc[i] for i in at]) - m) * scale) @ matrix.T
                n = np.linalg.norm(p, axis=1, keepdims=True)
                for i, row in zip(at, np.divide(p, n, out=np.zeros_like(p), where=n > 0)):
                    out.iat[i] = row
            yield out

    return s.withColumn("projektion", project("_s")).drop("_s")


def cosine_kmeans(rows: DataFrame, vector: str, k: int, seed: int = 42, sample: int = 12_000, iterations: int = 25) -> DataFrame:
    """``cluster`` and ``aehnlichkeit`` of every row; centres are fitted on at most ``sample`` rows (documented bound).

    The fit is MLlib's k-means with cosine distance on rows chosen by a hash; the assignment of all
    rows and the similarity to the centre are array expressions.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    v = X.doubles(F.col(vector))
    some = rows.filter(F.col(vector).isNotNull()).orderBy(F.xxhash64(F.col(vector).cast("string"), F.lit(seed))).limit(sample)
    model = KMeans(k=k, seed=seed, distanceMeasure="cosine", maxIter=iterations, featuresCol="_f").fit(some.select(array_to_vector(v).alias("_f")))
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    u = X.unit(v)
    best = F.array_max(F.transform(centres, lambda c, i: F.struct(X.dot(u, X.unit(c)).alias("s"), (-i).alias("i"))))
    out = rows.withColumn("_b", best)
    return out.withColumns({"cluster": (-F.col("_b.i")).cast("int"), "aehnlichkeit": F.col("_b.s")}).drop("_b")


def representatives(rows: DataFrame, cluster: str, similarity: str, row_id: str, shares=(0.0, 0.10, 0.25, 0.40, 0.65, 0.85), steps: int = 1000) -> DataFrame:
    """Rows at given places of each cluster's similarity ranking, the nearest first; each row once.

    Rows are ranked within slices of similarity (``steps`` to the unit); how many lie in the slices before is a running
    sum over a cluster's few slices.  So a cluster with a third of all rows is ranked in many tasks.
    """
    cut = rows.withColumn("_u", F.floor(-F.col(similarity) * steps))
    sizes = cut.groupBy(cluster, "_u").agg(F.count(F.lit(1)).alias("_m"))
    over = Window.partitionBy(cluster)
    before = F.coalesce(F.sum("_m").over(over.orderBy("_u").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(cluster, "_u", before.alias("_before"), F.sum("_m").over(over).alias("_n"))
    inside = Window.partitionBy(cluster, "_u").orderBy(F.desc(similarity), row_id)
    same = [F.col(f"r.{cluster}").eqNullSafe(F.col(f"s.{cluster}")), F.col("r._u").eqNullSafe(F.col("s._u"))]
    r = cut.withColumn("_k", F.row_number().over(inside)).alias("r").join(sizes.alias("s"), same).select("r.*", "s._before", "s._n")
    r = r.withColumn("platz", (F.col("_before") + F.col("_k") - 1).cast("int"))
    places = F.array(*[F.bround(F.lit(p) * (F.col("_n") - 1)).cast("int") for p in shares])
    return r.filter(F.array_contains(places, F.col("platz"))).drop("_n", "_u", "_k", "_before")


def consensus(rows: DataFrame, cluster: str, label: str) -> DataFrame:
    """Majority label and its share per cluster; of equal counts the smaller label."""
    n = rows.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(label).alias("l")))
    return n.groupBy(cluster).agg(F.sum("_n").alias("mitglieder"), best.alias("b")).select(cluster, "mitglieder", F.col("b.l").alias("label"), (-F.col("b.n") / F.col("mitglieder")).alias("anteil"))


def gate(share: Column, score: Column, margin: Column, unanimous: Column, strict: Column) -> Column:
    """'automatisch' or 'pruefen'; strict labels need 0.80 of the votes, score 0.41, margin 0.15 and unanimity."""
    normal = (share >= 0.6) & (score >= 0.30) & (margin >= 0.05)
    hard = (share >= 0.80) & (score >= 0.41) & (margin >= 0.15) & unanimous
    return F.when(F.when(strict, hard).otherwise(normal), "automatisch").otherwise("pruefen")
