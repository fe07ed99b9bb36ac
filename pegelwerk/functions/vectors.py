"""Vectors as arrays: products, norms, ranks, weighted tops. All on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Null if a vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(a: Column) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: F.try_divide(x, n))


def mean_vector(v: Column, size: int) -> Column:
    """Element-wise mean (aggregate) with partial sums: ``size`` doubles per group and task."""
    return F.array(*[F.avg(F.get(v, k)) for k in range(size)])


def top(v: Column, k: int) -> Column:
    """The k largest (value, index), largest first, of equal values the smaller index."""
    pairs = F.transform(v, lambda x, i: F.struct((-x).alias("n"), i.alias("i")))
    return F.transform(F.slice(F.array_sort(pairs), 1, k), lambda p: F.struct((-p["n"]).alias("wert"), p["i"].alias("index")))


def weighted_top3(v: Column) -> Column:
    """First + 0.25 second + 0.10 third largest."""
    s = F.sort_array(v, asc=False)
    at = lambda k: F.coalesce(F.get(s, k), F.lit(0.0))
    return F.get(s, 0) + 0.25 * at(1) + 0.10 * at(2)


def category_sums(v: Column, groups: dict[str, list[int]]) -> Column:
    """struct of sums of a vector's elements by category."""
    return F.struct(*[sum((F.get(v, i) for i in idx[1:]), F.get(v, idx[0])).alias(k) for k, idx in groups.items()])


def softmax(v: Column, scale: float) -> Column:
    m = F.array_max(v)
    e = F.transform(v, lambda x: F.exp((x - m) * scale))
    total = F.aggregate(e, F.lit(0.0), lambda s, x: s + x)
    return F.transform(e, lambda x: x / total)


def category_label(scores: dict[str, Column], least: float, otherwise: str) -> Column:
    """The category with the highest score, of equal ones the first given; ``otherwise`` if none reaches ``least``."""
    best = F.array_min(F.array(*[F.struct((-v).alias("n"), F.lit(i).alias("i"), F.lit(k).alias("k")) for i, (k, v) in enumerate(scores.items())]))
    return F.when(-best["n"] < least, otherwise).otherwise(best["k"])
