"""Labels of events: precedence, weighted votes, episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def precedence(*columns: str) -> Column:
    """The first value that is neither null nor blank, trimmed."""
    return F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in columns])


def renamed(label: Column, names: dict[str, str]) -> Column:
    """Labels by their present names; unknown ones stay."""
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), label) if pairs else label


def weighted_vote(rows: DataFrame, keys: list[str], label: str, weight: str, missing: float) -> DataFrame:
    """Per keys: the label with the largest sum of weights, its share, and the list of all shares.

    Rows without label don't vote; a missing weight counts ``missing``; of equal sums the label
    first in the alphabet wins.  Sums and shares are rounded to six digits first, so that neither ties nor half percents hang on the order of summation.  Two partial aggregations: a key with a third of all rows is one row per label.
    """
    sums = rows.filter(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.round(F.sum(F.coalesce(F.col(weight), F.lit(missing))), 6).alias("_s"))
    total = F.round(F.sum("_s"), 6)
    best = F.min(F.struct((-F.col("_s")).alias("s"), F.col(label).alias("l")))
    detail = F.array_sort(F.collect_list(F.struct((-F.col("_s")).alias("s"), F.col(label).alias("l"))))
    out = sums.groupBy(*keys).agg(total.alias("_t"), best.alias("b"), detail.alias("d"))
    share = lambda x: F.concat(x["l"], F.lit(" "), F.floor(F.round(-100 * x["s"] / F.col("_t"), 6) + 0.5).cast("string"), F.lit("%"))
    return out.select(*keys, F.col("b.l").alias("label"), (-F.col("b.s") / F.col("_t")).alias("anteil"), F.array_join(F.transform("d", share), ", ").alias("anteile"))


def fallback(rows: DataFrame, current: DataFrame, previous: DataFrame, keys: list[str], label: str) -> DataFrame:
    """rows with ``label`` from the current table, else from the previous one; ``uebernommen`` marks the latter."""
    new, old = current.select(*keys, F.col(label).alias("_n")), previous.select(*keys, F.col(label).alias("_o"))
    j = rows.join(new, keys, "left").join(old, keys, "left")
    return j.withColumns({label: F.coalesce("_n", "_o"), "uebernommen": F.col("_n").isNull() & F.col("_o").isNotNull()}).drop("_n", "_o")


def episodes(events: DataFrame, keys: list[str], at: str, gap: int) -> DataFrame:
    """events with ``episode``: numbered per keys, a pause over ``gap`` starts a new one.

    Keys must bound the group (station and day); for whole stations use operators.sessions.
    """
    w = Window.partitionBy(*keys).orderBy(at, "WAV")
    new = F.coalesce(F.col(at) - F.lag(at).over(w) > gap, F.lit(True)).cast("int")
    return events.withColumn("_n", new).withColumn("episode", F.sum("_n").over(w)).drop("_n")


def top_per_group(rows: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group, numbered; each task keeps no more than k of a group before the shuffle."""
    return rows.withColumn("rang", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rang") <= k)
