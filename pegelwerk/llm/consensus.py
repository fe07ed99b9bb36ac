"""One surviving value per field of each group of duplicate rows, by token consensus.

Per group and field every different value has a weight.  The value with the most is the
seed; every other one is aligned with it, token by token, and merged into its columns
(progressive alignment along a star: tokens that the seed lacks open columns of their
own).  Each column is voted on with the values' weights, a value without a token there
votes for none; the winning tokens are the consensus, and the existing value closest to
it survives, of equally close ones the more trusted.

Weights: ``"first"`` halves the weight from one value to the next in order of trust, so
that missing fields are filled from the best row that has them: every group with
different values is aligned, voted and measured, and the best row's value wins each
column, since it outweighs all later ones together.  ``"vote"`` weighs a value by its
rows, each by 1 / (1 + rank); there a value that outweighs all others together has the
most votes in every column and is taken without aligning.

Scale: keys that occur twice are counted first and written, so that of all other rows
nothing moves once Spark knows them to be few; a group's values are combined before
they move, so a group with a third of all rows is one row per value and task.  The
different values are written once.  One value and its seed at a time reach Python, in
parallel; votes and distances are combined again.  No group is in one task, and groups
of all sizes go the same way.  An alignment costs the product of what lies between the
common beginning and end of two values.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pegelwerk.plans.lineage import written

#: Columns are numbered seed position * STEP, then what is inserted before that position counts on from the one before.
STEP = 1 << 32


def tokens(text: str) -> list[str]:
    import re

    return re.findall(r"\d+|[^\W\d_]+|[^\d\W]|\W|_", text)


def _middle(a: Sequence[str], b: Sequence[str]) -> tuple[int, int, int]:
    """Common tokens at the beginning, and the ends of what differs."""
    i, n, m = 0, len(a), len(b)
    while i < n and i < m and a[i] == b[i]:
        i += 1
    while n > i and m > i and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    return i, n, m


def place(seed: Sequence[str], value: Sequence[str]) -> list[tuple[int, str]]:
    """(column, token) of a value's tokens, by an alignment with the fewest changes; a token replaced stands in the seed's column."""
    i, n, m = _middle(seed, value)
    a, b = seed[i:n], value[i:m]
    moves = [bytearray([2] * (len(b) + 1))]
    row = list(range(len(b) + 1))
    for p, x in enumerate(a, 1):
        last, row[0], mv = row[0], p, bytearray(len(b) + 1)
        mv[0] = 1
        for q, y in enumerate(b, 1):
            best, k = last + (x != y), 0
            if row[q] + 1 <= best:
                best, k = row[q] + 1, 1
            if row[q - 1] + 1 <= best:
                best, k = row[q - 1] + 1, 2
            last, row[q], mv[q] = row[q], best, k
        moves.append(mv)
    path, p, q = [], len(a), len(b)
    while p or q:
        k = moves[p][q]
        p, q = p - (k != 2), q - (k != 1)
        path.append((k, p, q))
    out = [((k + 1) * STEP, t) for k, t in enumerate(seed[:i])]
    at, more = i, 0
    for k, p, q in reversed(path):
        if k == 2:
            more += 1
            out.append((at * STEP + more, b[q]))
        else:
            at, more = i + p + 1, 0
            if k == 0:
                out.append((at * STEP, b[q]))
    return out + [((n + 1 + k) * STEP, t) for k, t in enumerate(seed[n:])]


def distance(a: Sequence[str], b: Sequence[str]) -> int:
    """Least number of tokens to insert, remove or replace."""
    i, n, m = _middle(a, b)
    a, b = a[i:n], b[i:m]
    row = list(range(len(b) + 1))
    for p, x in enumerate(a, 1):
        last, row[0] = row[0], p
        for q, y in enumerate(b, 1):
            last, row[q] = row[q], min(last + (x != y), row[q] + 1, row[q - 1] + 1)
    return row[-1]


def is_filled(c: Column, kind: str) -> Column:
    """Neither null nor NaN nor blank."""
    if kind in ("double", "float"):
        return c.isNotNull() & ~F.isnan(c)
    return F.coalesce(F.trim(c) != "", F.lit(False)) if kind == "string" else c.isNotNull()


def duplicates(rows: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """rows whose key occurs twice or more, with the group's smallest row id as ``_group``. Null keys are no group, rows without id in none."""
    rows = rows.dropna(subset=[*keys, row_id])
    twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(row_id).alias("_group")).filter("_n > 1").drop("_n")
    return rows.join(written(twice), keys)


def different(rows: DataFrame, keys: list[str], row_id: str, order: list[Column], fields: list[str]) -> DataFrame:
    """rows -> (_group, field, value, _rank, _w): the different values of each field of the groups, their best row's rank and their weight by rows and trust."""
    kinds = dict(rows.dtypes)
    # plain columns move; structs and texts are made of the few rows that stay
    slim = rows.select(*keys, row_id, *[c.cast("long").alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(f).alias(f"_v{i}") for i, f in enumerate(fields)])
    rank = F.struct(*[F.col(f"_o{i}").alias(f"o{i}") for i in range(len(order))], F.col(row_id).cast("long").alias("id"))
    values = [F.when(is_filled(F.col(f"_v{i}"), kinds[f]), F.col(f"_v{i}").cast("string")).alias(f"_v{i}") for i, f in enumerate(fields)]
    dup = duplicates(slim, keys, row_id).select("_group", rank.alias("_rank"), *values)
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_v{i}").alias("value")) for i, f in enumerate(fields)])
    long = dup.select("_group", "_rank", F.explode(each).alias("x")).select("_group", "_rank", "x.field", "x.value").filter(F.col("value").isNotNull())
    trust = F.sum(F.lit(1.0) / (1 + F.greatest(F.lit(0).cast("long"), F.col("_rank.o0"))))
    return long.groupBy("_group", "field", "value").agg(F.min("_rank").alias("_rank"), F.round(trust, 9).alias("_w"))


def representatives(rows: DataFrame, keys: list[str], row_id: str, order: list[Column], fields: list[str], weights: str = "first") -> DataFrame:
    """rows -> (group, field, row_id, value): the row that gives the surviving value of each field.

    ``group`` is the smallest row id.  ``order``: bigint columns, the best row has the smallest; ties go to
    the smaller ``row_id``.  A value stands for all rows that have it; its row is the best of them.  A field that no
    row of the group has filled (null, NaN and blank are not) gives no row; null keys are no group.
    """
    values = written(different(rows, keys, row_id, order, fields))
    return vote(values, ["_group", "field"], weights).select(F.col("_group").alias("group"), "field", F.col("_rank.id").alias("row_id"), "value")


def vote(values: DataFrame, group: list[str], weights: str = "vote") -> DataFrame:
    """values (group, value, _rank, _w), each value once -> one row per group, the survivor: (group, value, _rank)."""

    @F.pandas_udf("array<struct<c:bigint,t:string>>")
    def placed(seeds: pd.Series, vs: pd.Series) -> pd.Series:
        return pd.Series([[{"c": c, "t": t} for c, t in place(tokens(s), tokens(v))] for s, v in zip(seeds, vs)])

    @F.pandas_udf("int")
    def away(vs: pd.Series, consensus: pd.Series) -> pd.Series:
        return pd.Series([distance(tokens(v), list(c)) for v, c in zip(vs, consensus)], dtype="int32")

    first = weights == "first"
    heavy = F.min(F.struct(*[] if first else [(-F.col("_w")).alias("w")], "_rank", "value")).alias("_b")
    groups = values.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.round(F.sum("_w"), 9).alias("_all"), heavy)
    # one value has nothing to be aligned with; under trust also one that outweighs the rest
    done = F.col("_n") == 1 if first else -F.col("_b.w") * 2 > F.col("_all")
    decided = groups.filter(done).select(*group, "_b.value", "_b._rank")
    seeds = groups.filter(~done).select(*group, "_all", F.col("_b.value").alias("_seed"))
    open_ = values.join(seeds, group)
    votes = open_.select(*group, "_rank", "value", "_w", "_all", (F.col("value") == F.col("_seed")).alias("_s"), F.explode(placed("_seed", "value")).alias("x"))
    votes = votes.select(*group, "_rank", "value", "_w", "_all", "_s", F.col("x.c").alias("c"), F.col("x.t").alias("t"))
    # of halving weights the first one outweighs the sum of the others, however many: sums are compared by their best value, without rounding.
    # The seed is the best of all, so a column that it has no token in is outvoted by those that have none
    by_rank = lambda: votes.groupBy(*group, "c").agg(F.min(F.struct("_rank", "value", "t", "_s")).alias("_b")).filter("_b._s")

    def by_sum() -> DataFrame:
        tokens_ = votes.groupBy(*group, "c", "t").agg(F.sum("_w").alias("_w"), F.max("_s").alias("_s"), F.first("_all").alias("_all"))
        best = F.min(F.struct((-F.round("_w", 9)).alias("w"), (~F.col("_s")).alias("s"), "t")).alias("_b")
        columns = tokens_.groupBy(*group, "c").agg(best, F.round(F.first("_all") - F.sum("_w"), 9).alias("_none"))
        # a tie keeps the seed's side: its token in its own columns, none in those that others opened
        return columns.filter(F.when(F.col("c") % STEP == 0, -F.col("_b.w") >= F.col("_none")).otherwise(-F.col("_b.w") > F.col("_none")))

    columns = by_rank() if first else by_sum()
    consensus = columns.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("c", "_b.t"))).alias("_c"))
    near = open_.join(consensus, group, "left").withColumn("_d", away("value", F.coalesce(F.transform("_c", lambda x: x["t"]), F.array().cast("array<string>"))))
    closest = near.groupBy(*group).agg(F.min(F.struct("_d", "_rank", "value")).alias("_b")).select(*group, "_b.value", "_b._rank")
    return decided.unionByName(closest)
