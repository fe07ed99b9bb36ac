"""Choosing one value per key from several sources, with a record of what was set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def priority_union(primary: DataFrame, secondary: DataFrame, keys: list[str]) -> DataFrame:
    """All primary rows, and secondary rows whose key the primary doesn't have."""
    return primary.unionByName(secondary.join(primary.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def overlap_audit(primary: DataFrame, secondary: DataFrame, keys: list[str], level: str, tolerance: float = 0.15) -> DataFrame:
    """One row: common keys, how many agree within the tolerance, conflicts, largest difference."""
    both = primary.select(*keys, F.col(level).alias("_a")).join(secondary.select(*keys, F.col(level).alias("_b")), keys)
    d = F.abs(F.col("_a") - F.col("_b"))
    return both.agg(
        F.count(F.lit(1)).alias("gemeinsam"), F.count_if(d <= tolerance).alias("gleich"), F.count_if(d > tolerance).alias("konflikte"), F.round(F.max(d), 3).alias("groesste")
    )


def replace_mixed(rows: DataFrame, better: DataFrame, keys: list[str], source: str, level: str, pure: str, mixed: str) -> DataFrame:
    """Rows of the pure source are kept, mixed ones get the better table's level where it has the key, all others go.

    Adds ``ersetzt`` and ``delta`` (new minus old level).
    """
    b = better.select(*keys, F.col(level).alias("_b"))
    joined = rows.filter(F.col(source).isin(pure, mixed)).join(b, keys, "left")
    use = (F.col(source) == mixed) & F.col("_b").isNotNull()
    kept = joined.filter((F.col(source) == pure) | use)
    return kept.select(
        *[c for c in rows.columns if c != level],
        F.when(use, F.col("_b")).otherwise(F.col(level)).alias(level),
        use.alias("ersetzt"),
        F.when(use, F.col("_b") - F.col(level)).alias("delta"),
    )


def merge_by_priority(rows: DataFrame, keys: list[str], level: str, order: list[Column], table: str, tolerance: float = 0.15) -> DataFrame:
    """Candidates of each key: best one, how many agree, conflict if any lies farther off than the tolerance.

    Adds rang (1 is best), gleiche (others within the tolerance), konflikt, and querpruefung: another
    table agrees with the best.  A key's candidates are few; a key with a third of all rows would be
    sorted in one task, so give keys that include what makes candidates comparable (station and second).
    """
    w = Window.partitionBy(*keys)
    ordered = w.orderBy(*order)
    best = F.first_value(level).over(ordered)
    near = F.coalesce(F.abs(F.col(level) - F.col("_best")) <= tolerance, F.lit(False))
    df = rows.withColumns({"rang": F.row_number().over(ordered), "_best": best, "_table": F.first_value(table).over(ordered)})
    other = near & (F.col("rang") > 1)
    return (
        df.withColumns(
            {
                "gleiche": F.count_if(other).over(w),
                "konflikt": F.count_if(~near & (F.col("rang") > 1)).over(w) > 0,
                "querpruefung": F.count_if(other & (F.col(table) != F.col("_table"))).over(w) > 0,
            }
        )
        .drop("_best", "_table")
    )


def validation(conflict: str, crossed: str, table: str, status: str) -> Column:
    """How a best row is confirmed: conflict of sources, else the check of its window and agreement of another table, joined by '+'.

    A window's check counts for rows of the table it was made for only.
    """
    mine = {"level_samples": ("BESTAETIGT_4A", "KONFLIKT_4A"), "measurements": ("BESTAETIGT_PCE_CSV", "KONFLIKT_PCE_CSV")}
    window = F.lit(None).cast("string")
    for name, known in mine.items():
        window = F.when((F.col(table) == name) & F.col(status).isin(*known), F.col(status)).otherwise(window)
    both = F.concat_ws("+", window, F.when(F.col(crossed), "QUERPRUEFUNG_2_TABELLEN"))
    return F.when(F.col(conflict), "KONFLIKT_QUELLEN").when(both != "", both).otherwise("UNGEPRUEFT")


def keep_first_class(rows: DataFrame, keys: list[str], column: str, classes: list[str], order: list[Column]) -> DataFrame:
    """Per key the row of the first class in ``classes`` (others last), ties by ``order``."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, classes)), F.col(column)), F.lit(0).cast("long")), F.lit(len(classes) + 1).cast("long"))
    return first_per_key(rows, keys, [place, *order])


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order, which must break ties."""
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_k = 1").drop("_k")


def fill_only(rows: DataFrame, new: DataFrame, key: str, target: str, value: str) -> DataFrame:
    """``target`` from the new table where it is null or blank; what is there stays."""
    have = F.nullif(F.trim(F.col(target)), F.lit(""))
    return rows.join(new.select(key, F.col(value).alias("_new")), key, "left").withColumn(target, F.coalesce(have, F.nullif(F.trim("_new"), F.lit("")))).drop("_new")


def guarded_update(rows: DataFrame, new: DataFrame, key: str, target: str, manual: str, value: str, gate: Column) -> DataFrame:
    """``target`` from the new table where the gate holds and no manual value stands.

    Adds ``konflikt``: a manual value that differs from the new one.  Running it again changes nothing.
    """
    by_hand = F.nullif(F.trim(F.col(manual)), F.lit(""))
    joined = rows.join(new.select(key, F.col(value).alias("_new")), key, "left")
    hit = gate & F.col("_new").isNotNull()
    return joined.withColumns(
        {
            "konflikt": F.coalesce(hit & by_hand.isNotNull() & (by_hand != F.col("_new")), F.lit(False)),
            target: F.when(hit & by_hand.isNull(), F.col("_new")).otherwise(F.col(target)),
        }
    ).drop("_new")


def full_compare(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys with their state: added, removed, changed (any value differs, null-safe) or same."""
    o = old.select(*keys, F.struct(*values).alias("_o"))
    n = new.select(*keys, F.struct(*values).alias("_n"))
    state = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(F.col("_o") != F.col("_n"), "changed").otherwise("same")
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"_o.{v}").eqNullSafe(F.col(f"_n.{v}"))
    state = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(same, "same").otherwise("changed")
    return o.join(n, keys, "full_outer").select(*keys, state.alias("stand"))


def substitute_rows(rows: DataFrame, keys: list[str], essential: list[str], rank: str) -> DataFrame:
    """Per key the row of lowest rank that has all essential values; rank 0 wins only if complete too.

    A row is taken whole, never mixed.  Keys without any complete row keep the one of lowest rank.
    """
    complete = F.lit(True)
    for c in essential:
        complete = complete & F.col(c).isNotNull()
    w = Window.partitionBy(*keys).orderBy(F.when(complete, 0).otherwise(1), rank)
    return rows.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def null_safe_diff(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Long list of differences: keys, feld, alt, neu (as text); null against null is none."""
    o = old.select(*keys, *[F.col(v).alias(f"o_{v}") for v in values])
    n = new.select(*keys, *[F.col(v).alias(f"n_{v}") for v in values])
    each = F.array(*[F.struct(F.lit(v).alias("feld"), F.col(f"o_{v}").cast("string").alias("alt"), F.col(f"n_{v}").cast("string").alias("neu")) for v in values])
    long = o.join(n, keys).select(*keys, F.explode(each).alias("x")).select(*keys, "x.*")
    return long.filter(~F.col("alt").eqNullSafe(F.col("neu")))
