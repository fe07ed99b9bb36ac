"""Writing: CSV and Parquet, staged replacement, append-only logs, manifests, upserts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: list[str], sep: str = ";", mark: bool = False) -> None:
    """Columns in a fixed order, missing values empty; ``mark``: a byte order mark in front of each file's first name."""
    first, *rest = columns
    df.select(F.col(first).alias(("﻿" if mark else "") + first), *rest).write.mode("overwrite").csv(path, sep=sep, header=True, emptyValue="", nullValue="")


def write_days(df: DataFrame, path: str, day: str = "tag") -> None:
    """Parquet by day; only days that are in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str, keep_old: bool = False) -> None:
    """Writes beside the target and then renames, so that readers see the old or the new state; on whatever file system the path is."""
    staged, old = f"{path}.neu-{uuid.uuid4().hex}", f"{path}.alt"
    df.write.parquet(staged)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(conf)

    def move(a: str, b: str) -> None:
        if not files.rename(place(a), place(b)):
            raise OSError(f"{a} could not be renamed")

    if files.exists(place(path)):
        files.delete(place(old), True)
        move(path, old)
    move(staged, path)
    if not keep_old:
        files.delete(place(old), True)


def upsert(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and of ``current`` where ``new`` lacks the key; running it twice changes nothing."""
    return new.unionByName(current.join(new.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def pruned(cache: DataFrame, keep: DataFrame, key: str) -> DataFrame:
    """Cache rows whose key is still wanted, one each."""
    return cache.join(keep.select(key).distinct(), key, "left_semi").dropDuplicates([key])


def output_manifest(df_files: DataFrame) -> DataFrame:
    """(pfad, groesse, sha256) of written files, for a later check of completeness."""
    return df_files.select("pfad", "groesse", "sha256")


def blanked(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same columns and types with no value in the given ones."""
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in columns if c in df.columns})


def report(title: str, counters: DataFrame) -> str:
    """Markdown table of a few counters (an aggregate, not data)."""
    rows = counters.collect()
    lines = [f"# {title}", "", "| " + " | ".join(counters.columns) + " |", "|" + "---|" * len(counters.columns)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows]) + "\n"


def write_variants(tables: dict[str, DataFrame], settings: dict, path: str) -> None:
    """Result tables of a comparison as ';' CSV with a byte order mark, one folder each, and the settings that made them as JSON."""
    import json

    for name, df in tables.items():
        write_csv(df, f"{path}/{name}", df.columns, mark=True)
    spark = next(iter(tables.values())).sparkSession
    text = json.dumps(settings, ensure_ascii=False, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/einstellungen")


def carried(pending: DataFrame, new: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Work for the next run: what was pending or is new, once each, less what is done."""
    return pending.select(key).unionByName(new.select(key)).distinct().join(done.select(key).distinct(), key, "left_anti")


def quarantined(known: DataFrame, present: DataFrame, key: str, day: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose file is gone, days that must be made again because of them)."""
    gone = known.join(present.select(key).distinct(), key, "left_anti")
    return gone, gone.select(day).filter(F.col(day).isNotNull()).distinct()


def cluster_package(assigned: DataFrame, verdicts: DataFrame, cluster: str, item: str, automatic: str = "automatisch") -> dict[str, DataFrame]:
    """Result tables of a clustering: ``zuordnung`` (item, cluster, label, status), ``uebersicht`` per cluster, ``pruefliste`` of what needs a look, ``lauf`` with counters."""
    full = assigned.join(verdicts, cluster, "left").withColumn("status", F.when(F.col("urteil") == automatic, automatic).otherwise("pruefen"))
    overview = full.groupBy(cluster).agg(F.count(F.lit(1)).alias("mitglieder"), F.first("kandidat").alias("kandidat"), F.first("konfidenz").alias("konfidenz"), F.first("status").alias("status"))
    return {
        "zuordnung": full.select(item, cluster, F.when(F.col("status") == automatic, F.col("kandidat")).alias("label"), "kandidat", "status"),
        "uebersicht": overview,
        "pruefliste": overview.filter(F.col("status") != automatic).orderBy(F.desc("mitglieder"), cluster),
        "lauf": full.agg(F.countDistinct(cluster).alias("cluster"), F.count(F.lit(1)).alias("elemente"), F.count_if(F.col("status") == automatic).alias("automatisch")),
    }
