"""Files as tables: inventories, archives in archives, databases, clips.

Contents are read by Spark's binaryFile source; each file is opened in the task that reads it.
"""

from __future__ import annotations

import hashlib
import io
import sqlite3
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pegelwerk.functions import text as T

MEMBER = "pfad string, herkunft string, groesse long, sha256 string, typ string, status string, text string"


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(pfad, groesse, geaendert, sha256, typ) of every file below a folder."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return b.select(F.col("path").alias("pfad"), F.col("length").alias("groesse"), F.col("modificationTime").alias("geaendert"), F.sha2("content", 256).alias("sha256"), T.magic(F.col("content")).alias("typ"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(pfad, groesse, geaendert) without reading any content."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return b.select(F.col("path").alias("pfad"), F.col("length").alias("groesse"), F.col("modificationTime").alias("geaendert"))


def unpack(name: str, data: bytes, depth: int, budget: list[int], texts: str | None):
    """Members of an archive, and of archives in it down to ``depth``: tuples of MEMBER.

    Members that would leave the target folder, or exceed the budget of unpacked bytes, are listed with
    a status and not opened.  ``budget`` holds one number, taken down by every member at any depth.
    """
    try:
        archive = zipfile.ZipFile(io.BytesIO(data))
    except zipfile.BadZipFile:
        yield name, "", len(data), None, "ZIP", "defekt", None
        return
    for member in archive.infolist():
        if member.is_dir():
            continue
        full = f"{name}!{member.filename}"
        parts = member.filename.replace("\\", "/").split("/")
        if ".." in parts or member.filename.startswith("/") or ":" in parts[0]:
            yield full, name, member.file_size, None, None, "unsicherer_pfad", None
            continue
        if member.file_size > budget[0]:
            yield full, name, member.file_size, None, None, "zu_gross", None
            continue
        budget[0] -= member.file_size
        content = archive.read(member)
        zipped = content[:4] == b"PK\x03\x04"
        text = content.decode("utf-8", "replace") if texts and member.filename.endswith(texts) else None
        yield full, name, len(content), hashlib.sha256(content).hexdigest(), "ZIP" if zipped else None, "ok" if not zipped or depth > 1 else "zu_tief", text
        if zipped and depth > 1:
            yield from unpack(full, content, depth - 1, budget, texts)


def members(spark: SparkSession, path: str, depth: int = 5, budget: int = 40 << 30, texts: str | None = None) -> DataFrame:
    """Members of all ZIP archives below a folder; ``texts``: ending of members whose text is wanted."""

    def run(batches):
        for pdf in batches:
            for name, content in zip(pdf["path"], pdf["content"]):
                rows = list(unpack(name, content, depth, [budget], texts))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in MEMBER.split(", ")])

    b = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.zip").load(path)
    return b.select("path", "content").mapInPandas(run, MEMBER)


def marked_duplicates(inventory: DataFrame, order: str) -> DataFrame:
    """``duplikat_von``: the first path with the same content, null for that path itself."""
    w = Window.partitionBy("sha256").orderBy(order)
    first = F.first_value("pfad").over(w)
    return inventory.withColumn("duplikat_von", F.when(F.col("sha256").isNotNull() & (first != F.col("pfad")), first))


def sqlite_table(spark: SparkSession, path: str, query: str, schema: str, immutable: bool = False) -> DataFrame:
    """Rows of a query over each database file below a path, read-only; ``datei`` is the file.

    Files must be readable from every worker.  A database without the queried table or columns gives no rows;
    one that is locked or broken is an error.  ``immutable``: opened as it is on disk, without its journal or
    write-ahead log; else what the log holds is seen, too.
    """
    names = [c.strip().split()[0] for c in schema.split(",")]

    def run(batches):
        for pdf in batches:
            for uri in pdf["pfad"]:
                place = uri.removeprefix("file:")
                con = sqlite3.connect(f"file:{place}?mode=ro" + "&immutable=1" * immutable, uri=True)
                try:
                    cursor = con.execute(query)
                    while rows := cursor.fetchmany(50_000):
                        out = pd.DataFrame(rows, columns=names)
                        out.insert(0, "datei", place)
                        yield out
                except sqlite3.OperationalError as e:
                    if not str(e).startswith(("no such table", "no such column")):  # locked or broken is no empty database
                        raise
                finally:
                    con.close()

    return listing(spark, path).select("pfad").mapInPandas(run, f"datei string, {schema}")


def sqlite_schema(spark: SparkSession, path: str) -> DataFrame:
    """(datei, tabelle, spalte, typ) of every table in the database files below a path."""
    q = "SELECT m.name, p.name, p.type FROM sqlite_master m JOIN pragma_table_info(m.name) p WHERE m.type = 'table'"
    return sqlite_table(spark, path, q, "tabelle string, spalte string, typ string")


def has_columns(df: DataFrame, *needed: str) -> bool:
    return set(needed) <= set(df.columns)


def manifest_files(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Manifest rows with ``befund``: ok, fehlt or anderer_inhalt, by path and SHA-256."""
    f = found.select(F.col("pfad"), F.lower("sha256").alias("_sha")).dropDuplicates(["pfad"])
    state = F.when(F.col("_sha").isNull(), "fehlt").when(F.col("_sha") == F.lower("sha256"), "ok").otherwise("anderer_inhalt")
    return manifest.join(f, "pfad", "left").withColumn("befund", state).drop("_sha")


def first_found(wanted: DataFrame, places: list[DataFrame], key: str, content: str) -> DataFrame:
    """wanted keys with their content from the first place that has it exactly once: (key, content, fundort, befund).

    ``befund``: ok, mehrdeutig (found, but nowhere once) or fehlt.  Places are tables such as archive members and folders, in order.
    """
    out = wanted.select(key).distinct()
    picks, seen = [], []
    for i, p in enumerate(places):
        one = p.groupBy(key).agg(F.count(F.lit(1)).alias(f"_n{i}"), F.min(content).alias(f"_c{i}"))
        out = out.join(one, key, "left")
        picks.append(F.when(F.col(f"_n{i}") == 1, F.struct(F.col(f"_c{i}").alias("c"), F.lit(i).alias("i"))))
        seen.append(F.coalesce(F.col(f"_n{i}") > 1, F.lit(False)))
    pick = F.coalesce(*picks)
    several = seen[0]
    for s in seen[1:]:
        several = several | s
    state = F.when(pick.isNotNull(), "ok").when(several, "mehrdeutig").otherwise("fehlt")
    return out.select(key, pick["c"].alias(content), pick["i"].alias("fundort"), state.alias("befund"))


def patient(read, tries: int = 4, wait_s: float = 0.5):
    """``read()``, again after a growing pause if the file system fails; the last failure is raised."""
    import time

    for k in range(tries):
        try:
            return read()
        except OSError:
            if k == tries - 1:
                raise
            time.sleep(wait_s * 2**k)
