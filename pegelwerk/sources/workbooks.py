"""Workbooks at the edge: checked labels and diaries. Needs openpyxl, which may be absent."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

try:
    import openpyxl
except ImportError:  # reading workbooks is optional
    openpyxl = None


def newest_version(paths: list[str]) -> str | None:
    """The path with the highest _V<n>.xlsx."""
    numbered = [(int(m[1]), p) for p in paths if (m := re.search(r"_V(\d+)\.xlsx$", p))]
    return max(numbered)[1] if numbered else None


def _rows(path: str):
    if openpyxl is None:
        raise RuntimeError("openpyxl is not installed")
    for sheet in openpyxl.load_workbook(Path(path), read_only=True, data_only=True):
        yield sheet.title, [list(r) for r in sheet.iter_rows(values_only=True)]


def checked_labels(spark: SparkSession, path: str) -> DataFrame:
    """(WAV, Laermquelle_geprueft) from every sheet that has both columns; a later row of a clip wins."""
    found: dict[str, str] = {}
    for _, rows in _rows(path):
        if rows and {"WAV", "Laermquelle_geprueft"} <= set(rows[0]):
            a, b = rows[0].index("WAV"), rows[0].index("Laermquelle_geprueft")
            found |= {r[a]: str(r[b]).strip() for r in rows[1:] if r[a] and r[b]}
    return spark.createDataFrame(list(found.items()), "WAV string, Laermquelle_geprueft string")


def diary(spark: SparkSession, path: str) -> DataFrame:
    """(tag, eintrag) of rows whose first cell is dd.MM.yyyy."""
    out = [(r[0], " ".join(str(c) for c in r[1:] if c)) for _, rows in _rows(path) for r in rows if r and isinstance(r[0], str) and re.fullmatch(r"\d{2}\.\d{2}\.\d{4}", r[0])]
    return spark.createDataFrame(out, "tag string, eintrag string")
