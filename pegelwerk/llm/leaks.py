"""Evaluation texts inside training texts, also with other numbers and names.

Template canonicalisation: a word that is a number, a unit or no common word of the test
items becomes a typed placeholder.  Windows of ``size`` words, so canonicalised, are the
join keys between corpus and items: a re-parameterised question has the same template.
A window with fewer than ``fixed`` common words would be a template of placeholders that
anything fits; its key is the words themselves.  Then the slots are checked: ``leaks``
keeps windows whose slots hold the very same words (a passage shared word for word),
``reparameterised`` passages (runs of windows at one distance) whose slots change one to
one from end to end.

What a window's key is depends on its words and the items alone, so equal passages
always have equal keys: no shared passage is lost before the check.

Scale: the corpus is read once.  Each task keeps a window only if its key occurs in
the items at all, looked up among sorted 64-bit hashes if the items have at most
``bound`` windows (checked; they are a fixed test set), so that only hits go on.
Beyond the bound every window goes through the shuffled hash join.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pegelwerk.plans.lineage import bounded

#: Words for measures that follow numbers, in the corpus' languages.
UNITS = frozenset(
    "db dba hz khz m mm cm km s ms min h uhr grad degrees degres prozent percent pourcent stunden minuten sekunden hours minutes seconds heures secondes jahre jahren years ans meter metres metern kg g t w kw v a".split()
)
NUMBER, NAME, UNIT = "<zahl>", "<name>", "<einheit>"
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_MARKS = regex.compile(r"\p{M}+")


def words(text: str) -> list[str]:
    """Runs of letters and digits, without case and accents; ß is ss."""
    if text.isascii():
        return _WORD.findall(text.lower())
    return _WORD.findall(_MARKS.sub("", unicodedata.normalize("NFD", unicodedata.normalize("NFD", text).casefold())))


class Canon(dict):
    """word -> 64-bit code of its template token: itself if common (or ``common`` is None), else its placeholder.

    Codes of words met before are kept, at most ``most`` of them; equal words always get equal codes.
    """

    def __init__(self, common: frozenset | None, most: int = 500_000):
        super().__init__()
        self.common, self.most = common, most

    def __missing__(self, word: str) -> int:
        import xxhash

        token = word
        if self.common is not None:
            token = NUMBER if word.isdigit() else UNIT if word in UNITS else word if word in self.common else NAME
        code = xxhash.xxh3_64_intdigest(token)
        if len(self) >= self.most:
            self.clear()
        self[word] = code
        return code


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of each window of ``size`` codes; equal windows hash alike in every process."""
    n = len(codes) - size + 1
    if n < 1:
        return np.zeros(0, np.int64)
    acc = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            acc = (acc * np.uint64(0x9E3779B97F4A7C15)) ^ codes[k : k + n]
            acc ^= acc >> np.uint64(29)
            acc *= np.uint64(0xBF58476D1CE4E5B9)
    return acc.view(np.int64)


def keys(templates: np.ndarray, words: np.ndarray, size: int, fixed: int) -> np.ndarray:
    """The key of each window: its template's hash, or its words' with fewer than ``fixed`` words that are their own template."""
    h = window_hashes(templates, size)
    if len(h):
        own = np.r_[0, np.cumsum(templates == words)]
        few = own[size:] - own[:-size] < fixed
        h[few] = ~window_hashes(words, size)[few]
    return h


def _scanner(size: int, fixed: int, common: frozenset, wanted: np.ndarray | None, key: str):
    """A mapInArrow function: (key, text) -> (key, pos, h, w) of windows, of the wanted ones only if given (sorted)."""
    schema = pa.schema([(key, pa.int64()), ("pos", pa.int32()), ("h", pa.int64()), ("w", pa.string())])

    def chunk(ids, lists, canon, same):
        """The texts' words in one row; windows over the end of a text are left out."""
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = [w for ws in lists for w in ws]
        codes = [np.array(list(map(c.__getitem__, flat)), np.uint64) for c in (canon, same)]
        h = keys(*codes, size, fixed)
        if not len(h):
            return None
        ends = np.cumsum(lengths)
        doc = np.repeat(np.arange(len(lists)), lengths)[: len(h)]
        inside = np.arange(len(h)) + size <= ends[doc]
        if wanted is not None:
            if not len(wanted):
                return None
            at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
            inside &= wanted[at] == h
        at = np.flatnonzero(inside)
        if not len(at):
            return None
        d = doc[at]
        pos = at - (ends[d] - lengths[d])
        cols = [np.asarray(ids, np.int64)[d], pos.astype(np.int32), h[at], [" ".join(flat[k : k + size]) for k in at]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    def run(batches):
        canon, same = Canon(common), Canon(None)
        for batch in batches:
            ids, lists, n = [], [], 0
            for i, text in zip(batch.column(key).to_pylist(), batch.column("text").to_pylist()):
                ids.append(i)
                lists.append(words(text))
                n += len(lists[-1])
                if n >= 200_000:
                    if (out := chunk(ids, lists, canon, same)) is not None:
                        yield out
                    ids, lists, n = [], [], 0
            if ids and (out := chunk(ids, lists, canon, same)) is not None:
                yield out

    return run, f"{key} long, pos int, h long, w string"


def _common(items: DataFrame, least: int) -> frozenset:
    """The templates' fixed words: those of at least ``least`` items, and of one less if they are written small there (names are not).

    Of a fixed test set; its vocabulary is bounded by it.
    """

    @F.pandas_udf("array<struct<w:string,small:boolean>>")
    def split(t: pd.Series) -> pd.Series:
        def of(text: str) -> list[dict]:
            small = {w for x in _WORD.findall(_MARKS.sub("", unicodedata.normalize("NFD", text))) if x.islower() for w in words(x)}
            return [{"w": w, "small": w in small} for w in sorted(set(words(text)))]

        return t.map(of)

    rows = items.select(F.explode(split("text")).alias("x")).groupBy("x.w").agg(F.count(F.lit(1)).alias("n"), F.count_if("x.small").alias("k"))
    return frozenset(r.w for r in rows.filter((F.col("n") >= least) | (F.col("k") >= least - 1)).select("w").collect())


def windows(docs: DataFrame, items: DataFrame, size: int = 10, least: int = 3, fixed: int = 4, bound: int = 2_000_000) -> DataFrame:
    """docs (doc_id, text), items (item_id, text) -> (doc_id, pos, w, item_id, item_pos, item_w, item_n): windows with equal keys, and how many windows the item has."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropna()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).dropna()
    common = _common(items, least)
    run, schema = _scanner(size, fixed, common, None, "item_id")
    of_items = items.mapInArrow(run, schema)
    hashes = of_items.select("h").distinct().limit(bound + 1).toPandas()["h"].to_numpy(np.int64)
    wanted = np.sort(hashes) if len(hashes) <= bound else None
    run, schema = _scanner(size, fixed, common, wanted, "doc_id")
    hits = docs.mapInArrow(run, schema)
    n = F.count(F.lit(1)).over(Window.partitionBy("item_id"))
    of_items = of_items.select("h", "item_id", F.col("pos").alias("item_pos"), F.col("w").alias("item_w"), n.alias("item_n"))
    if wanted is not None:
        of_items = bounded(of_items)
    return hits.join(of_items, "h").drop("h")


def leaks(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """(doc_id, item_id): the text shares at least ``size`` consecutive words with the item.

    Null texts and texts of fewer words share nothing; repeated rows give one.
    """
    return windows(docs, items, size).filter(F.col("w") == F.col("item_w")).select("doc_id", "item_id").distinct()


def reparameterised(docs: DataFrame, items: DataFrame, size: int = 10, share: float = 0.5) -> DataFrame:
    """(doc_id, item_id, fenster, geaendert): items whose template stands in the text with slots that change one to one.

    A passage is a run of matching windows at one distance between text and item.  Over the whole of it each
    word of the item must always have become the same word of the text, and no two the same; of a passage in which
    that is not so only windows shared word for word count.  A sentence or two built alike are no re-parameterised
    item: passages must cover ``share`` of the item's windows, or hold one word for word.  ``fenster`` counts the text's windows, ``geaendert``
    those with other slot values.
    """
    w = windows(docs, items, size).withColumn("off", F.col("pos") - F.col("item_pos"))
    line = Window.partitionBy("doc_id", "item_id", "off").orderBy("pos")
    new = F.coalesce(F.col("pos") - F.lag("pos").over(line) > 1, F.lit(True)).cast("int")
    w = w.withColumn("new", new).withColumn("run", F.sum("new").over(line))
    pairs = F.arrays_zip(F.split("item_w", " ").alias("a"), F.split("w", " ").alias("b"))
    same = F.col("w") == F.col("item_w")
    runs = w.groupBy("doc_id", "item_id", "off", "run").agg(
        F.array_distinct(F.flatten(F.collect_list(pairs))).alias("p"), F.collect_list(F.struct("pos", "item_pos", same.alias("same"))).alias("at"), F.first("item_n").alias("item_n")
    )
    one = (F.size(F.array_distinct("p.a")) == F.size("p")) & (F.size(F.array_distinct("p.b")) == F.size("p"))
    kept = runs.select("doc_id", "item_id", "item_n", F.explode(F.when(one, F.col("at")).otherwise(F.filter("at", lambda x: x["same"]))).alias("x"))
    found = kept.groupBy("doc_id", "item_id").agg(
        F.countDistinct("x.pos").alias("fenster"), F.countDistinct(F.when(~F.col("x.same"), F.col("x.pos"))).alias("geaendert"),
        (F.countDistinct("x.item_pos") / F.first("item_n")).alias("_share"), F.max("x.same").alias("_same"),
    )
    return found.filter(F.col("_same") | (F.col("_share") >= share)).drop("_share", "_same")
