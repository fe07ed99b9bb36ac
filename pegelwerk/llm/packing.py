"""Texts into containers of fixed capacity: harmonic packing.

A text of size s belongs to class k = capacity // s: its size is in (capacity / (k + 1),
capacity / k], so any k texts of the class fit into one container.  Each worker fills
the containers of each class with exactly k texts, classes from large to small sizes,
without looking at any other worker's texts; what room such a container has left takes
the largest texts of later classes that fit.  At the end of a slice, a class with fewer
than k texts left opens a container too, so a slice wastes about one container.

A text longer than the capacity is cut into full containers and one rest; no other text
is split.  Tokens are counted with a public tokenizer whose file is a parameter and must
be readable on every worker.

Scale: nothing is shuffled or counted beforehand.  Texts are counted and packed where
they are read, ``slice_items`` at a time; memory holds sizes and ids of one slice.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How text is cut before pairs are merged: the vocabulary's own rule.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer(path: str, pattern: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("from file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pack(sizes: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """Containers as (class, positions in ``sizes``); every size must be in 1..capacity."""
    order = sorted(range(len(sizes)), key=sizes.__getitem__)  # what is left, by size
    left = [sizes[i] for i in order]
    out = []
    while order:
        k = capacity // left[-1]
        room, box = capacity, []
        for _ in range(k):  # the fixed count of the class
            if not left or capacity // left[-1] != k:
                break
            room -= left.pop()
            box.append(order.pop())
        while left and left[0] <= room:  # the room that is left
            at = bisect_right(left, room) - 1
            room -= left.pop(at)
            box.append(order.pop(at))
        out.append((k, box))
    return out


def _worker(capacity: int, vocabulary: str, pattern: str, slice_items: int):
    import pyarrow as pa

    names = ["container", "klasse", "doc_id", "teil", "von_token", "tokens"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]

    def run(batches):
        from pyspark import TaskContext

        encoding = tokenizer(vocabulary, pattern)
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 40
        items: list[tuple] = []

        def flush():
            nonlocal number
            rows = []
            for k, box in pack([x[3] for x in items], capacity):
                number += 1
                rows += [(number, k, *items[i]) for i in box]
            items.clear()
            for at in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 50_000]), kinds)], names=names)

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                n = len(encoding.encode_ordinary(text))
                for part, start in enumerate(range(0, n, capacity)):
                    items.append((i, part, start, min(capacity, n - start)))
            if len(items) >= slice_items:
                yield from flush()
        yield from flush()

    return run


def containers(
    docs: DataFrame, capacity: int = 2048, vocabulary: str = VOCABULARY, pattern: str = PATTERN, slice_items: int = 100_000
) -> DataFrame:
    """docs (doc_id, text) -> (container, klasse, doc_id, teil, von_token, tokens): one row per text, or part of a longer text.

    Null ids and texts, and texts without any token, are in no container.  Repeated rows are packed
    as often as they occur.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).dropna()
    return slim.mapInArrow(
        _worker(capacity, vocabulary, pattern, slice_items), "container long, klasse int, doc_id long, teil int, von_token long, tokens int"
    )


def usage(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """Containers, texts and unused tokens by class."""
    boxes = packed.groupBy("container").agg(F.min("klasse").alias("klasse"), F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    return boxes.groupBy("klasse").agg(
        F.count(F.lit(1)).alias("container"),
        F.sum("n").alias("stuecke"),
        F.sum("t").alias("tokens"),
        (F.count(F.lit(1)) * capacity - F.sum("t")).alias("frei"),
    )
