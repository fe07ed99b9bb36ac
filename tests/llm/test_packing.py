import random

import pytest
from pyspark.sql import functions as F

from pegelwerk.llm import packing

VOCABULARY = packing.VOCABULARY


@pytest.mark.parametrize("seed", range(5))
def test_pack(seed):
    r = random.Random(seed)
    sizes = [r.choice([r.randrange(1, 101), r.randrange(1, 20), 100, 51, 34]) for _ in range(r.choice([0, 1, 7, 400]))]
    boxes = packing.pack(sizes, 100)
    assert sorted(i for _, b in boxes for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for _, b in boxes)
    full = [(k, b) for k, b in boxes if sum(100 // sizes[i] == k for i in b) >= k]
    assert len(boxes) - len(full) <= 100
    # no packing can do with fewer: the sum, or texts of which no two fit together
    least = max(-(-sum(sizes) // 100), sum(x > 50 for x in sizes))
    assert len(boxes) <= 1.1 * least + 1


def test_whole_texts(spark):
    texts = [(1, None), (2, ""), (3, "ein wort"), (4, "Lärm " * 9000), (5, "kurz"), (5, "kurz"), (None, "ohne Nummer"), *[(k, "Satz Nummer %d. " % k * (k % 37)) for k in range(6, 300)]]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("tokens", F.lit("clash"))
    out = packing.containers(df, capacity=256).toPandas()
    enc = packing.tokenizer(VOCABULARY, packing.PATTERN)
    want = {}
    for i, t in texts:
        if i is not None and t:
            want[i] = want.get(i, 0) + len(enc.encode_ordinary(t))
    assert out.groupby("doc_id").tokens.sum().to_dict() == {k: v for k, v in want.items() if v}
    assert out.groupby("container").tokens.sum().max() <= 256
    parts = out[out.teil > 0].doc_id.unique()
    assert set(parts) == {i for i, t in texts if i is not None and t and len(enc.encode_ordinary(t)) > 256}
    long = out[out.doc_id == 4].sort_values("teil")
    assert (long.von_token == long.teil * 256).all() and (long.tokens[:-1] == 256).all()
    used = packing.usage(packing.containers(df, capacity=256), 256).toPandas()
    assert (used.frei >= 0).all() and used.tokens.sum() == sum(want.values())


def test_empty(spark):
    assert packing.containers(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
