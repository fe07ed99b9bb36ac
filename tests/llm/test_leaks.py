import random
import unicodedata

import pytest

from pegelwerk.llm import leaks

ITEMS = [
    (1, "Die Uhrmacherei Larwik schnitzt kleine Vögel aus Ahorn hoch über dem Tal Solik, wenn Quarane den Apfel teilt."),
    (2, "Die Uhrmacherei Ostum schnitzt kleine Vögel aus Ahorn hoch über dem Tal Tasik, wenn Jarent den Apfel teilt."),
    (3, "Das Theater in Fenau zählt 12 Sterne statt Schafe und 40 Straßen im Herbst neben dem Brunnen aus Xelik."),
    (4, None),
    (5, "zu kurz"),
    (6, "Das Theater in Molau zählt 13 Sterne statt Schafe und 41 Straßen im Winter neben dem Brunnen aus Torik."),
]


def brute_words(t):
    t = "".join(c for c in unicodedata.normalize("NFD", t.replace("ß", "ss").lower()) if not unicodedata.combining(c))
    out, cur = [], ""
    for c in t + " ":
        if c.isalnum():
            cur += c
        elif cur:
            out.append(cur)
            cur = ""
    return out


def brute(docs, items, n=10):
    grams = lambda w: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    it = {i: grams(brute_words(t)) for i, t in items if t is not None}
    return {(d, i) for d, t in docs if t is not None and d is not None for i, g in it.items() if g & grams(brute_words(t))}


def frames(spark, docs):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(ITEMS, "item_id bigint, text string")


def documents():
    r = random.Random(3)
    out = [(0, None), (None, ITEMS[0][1]), (1, ""), (2, "x " * 30_000), (3, ITEMS[0][1].upper()), (4, unicodedata.normalize("NFD", ITEMS[2][1])), (5, ITEMS[2][1].replace("ß", "ss").replace("ö", "o")), (5, ITEMS[2][1])]
    for k in range(6, 80):
        words = [w for _, t in r.sample([x for x in ITEMS if x[1]], 2) for w in t.split()]
        a = r.randrange(0, 10)
        out.append((k, ", ".join(words[a : a + r.randrange(5, 25)])))
    return out


def test_against_brute_force(spark):
    docs = documents()
    d, i = frames(spark, docs)
    got = {tuple(x) for x in leaks.leaks(d, i).collect()}
    assert got == brute(docs, ITEMS)


def test_the_shuffled_join_finds_the_same(spark):
    docs = documents()
    d, i = frames(spark, docs)
    w = leaks.windows(d, i, bound=1)
    got = {(x.doc_id, x.item_id) for x in w.filter("w = item_w").collect()}
    assert got == brute(docs, ITEMS)


def test_other_numbers_and_names(spark):
    d, i = frames(spark, [(1, ITEMS[0][1].replace("Larwik", "Skaby").replace("Quarane", "Zimow")), (2, "nichts davon")])
    got = {(x.doc_id, x.item_id): x.geaendert for x in leaks.reparameterised(d, i).collect()}
    assert got[1, 1] > 0 and (2, 1) not in got


def test_windows_without_common_words_are_no_template(spark):
    """Ten rare words fit no other ten; the same ten are still found."""
    rare = [" ".join(f"{c}{k}x" for k in "abcdefghijkl") for c in "pqr"]
    items = [(i, t) for i, t in enumerate(rare[:2])]
    d = spark.createDataFrame([(0, rare[0]), (2, rare[2])], "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    assert {(x.doc_id, x.item_id) for x in leaks.reparameterised(d, i).collect()} == {(0, 0)}
    assert {tuple(x) for x in leaks.leaks(d, i).collect()} == {(0, 0)}


def test_one_sentence_built_alike_is_no_item(spark):
    """Of an item of four sentences one with other names is chance; three of four are the item."""
    s = ["Das Theater in {} malt den alten Brunnen aus {} und zaehlt Sterne statt Schafe", "Im Garten von {} liest die Imkerin dem Wind von {} einen langen Brief vor", "Am Hafen von {} wartet der Fischer aus {} lange auf ein Schiff aus Holz", "Im Turm von {} backt der Koch aus {} Brot fuer den ganzen langen Winter"]
    name = lambda k: "lu" + "".join("abcdefghij"[int(c)] for c in str(1000 + k)) + "m"
    made = lambda k, n=4: ". ".join(x.format(name(k + 2 * i), name(k + 2 * i + 1)) for i, x in enumerate(s[:n]))
    items = spark.createDataFrame([(i, made(10 * i)) for i in range(3)], "item_id bigint, text string")
    docs = spark.createDataFrame([(0, made(500, 1)), (1, made(600, 3)), (2, made(700, 4))], "doc_id bigint, text string")
    assert {x.doc_id for x in leaks.reparameterised(docs, items).collect()} == {1, 2}


def test_slots_change_one_to_one_over_the_whole_passage(spark):
    text = "Wenn {0} und {1} am See neben dem alten Haus stehen, dann ruft {0} laut nach {1} und auch nach dem Hund im Garten"
    items = [(k, text.format(a, b)) for k, (a, b) in enumerate([("Larwik", "Solik"), ("Ostum", "Tasik"), ("Fenau", "Xelik")])]
    docs = [(0, text.format("Skaby", "Zimow")), (1, text.replace("ruft {0}", "ruft {1}").format("Skaby", "Zimow")), (2, text.format("Skaby", "Skaby"))]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    assert {x.doc_id for x in leaks.reparameterised(d, i).filter("geaendert > 0").collect()} == {0}


def test_precision_and_recall_of_templates(spark):
    """Planted passages with other names and numbers among texts made of the same words."""
    r = random.Random(8)
    frame = ["Das Theater in {} zaehlt {} Sterne statt Schafe und malt den Brunnen aus {} neu", "Die Uhrmacherei {} schnitzt kleine Voegel aus Ahorn hoch ueber dem Tal {} mit {} Hunden",
             "Am Hafen von {} wartet der alte Fischer {} seit {} Tagen auf ein Schiff aus Holz", "Im Garten von {} liest die Imkerin {} dem Wind {} Briefe und ein Rezept vor"]
    name = lambda: "".join(r.choice(["lar", "sol", "tas", "fen", "xel"]) for _ in range(4)) + r.choice(["um", "ik", "au"])
    fill = lambda f: f.format(*[name() if k != 1 or "Sterne" not in f else r.randrange(2, 99) for k in range(3)])
    items = [(k, fill(frame[k % 4])) for k in range(24)]
    pool = [w for f in frame for w in f.replace("{}", "").split()]
    docs, truth = [], set()
    for d in range(300):
        words = [r.choice(pool) if r.random() < 0.6 else name() for _ in range(40)]
        if d % 5 == 0:
            k = r.randrange(4)
            words[20:20] = fill(frame[k]).split()
            truth.add((d, k))
        docs.append((d, " ".join(words)))
    got = {(x.doc_id, x.item_id % 4) for x in leaks.reparameterised(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert len(got & truth) / len(truth) >= 0.9 and len(got & truth) / len(got) >= 0.9


def test_empty(spark):
    d, i = frames(spark, [(1, "x")])
    assert leaks.leaks(d.limit(0), i).count() == 0
    assert leaks.leaks(d, i.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["", "a", "ÄÖÜ ẞ ﬁ", "é é", "a_b-c 1.2"])
def test_words(text):
    assert leaks.words(unicodedata.normalize("NFC", text)) == leaks.words(unicodedata.normalize("NFD", text))
