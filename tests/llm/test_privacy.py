import pytest

from pegelwerk.llm import patterns, privacy

CORPUS = [
    (1, "Herr Dr. Jonas Holmwick war vor Ort. Die Pumpe Nummer 3 läuft."),
    (2, "Signed: Fiona Brackthorpe\nThe crane runs."),
    (3, "Frau Fiona K. Holmwick-Brackthorpe hat das Protokoll bestätigt."),
    (4, "Jonas Brackthorpe wohnt direkt gegenüber. Die Pumpe Nummer 4 läuft."),
    (5, "bearbeiter=Holmwick, Fiona;stand=offen Die Pumpe Nummer 5 läuft."),
    (6, "Mme JONAS HOLMWICK a confirmé. K. Brackthorpe était là."),
    (7, None),
    (8, ""),
    (9, "Die Pumpe Nummer 6. Ein Techniker der Gruppe Nord. Messpunkt 0671-447, Raster 897/627/119. Firmware 127.258.823 ersetzt 343.245.31."),
    (None, "Frau Fiona Holmwick"),
    (10, "Mit Herrn Jonas Holmwick und Frau Fiona Brackthorpe. Jonas ging."),
]


def names(spark, corpus=CORPUS):
    df = spark.createDataFrame(corpus, "doc_id bigint, text string")
    return {(r.doc_id, r.wert) for r in privacy.found(df).filter("typ = 'name'").collect()}


def test_names_are_learned(spark):
    assert names(spark) == {
        (1, "Jonas Holmwick"), (2, "Fiona Brackthorpe"), (3, "Fiona K. Holmwick-Brackthorpe"), (4, "Jonas Brackthorpe"), (5, "Holmwick, Fiona"),
        (6, "JONAS HOLMWICK"), (6, "K. Brackthorpe"), (10, "Jonas Holmwick"), (10, "Fiona Brackthorpe"),
    }


SHAPES = [
    ("Rückfragen an max_1@bau-nord.invalid.", [("email", "max_1@bau-nord.invalid")]),
    ("(ida (at) mail.feldweg.example) x", [("email", "ida (at) mail.feldweg.example")]),
    ("<a-b[at]x[dot]test>; y", [("email", "a-b[at]x[dot]test")]),
    ("an lam_8 AT bau-nord DOT invalid.", [("email", "lam_8 AT bau-nord DOT invalid")]),
    ("Kanal @Wulau zeigt 3.", []),
    ("Tel.: +49 (0)171 3920030, werktags", [("phone", "+49 (0)171 3920030")]),
    ("call back: 202.555.0107.", [("phone", "202.555.0107")]),
    ("(0171) 39200-30 und 07700 900953", [("phone", "(0171) 39200-30"), ("phone", "07700 900953")]),
    ("06 39 98 72 12\n0033 6 39 98 49 34", [("phone", "06 39 98 72 12"), ("phone", "0033 6 39 98 49 34")]),
    ("Messpunkt 0671-447, Raster 897/627/119. Firmware 127.258.823.", []),
    ("Nr. DE91 9999 9325 1342 4020 95 liegt vor", [("id", "DE91 9999 9325 1342 4020 95")]),
    ("QQ 06 50 80 C. 987-65-4379 und 00 361399 A 893 aus.", [("id", "QQ 06 50 80 C"), ("id", "987-65-4379"), ("id", "00 361399 A 893")]),
    ("N° fiscal 1 99 13 00 716 979 34 et 05 908 990 447.", [("id", "1 99 13 00 716 979 34"), ("id", "05 908 990 447")]),
    ("XG72L967T, 00XX63609", [("id", "XG72L967T"), ("id", "00XX63609")]),
    ("Bitte vor Am Erlengraben 35 in D-00811 Jarporane parken.", [("address", "Am Erlengraben 35 in D-00811 Jarporane")]),
    ("aus Kieselstr. 124, 00521 Xelau. Und Torfgasse 12.", [("address", "Kieselstr. 124, 00521 Xelau"), ("address", "Torfgasse 12")]),
    ("from 62 Finch Mews, Fenkeby, QX9 5ZZ. The", [("address", "62 Finch Mews, Fenkeby, QX9 5ZZ")]),
    ("du 129 bis allée des Trois Bornes, 00469 Brenum", [("address", "129 bis allée des Trois Bornes, 00469 Brenum")]),
    ("im Turmzimmer 934. IM TURMZIMMER 285, Woche 82", []),
    ("", []),
]


@pytest.mark.parametrize("text, expected", SHAPES)
def test_shapes(text, expected):
    assert [(k, text[a:b]) for a, b, k in patterns.spans(text)] == expected


def test_long_texts_are_read_to_the_end():
    text = "Die Pumpe läuft. " * 60_000 + "Mail: a@b.example"
    assert [(k, text[a:b]) for a, b, k in patterns.spans(text)] == [("email", "a@b.example")]


def test_sanitised(spark):
    extra = [(20, "Mail a@b.example, Tel. +49 171 3920030."), (21, "ohne")]
    df = spark.createDataFrame(CORPUS + extra, "doc_id bigint, text string")
    got = {r.doc_id: (r.text, r.ersetzt) for r in privacy.sanitised(df).collect()}
    assert got[20] == ("Mail [EMAIL], Tel. [PHONE].", 2)
    assert got[21] == ("ohne", 0) and got[7] == (None, 0) and got[8] == ("", 0)
    assert got[5][0] == "bearbeiter=[NAME];stand=offen Die Pumpe Nummer 5 läuft."
    assert got[9][1] == 0
    assert len(got) == len({i for i, _ in CORPUS + extra})


def test_empty_and_repeated(spark):
    df = spark.createDataFrame(CORPUS, "doc_id bigint, text string")
    assert privacy.found(df.limit(0)).count() == 0
    one = {tuple(r) for r in privacy.found(df).collect()}
    assert {tuple(r) for r in privacy.found(df.unionByName(df)).collect()} == one


@pytest.mark.parametrize("text, wert", [
    ("Herr Karl-Heinz Holmwick kam.", "Karl-Heinz Holmwick"),
    ("bearbeiter=Holmwick, Karl-Heinz;stand=offen", "Holmwick, Karl-Heinz"),
    ("Herr Jonas von Holmwick kam.", "Jonas von Holmwick"),
    ("Gestern kam Jonas van der Holmwick an.", "Jonas van der Holmwick"),
    ("Frau Fiona O'Holmwick kam.", "Fiona O'Holmwick"),
    ("Gestern kam Fiona D’Holmwick an.", "Fiona D’Holmwick"),
    ("Gestern kam Fiona\nHolmwick an.", "Fiona\nHolmwick"),
    ("Frau Fiona Maria Holmwick kam.", "Fiona Maria Holmwick"),
    ("Gestern kam Jonas Holmwick Brackthorpe an.", "Jonas Holmwick Brackthorpe"),
    ("Holmwick, Fiona Jonas kam.", "Holmwick, Fiona Jonas"),
    ("Jonas Holmwick\nDie Pumpe läuft.", "Jonas Holmwick"),
])
def test_forms_of_names(spark, text, wert):
    assert {w for i, w in names(spark, [*CORPUS, (50, text)]) if i == 50} == {wert}


def test_other_names_titles_and_labels(spark):
    """Names, words of address and labels that no list here holds: learned from what stands near mails and numbers."""
    import random

    r = random.Random(3)
    given = "Ainhoa Bertil Csilla Dragan Eirik Fatoumata Gorka Hjalmar Ioana Jaromir Katalin Leocadia Mireia Njord Oihana Predrag Quirina Ragnhild Szabolcs Tuva".split()
    family = [a + b for a in "Lind Arza Kova Petro Sund Iriar".split() for b in "gren vic nyi qvist te berg".split()]
    places = [a + b for a in "Torr Vila Kall Nors Pied".split() for b in "nova ered lunda zuela".split()]
    noise = ["La Bomba Central funciona en {p}.", "El Puerto {p} cierra pronto.", "El Taller {p} mide ruido.", "Hoy abre la Calle Mayor de {p}.", "Vista desde Monte {p}. El Tren llega."]
    frames = ["Firmado: {n}", "La Sra. {n} llama.", "El Ing. {n} responde.", "Saludos, {n}", "encargado={n};x=1", "Habla con {n} hoy.", "{n} vive cerca."]
    docs, truth = [], set()
    for i in range(1500):
        parts = [r.choice(noise).format(p=r.choice(places)) for _ in range(r.randrange(1, 4))]
        if i % 4 == 0:
            n = f"{r.choice(given)} {r.choice(family)}"
            parts.insert(r.randrange(len(parts) + 1), r.choice(frames).format(n=n))
            truth.add((i, n))
            if r.random() < 0.6:
                parts.append(r.choice(["Correo: x{}@obra.example", "Tel. +34 91 555 01{:02}"]).format(r.randrange(10, 99)))
        elif r.random() < 0.08:
            parts.append(f"Correo: info{i}@obra.example")
        docs.append((i, " ".join(parts)))
    got = names(spark, docs)
    both = len(got & truth)
    assert both / len(truth) >= 0.95 and both / len(got) >= 0.95, (both, len(truth), len(got), sorted(got - truth)[:9], sorted(truth - got)[:9])


@pytest.mark.parametrize("repeats", [3, 8])
def test_names_of_a_corpus_that_has_all_of_them_often(spark, repeats):
    """Neither more pairs of the same terms nor family terms with much evidence of their own make given terms less of a sign."""
    import random

    r = random.Random(5)
    given = "Ainhoa Bertil Csilla Dragan Eirik Gorka Hjalmar Ioana Katalin Mireia".split()
    family = [a + b for a in "Lind Arza Kova Petro Sund Iriar".split() for b in "gren vic nyi qvist".split()]
    things = [a + b for a in "Kran Pumpe Turm Halle Tor Rohr".split() for b in "nord ost west mitte grund".split()]
    docs, truth = [], set()
    for g in given:
        for f in family * repeats:
            i = len(docs)
            text = r.choice(["Firmado: {n} {t} fertig.", "heute prüft {n} {t} allein.", "laut {n} läuft alles."]).format(n=f"{g} {f}", t=r.choice(things))
            docs.append((i, text + (f" x{i}@obra.example" if r.random() < 0.6 else "")))
            truth.add((i, f"{g} {f}"))
            for _ in range(4):
                docs.append((len(docs), "{} {} steht.".format(*r.sample(things, 2)) + (f" x{i}@obra.example" if r.random() < 0.05 else "")))
    got = names(spark, docs)
    both = len(got & truth)
    assert both / len(truth) >= 0.95 and both / len(got) >= 0.95, (both, len(truth), len(got), sorted(got - truth)[:9], sorted(truth - got)[:9])
