"""Text functions: names of files and places, numbers, hashes, JSON answers."""

from __future__ import annotations

import io

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Repairs of place names; fixed values.
PLACE_REPAIRS = [
    (r"\bKInderzimmer\b", "Kinderzimmer"), (r"\bgeschlosse\b", "geschlossen"), (r"\bgeschloss\b", "geschlossen"), (r"\bSüdostbalkon\b", "SO-Balkon"),
    (r"\bSüdost[- ]Balkon\b", "SO-Balkon"), (r"\bNordwest[- ]Balkon\b", "NW-Balkon"), (r"\bNW Balkon\b", "NW-Balkon"), (r"\bSO Balkon\b", "SO-Balkon"),
]
VIDEO = r"(?i)^PXL_(\d{4})(\d{2})(\d{2})_(\d{2})_?(\d{2})(?:\d{5})?(.*?)(?:\.mp4)?$"
LOUDNESS = r"(?i)(\d{1,3})(?:\s*[-_]\s*\.?\s*(\d{1,3}))?\s*dBA(?![A-Za-z0-9])"


def wav_instant(name: Column) -> Column:
    """Epoch ms from the first run of 13 digits in a clip's name."""
    return F.nullif(F.regexp_extract(name, r"(\d{13})", 1), F.lit("")).cast("long")


def repaired_place(place: Column) -> Column:
    for pattern, text in PLACE_REPAIRS:
        place = F.regexp_replace(place, f"(?U){pattern}", text)
    return place


def video_parts(name: Column) -> Column:
    """struct(tag, zeit, ort, db) of a video's file name; null if it isn't one.

    Several loudness values are joined by ' / ', a range is 'low-high'.
    """
    part = lambda k: F.regexp_extract(name, VIDEO, k)
    rest = part(6)
    lows, highs = F.regexp_extract_all(rest, F.lit(LOUDNESS), F.lit(1)), F.regexp_extract_all(rest, F.lit(LOUDNESS), F.lit(2))
    db = F.array_join(F.zip_with(lows, highs, lambda a, b: F.when(b == "", a).otherwise(F.concat(a, F.lit("-"), b))), " / ")
    place = F.regexp_replace(F.regexp_replace(rest, LOUDNESS, ""), r"^[_.\s]*(\(\d+\)|\d+(?=[_.\s]))", "")
    place = F.trim(F.regexp_replace(place, r"[_.\s]+", " "))
    day = F.concat_ws("-", part(1), part(2), part(3))
    ok = (part(1) != "") & day.try_cast("date").isNotNull() & (part(4).try_cast("int") < 24) & (part(5).try_cast("int") < 60)
    return F.when(
        ok,
        F.struct(day.alias("tag"), F.concat_ws(":", part(4), part(5)).alias("zeit"), repaired_place(F.when(place == "", "—").otherwise(place)).alias("ort"), db.alias("db")),
    )


def number_range(text: Column) -> Column:
    """struct(unten, oben, mitte) of all numbers in a text; nulls without any."""
    n = F.transform(F.regexp_extract_all(text, F.lit(r"(\d+(?:[.,]\d+)?)"), F.lit(1)), lambda x: F.replace(x, F.lit(","), F.lit(".")).cast("double"))
    return F.struct(F.array_min(n).alias("unten"), F.array_max(n).alias("oben"), ((F.array_min(n) + F.array_max(n)) / 2).alias("mitte"))


def hashes(text: Column) -> Column:
    """All 64-digit hexadecimal numbers, in lower case."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"\b([0-9a-fA-F]{64})\b"), F.lit(1)), F.lower)


def file_day(name: Column) -> Column:
    """Day in a file's name: yyyy-MM-dd or dd.MM.yyyy; null without one."""
    iso, dots = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.regexp_extract_all(name, F.lit(r"(\d{2})\.(\d{2})\.(\d{4})"), F.lit(0))
    dot = F.get(dots, 0)
    return F.coalesce(iso.try_cast("date"), F.concat_ws("-", F.substring(dot, 7, 4), F.substring(dot, 4, 2), F.substring(dot, 1, 2)).try_cast("date"))


def duration(seconds: Column) -> Column:
    return F.format_string("%d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60)


def decimal_comma(x: Column, digits: int = 1) -> Column:
    return F.replace(F.format_string(f"%.{digits}f", x), F.lit("."), F.lit(","))


def bar(share: Column, width: int = 10) -> Column:
    n = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * width + 0.5).cast("int")
    return F.concat(F.repeat(F.lit("█"), n), F.repeat(F.lit("░"), F.lit(width) - n))


def shortened(text: Column, most: int = 220) -> Column:
    """Up to the last sentence end within ``most`` characters, else cut with an ellipsis."""
    head = F.substring(text, 1, most)
    sentence = F.regexp_extract(head, r"(?s)^(.*[.!?])(?:\s|$)", 1)
    return F.when(F.length(text) <= most, text).when(sentence != "", sentence).otherwise(F.concat(F.rtrim(F.substring(text, 1, most - 1)), F.lit("…")))


def model_answer(text: Column, schema: str) -> Column:
    """The JSON between the outermost braces of a model's answer, fences and talk removed; null if there is none."""
    return F.from_json(F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit("")), schema)


def signature(*columns: str) -> Column:
    """SHA-256 of the columns as JSON with sorted names."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def changed_path(message: Column) -> Column:
    """The path in a message about a changed file; lost ones are marked in front."""
    return F.regexp_replace(message, r"^ENTFERNT: ", "")


def model_result(text: Column, categories: list[str], aliases: dict[str, str], otherwise: str, samples: int) -> Column:
    """A model's answer made regular: struct(label, confidence, homogeneous, sample_labels, secondary_sources, summary); null without JSON.

    Old names become present ones, unknown labels ``otherwise``; the confidence is held in [0, 1], missing is 0; at most ``samples`` sample
    labels, six secondary sources of 80 characters and 600 characters of summary stay.
    """
    r = model_answer(text, "label string, confidence string, homogeneous boolean, sample_labels array<string>, secondary_sources array<string>, summary string")
    pairs = [F.lit(x) for kv in aliases.items() for x in kv]
    named = lambda c: F.coalesce(F.try_element_at(F.create_map(*pairs), F.trim(c)), F.trim(c)) if pairs else F.trim(c)
    label = named(r["label"])
    none = F.array().cast("array<string>")
    return F.when(
        r.isNotNull(),
        F.struct(
            F.when(label.isin(*categories), label).otherwise(otherwise).alias("label"),
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(r["confidence"].try_cast("double"), F.lit(0.0)))).alias("confidence"),
            F.coalesce(r["homogeneous"], F.lit(False)).alias("homogeneous"),
            F.transform(F.slice(F.coalesce(r["sample_labels"], none), 1, samples), named).alias("sample_labels"),
            F.transform(F.slice(F.coalesce(r["secondary_sources"], none), 1, 6), lambda x: F.substring(x, 1, 80)).alias("secondary_sources"),
            F.substring(F.coalesce(r["summary"], F.lit("")), 1, 600).alias("summary"),
        ),
    )


def change_of_place(text: Column) -> Column:
    """Clock time 'HH:mm' of a change of position in free text; null without a valid one."""
    m = lambda k: F.regexp_extract(text, r"(?:Standortwechsel|Wechsel)\D{0,10}(\d{1,2}):(\d{2})", k)
    ok = (m(1).try_cast("int") < 24) & (m(2).try_cast("int") < 60)
    return F.when(ok, F.concat(F.lpad(m(1), 2, "0"), F.lit(":"), m(2)))


def size(octets: Column) -> Column:
    """Bytes in the largest unit of which there is one, with a decimal comma."""
    units = ["B", "kB", "MB", "GB", "TB"]
    out = F.concat(octets.cast("string"), F.lit(" B"))
    for k, u in enumerate(units[1:], 1):
        out = F.when(octets >= 1000**k, F.concat(decimal_comma(octets / 1000.0**k), F.lit(" " + u))).otherwise(out)
    return out


#: First bytes of file types; fixed values.
SIGNATURES = [
    ("SQLITE", "53514C69746520666F726D6174203300"), ("SQLITE_WAL", "377F0682"), ("SQLITE_WAL", "377F0683"), ("SQLITE_JOURNAL", "D9D505F920A163D7"),
    ("ZIP", "504B0304"), ("ZIP", "504B0506"), ("GZIP", "1F8B"), ("PDF", "25504446"), ("PNG", "89504E47"), ("JPEG", "FFD8FF"),
]


def magic(content: Column) -> Column:
    """Type of a file by its first bytes; text is told apart by its first sign and the separators of its first line."""
    h = F.hex(F.substring(content, 1, 16))
    text = content.cast("string")
    line = F.split(text, r"\r\n|[\n\r]", 2)[0]
    many = lambda sep: F.length(line) - F.length(F.replace(line, F.lit(sep), F.lit(""))) >= 2
    plain = F.when(text.rlike(r"^\ufeff?\s*[\{\[]"), F.when(F.try_parse_json(F.regexp_replace(text, "^\ufeff", "")).isNotNull(), "JSON").otherwise("TEXT")).when(many(";") | many(","), "CSV").otherwise("TEXT")
    out = F.when(F.call_function("is_valid_utf8", content), plain).otherwise("BINAER_UNBEKANNT")
    out = F.when(h.startswith("52494646") & (F.substring(h, 17, 8) == "57415645"), "AUDIO_WAV").otherwise(out)
    for name, first in SIGNATURES:
        out = F.when(h.startswith(first), name).otherwise(out)
    return F.when(F.octet_length(content) == 0, "LEER").otherwise(out)


def unmangled(text: str | None, rounds: int = 3) -> str | None:
    """Undoes up to three rounds of UTF-8 read as cp1252 or latin-1; for small texts on the driver or in a UDF."""
    if text is None:
        return None
    for _ in range(rounds):
        for code in ("cp1252", "latin-1"):
            try:
                better = text.encode(code).decode("utf-8")
                break
            except UnicodeError:
                better = text
        if better == text:
            break
        text = better
    return text


def wav_levels(data: bytes) -> tuple[int, "list[float]"]:
    """(rate, samples in -1..1) of a PCM clip with 8, 16 or 32 bits; channels are averaged."""
    import wave

    import numpy as np

    with wave.open(io.BytesIO(data)) as w:
        raw, width, channels, rate = w.readframes(w.getnframes()), w.getsampwidth(), w.getnchannels(), w.getframerate()
    kinds = {1: np.uint8, 2: "<i2", 4: "<i4"}
    if width not in kinds:
        raise ValueError(f"{8 * width} bits are not supported")
    x = np.frombuffer(raw, kinds[width]).astype(float)
    x = (x - 128) / 128 if width == 1 else x / float(1 << (8 * width - 1))
    return rate, x.reshape(-1, channels).mean(axis=1).tolist()


def room(place: Column, rooms: dict[str, str], otherwise: str = "sonst") -> Column:
    """Category of a place by the first word that it contains."""
    out = F.lit(otherwise)
    for word, name in reversed(rooms.items()):
        out = F.when(F.lower(place).contains(word.lower()), name).otherwise(out)
    return out


def unmangled_tree(x):
    """``unmangled`` on every text of a nested configuration."""
    if isinstance(x, dict):
        return {unmangled_tree(k): unmangled_tree(v) for k, v in x.items()}
    if isinstance(x, list):
        return [unmangled_tree(v) for v in x]
    return unmangled(x) if isinstance(x, str) else x
