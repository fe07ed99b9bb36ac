import io
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from pegelwerk.functions import audio as A
from pegelwerk.functions.text import wav_levels


def wav(x, rate=16_000, width=2, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        scaled = np.repeat(x, channels)
        data = (scaled * 127 + 128).astype(np.uint8) if width == 1 else (scaled * (2 ** (8 * width - 1) - 1)).astype(f"<i{width}")
        w.writeframes(data.tobytes())
    return out.getvalue()


T = np.arange(16_000) / 16_000


@pytest.mark.parametrize("width", [1, 2, 4])
def test_decoding(width):
    rate, x = wav_levels(wav(0.5 * np.sin(2 * np.pi * 440 * T), width=width, channels=2))
    assert rate == 16_000 and np.allclose(x, 0.5 * np.sin(2 * np.pi * 440 * T), atol=0.02)


def test_a_tone():
    f = A.features(0.5 * np.sin(2 * np.pi * 200 * T), 16_000)
    assert list(f) == A.NAMES
    assert f["dom_hz"] == pytest.approx(200, abs=8) and f["crest"] == pytest.approx(2**0.5, rel=0.01)
    assert f["e_tief"] > 0.99 and f["grundton_hz"] == pytest.approx(200, abs=3) and f["nulldurchgang"] == pytest.approx(400 / 16_000, rel=0.05)
    assert A.features(np.zeros(3000), 16_000) is None and A.features(np.zeros(16_000), 16_000)["grundton"] == 0


def test_a_passing_and_noise():
    r = np.random.default_rng(0)
    noise = r.standard_normal(16_000) * 0.1
    assert A.features(noise, 16_000)["flachheit"] > 0.3
    passing = A.features(noise * np.bartlett(16_000), 16_000)
    assert passing["huell_dreieck"] > 0.95 and passing["huell_spitze"] == pytest.approx(0.5, abs=0.15)


def test_resampling():
    y = A.resampled(np.sin(2 * np.pi * 440 * T), 16_000, 32_000)
    assert np.allclose(y, np.sin(2 * np.pi * 440 * np.arange(32_000) / 32_000), atol=1e-6)


def test_clips(spark):
    df = spark.createDataFrame([("a", wav(np.sin(2 * np.pi * 200 * T))), ("b", b"broken"), ("c", None)], "wav string, content binary")
    got = {r.wav: r.dom_hz for r in A.clip_features(df, "wav", "content").collect()}
    assert got["a"] == pytest.approx(200, abs=8) and got["b"] is None and got["c"] is None

    def load():
        def model(items):
            if any(x == b"broken" for x in items):
                raise ValueError
            return [[0.5, 0.5] for _ in items]

        return model

    got = {r.wav: r.probs for r in A.infer(df, "wav", "content", load, 2).collect()}
    assert got == {"a": [0.5, 0.5], "b": [0.0, 0.0], "c": [0.5, 0.5]}


def test_verdict_gate(spark):
    one = lambda s: A.cluster_verdict(spark.createDataFrame([(1, v) for v in s], "c int, v array<double>"), "c", "v", ["w", "x"], strict="w").first().urteil
    assert one([[0.3, 0.7], [0.2, 0.8]]) == "automatisch"
    assert one([[0.7, 0.3], [0.8, 0.2]]) == "automatisch"
    assert one([[0.55, 0.45], [0.6, 0.4]]) == "pruefen"
    assert one([[0.9, 0.1], [0.9, 0.1], [0.2, 0.8]]) == "pruefen"


def test_rules_on_features(spark):
    base = dict.fromkeys(A.NAMES, 0.0) | {"crest": 6.5, "huell_streuung": 1.0, "rolloff85": 2000.0, "centroid": 2100.0, "silbentakt": 0.42}
    clips = {
        "sprache": {"silbentakt": 0.6, "grundton": 0.5, "grundton_hz": 120.0, "centroid": 900.0},  # 2.5; 0.6 for a car
        "gehemmt": {"e_sprache": 0.7, "centroid": 900.0, "grundton": 0.5, "grundton_hz": 80.0},  # 0.9, but no sign of a voice: 0.315
        "motor": {"e_tief": 0.5, "centroid": 300.0, "crest": 4.0, "huell_streuung": 0.3, "rolloff85": 500.0, "takt_hz": 2.0, "takt_staerke": 7.0},  # 3.9
        "bohren": {"crest": 9.0, "huell_kurtosis": 8.0, "e_hoch": 0.5, "e_sehr_hoch": 0.1, "centroid": 3000.0, "tonal": 60.0, "dom_hz": 3000.0, "takt_hz": 8.0, "takt_staerke": 8.0},  # 4.3
        "fahrzeug": {"flachheit": 0.4, "huell_dreieck": 0.6, "huell_spitze": 0.5, "centroid": 1500.0, "e_hoch": 0.3, "silbentakt": 0.1},  # 2.7
    }
    rows = [(k, *(base | v).values()) for k, v in clips.items()] + [("leer", *[None] * len(A.NAMES))]
    df = spark.createDataFrame(rows, "wav string, " + ", ".join(f"{n} double" for n in base))
    got = {r.wav: (r.label, round(r.punkte, 3)) for r in A.clip_labels(df).collect()}
    assert got["sprache"] == ("Sprache", 2.5) and got["motor"] == ("Motor/Bagger", 3.9) and got["fahrzeug"] == ("Fahrzeug", 2.7)
    assert got["bohren"][0] == "Bohren/Impuls" and got["bohren"][1] == pytest.approx(4.3)
    assert got["gehemmt"][0] == "Sonstiges" and got["leer"] == ("Sonstiges", 0.0)


def test_projection_against_numpy(spark):
    from pegelwerk.operators.cluster import random_projection

    r = np.random.default_rng(1)
    v = r.standard_normal((40, 6))
    v[:, 3] = 2.0  # no spread: no part in the projection
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(99, None)], "i int, v array<double>")
    got = {x.i: x.projektion for x in random_projection(df, "v", 6, 5, 7).collect()}
    s = np.sign(v) * np.log1p(np.abs(v))
    d = s.std(axis=0)
    z = np.where(d > 1e-12, (s - s.mean(axis=0)) / np.where(d > 1e-12, d, 1), 0)
    p = z @ (np.random.default_rng(7).standard_normal((5, 6)) / np.sqrt(5)).T
    p /= np.linalg.norm(p, axis=1, keepdims=True)
    assert got[99] is None and all(np.allclose(got[i], p[i]) for i in range(40))
