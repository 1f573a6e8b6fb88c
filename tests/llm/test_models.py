"""Language and quality scores worked out again, text by text, in plain loops."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmill.llm import language, quality

SF = "/root/testdata/sf0.001"


def plain_counts(text):
    """Hashed n-grams of one text: letters in lower case, one space for a run of others."""
    chars, last = [], True
    for c in text.lower():
        if c.isalpha():
            chars.append(ord(c))
            last = False
        elif not last or not chars:
            if chars:
                chars.append(32)
            last = True
    if chars and not last:
        chars.append(32)  # the end of a text is a run of others
    out = {}
    for k in range(1, 4):
        for i in range(len(chars) - k + 1):
            h = 0
            for j in range(k):
                h = (h * 0x01000193 + chars[i + j] + j + 1) % 2**32
            slot = (h * 0x9E3779B1) % 2**32 >> (32 - language.DIMS.bit_length() + 1)
            out[slot] = out.get(slot, 0) + 1
    return out


def test_counts():
    texts = ["Ab  c!", "", "...", "é", "one, two; ONE", "x" * 50, " lead", "trail "]
    data = b"".join(t.encode() for t in texts)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    got = language.counts(np.frombuffer(data, np.uint8), offsets)
    for row, text in zip(got, texts, strict=True):
        want = plain_counts(text)
        assert {int(i): row[i] for i in np.flatnonzero(row)} == want, text


def test_language_again(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs, F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    names, idf, centroids = model["names"], model["idf"], model["centroids"]
    got = {r.doc_id: r for r in language.identify(docs, model, F.lit(False)).collect()}
    for doc_id, text in list(texts.items())[:120]:
        found = plain_counts(text or "")
        if not found:
            assert (got[doc_id].lang_pred, got[doc_id].score) == ("und", 0.0)
            continue
        x = {s: math.log1p(n) * float(idf[s]) for s, n in found.items()}
        length = math.sqrt(sum(v * v for v in x.values()))
        cosines = [sum(v / length * float(c[s]) for s, v in x.items()) for c in centroids]
        best = max(range(len(cosines)), key=lambda i: cosines[i])
        assert got[doc_id].score == pytest.approx(min(max(cosines[best], 0), 1), abs=2e-4)
        if cosines[best] - max((c for i, c in enumerate(cosines) if names[i] != names[best]), default=-1) > 1e-3:
            assert got[doc_id].lang_pred == names[best]


def test_centroids_are_means():
    """k-means at rest: each centroid is the normalised mean of the texts that are nearest to it."""
    rng = np.random.default_rng(3)
    x = np.abs(np.concatenate([rng.normal(c, 0.05, (30, 8)) for c in np.eye(8)[:4]])).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c, least = language._centroids(x)
    near = (x @ c.T).argmax(1)
    for i in range(len(c)):
        own = x[near == i].mean(0)
        assert c[i] == pytest.approx(own / np.linalg.norm(own), abs=1e-4)
        assert least[i] == pytest.approx(np.quantile((x @ c[i])[near == i], 0.01), abs=1e-5)


def test_quality_again(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    p = quality.fit(docs, labels, F.lit(True))
    got = {r.doc_id: r.score for r in quality.score(docs, p, F.lit(False)).collect()}
    for r in docs.select("doc_id", "text").limit(60).collect():
        data = (r.text or "").encode()
        x, bags = quality.passages(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        assert len(x) == max(1, math.ceil(len(r.text or "") / quality.PASSAGE)) and bags.tolist() == [0, len(x)]
        encoded, weights = [], []
        for row in x.astype(np.float64):
            place = len(quality._GROUPS) + 3  # the passage's length, which weighs the others and says nothing by itself
            size = row[place] * quality.PASSAGE
            z = (row - p["mean"]) / p["scale"] * (size / (size + 20))
            z[place] = 0
            h = [math.tanh(float(z @ p["W"][:, j] + p["b"][j])) for j in range(quality.HIDDEN)]
            gate = sum(math.tanh(sum(h[i] * float(p["V"][i, g]) for i in range(quality.HIDDEN))) / (1 + math.exp(-sum(h[i] * float(p["U"][i, g]) for i in range(quality.HIDDEN)))) * float(p["w"][g]) for g in range(quality.GATE))
            encoded.append(h)
            weights.append(gate)
        top = max(weights)
        weights = [math.exp(w - top) for w in weights]
        bag = [sum(w * h[i] for w, h in zip(weights, encoded, strict=True)) / sum(weights) for i in range(quality.HIDDEN)]
        want = 1 / (1 + math.exp(-(sum(b * float(c) for b, c in zip(bag, p["c"], strict=True)) + float(p["d"][0]))))
        assert got[r.doc_id] == pytest.approx(want, abs=1e-4)


def test_gradients_are_differences():
    rng = np.random.default_rng(6)
    bags, y = np.array([0, 3, 4, 9]), np.array([1.0, 0.0, 1.0])
    x = rng.random((9, quality.FEATURES))
    p = {"mean": x.mean(0), "scale": x.std(0) + 0.02, "W": rng.normal(0, 0.1, (quality.FEATURES, quality.HIDDEN)), "b": np.zeros(quality.HIDDEN), "V": rng.normal(0, 0.3, (quality.HIDDEN, quality.GATE)), "U": rng.normal(0, 0.3, (quality.HIDDEN, quality.GATE)), "w": rng.normal(0, 0.5, quality.GATE), "c": rng.normal(0, 0.5, quality.HIDDEN), "d": np.zeros(1)}

    def loss():
        out = quality._forward(p, x, bags)["y"]
        return float(-(y * np.log(out) + (1 - y) * np.log(1 - out)).mean())

    found = quality._gradients(p, quality._forward(p, x, bags), bags, y)
    for name, g in found.items():
        for at in [tuple(rng.integers(0, n) for n in g.shape) for _ in range(5)]:
            was = p[name][at]
            p[name][at] = was + 1e-6
            high = loss()
            p[name][at] = was - 1e-6
            low = loss()
            p[name][at] = was
            assert g[at] == pytest.approx((high - low) / 2e-6, abs=1e-6), name
