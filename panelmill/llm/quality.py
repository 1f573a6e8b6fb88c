"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages (PASSAGE code points each, the whole text). Each passage becomes a vector of
character and repetition statistics and of hashed character pairs and words, which a learned layer encodes. Only the document has a label: gated attention (tanh times sigmoid)
learns which passages matter, and the score is that of the attention-weighted passage representation.

The model is fitted on the driver from a bounded sample: SAMPLE labelled documents picked by a hash of the
id, with at most SAMPLE_PASSAGES passages in all, taken in the order of a hash; a repeated id counts once, with its least label and least
text. Every document is scored, whole.

Rows: one for each input row, repeated rows included; other columns are left out. A null or empty text is
one passage without characters. A null id is never held out and never learned from. Without labels every
score is 0.5.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import Rolling, as_text, chunks, column, pack, spread, tidy, unpack, written

PASSAGE = 400
#: Bounds of the sample that the model is fitted on.
SAMPLE, SAMPLE_PASSAGES = 3000, 60_000
HIDDEN, GATE, EPOCHS, BAGS, RATE = 24, 12, 40, 128, 0.01
#: Bytes of text whose passages are found at once.
BYTES = 1 << 20
#: Code points of the repeated pieces that are looked for, at words' beginnings.
GRAM = 24

_GROUPS = ["lower", "upper", "digit", "space", "newline", "stop", "loud", "symbol", "quote", "other", "accented"]


def _kinds() -> np.ndarray:
    kind = np.full(0x250, _GROUPS.index("accented"), np.uint8)
    for c in range(128):
        x = chr(c)
        name = "lower" if x.islower() else "upper" if x.isupper() else "digit" if x.isdigit() else "newline" if x == "\n" else "space" if x.isspace() else "stop" if x in ".,;:" else "loud" if x in "!?" else "symbol" if x in "#*$%&|<>" else "quote" if x in "'\"()-" else "other"
        kind[c] = _GROUPS.index(name)
    return kind


KINDS, ROLLING = _kinds(), Rolling(0x110000, 4)
#: Slots of hashed pairs of characters and of hashed words.
BIGRAMS, WORDS = 24, 96
FEATURES = len(_GROUPS) + 5 + BIGRAMS + WORDS


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each passage, and where each text's passages begin and end."""
    text = data.tobytes().decode()
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    begins = chars[offsets]
    sizes = np.diff(begins)
    n_bags = np.maximum(1, -(-sizes // PASSAGE))
    bags = np.concatenate([[0], np.cumsum(n_bags)])
    n = int(bags[-1])
    own = np.repeat(np.arange(len(sizes)), sizes)
    where = bags[own] + (np.arange(len(points)) - begins[own]) // PASSAGE
    kind = KINDS[np.minimum(points, 0x24F)]
    size = np.maximum(np.bincount(where, minlength=n), 1).astype(np.float32)
    out = np.zeros((n, FEATURES), np.float32)
    k = len(_GROUPS)
    out[:, :k] = np.bincount(where * k + kind, minlength=n * k).reshape(n, k) / size[:, None]
    blank = (kind == _GROUPS.index("space")) | (kind == _GROUPS.index("newline"))
    head = np.zeros(len(points), bool)
    if len(points):
        head[1:] = ~blank[1:] & (blank[:-1] | (own[1:] != own[:-1]))
        head[0] = not blank[0]
    words = np.maximum(np.bincount(where[head], minlength=n), 1)
    out[:, k] = np.minimum(np.bincount(where[~blank], minlength=n) / words, 30) / 10
    ending = begins[own + 1] if len(points) else begins[:0]
    starts = np.flatnonzero(head)
    sums = ROLLING.sums(points)
    for j, reach in ((1, GRAM), (2, 3 * GRAM)):
        at = starts[starts + reach <= ending[starts]]
        if len(at):
            hashes = ROLLING.slices(sums, at, at + reach) ^ (own[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            again = pd.Series(hashes).duplicated(keep=False).to_numpy()
            out[:, k + j] = np.bincount(where[at[again]], minlength=n) / np.maximum(np.bincount(where[at], minlength=n), 1)
    out[:, k + 3] = np.minimum(np.bincount(where, minlength=n) / PASSAGE, 1)
    out[:, k + 4] = np.minimum(words / np.maximum(size, 1) * 4, 2)
    pair = (np.minimum(points[:-1], 0x24F) * 31 + np.minimum(points[1:], 0x24F)) % BIGRAMS
    within = own[1:] == own[:-1]  # a score does not depend on the texts beside
    k += 5
    out[:, k : k + BIGRAMS] = np.sqrt(np.bincount((where[:-1] * BIGRAMS + pair)[within], minlength=n * BIGRAMS).reshape(n, BIGRAMS) / size[:, None])
    if len(starts):
        last = np.ones(len(points), bool)
        last[:-1] = blank[1:] | ~within
        stops = np.flatnonzero(last & ~blank) + 1
        word, at = ROLLING.slices(sums, starts, stops), where[starts]
        k += BIGRAMS
        slot = (word >> np.uint64(40)) % np.uint64(WORDS)
        out[:, k : k + WORDS] = np.sqrt(np.bincount(at * WORDS + slot.astype(np.int64), minlength=n * WORDS).reshape(n, WORDS) / words[:, None])
    return out, bags


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in chunks(batch, limit=BYTES):
            x, bags = passages(data, offsets)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array([pack(x[a:b].ravel()) for a, b in zip(bags, bags[1:], strict=False)], pa.binary())], ["doc_id", "quality", "packed"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(p: dict, x: np.ndarray, bags: np.ndarray) -> dict:
    low, sizes = bags[:-1], np.diff(bags)
    size = x[:, len(_GROUPS) + 3 : len(_GROUPS) + 4] * PASSAGE
    x = (x - p["mean"]) / p["scale"] * (size / (size + 20))  # shares of a few characters say little
    x[:, len(_GROUPS) + 3] = 0
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * g) @ p["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, low), sizes))
    a = e / np.repeat(np.add.reduceat(e, low), sizes)
    z = np.add.reduceat(h * a[:, None], low)
    return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"])}


def _gradients(p: dict, f: dict, bags: np.ndarray, target: np.ndarray) -> dict:
    sizes = np.diff(bags)
    dy = (f["y"] - target) / len(target)
    dz = np.repeat(dy[:, None] * p["c"], sizes, 0)
    da = (dz * f["h"]).sum(1)
    de = f["a"] * (da - np.repeat(np.add.reduceat(da * f["a"], bags[:-1]), sizes))
    dt, dg = de[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2), de[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
    dh = (dz * f["a"][:, None] + dt @ p["V"].T + dg @ p["U"].T) * (1 - f["h"] ** 2)
    return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ dy, "d": dy.sum(keepdims=True)}


def train(x: list[np.ndarray], y: np.ndarray) -> dict:
    """The parameters from bags of passages and their labels, by Adam; the same for the same bags."""
    rng = np.random.default_rng(5)
    flat = np.concatenate(x)
    draw = lambda *s: rng.normal(0, s[0] ** -0.5, s).astype(np.float32)
    p = {"mean": flat.mean(0), "scale": flat.std(0) + 0.02, "W": draw(FEATURES, HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": draw(HIDDEN, GATE), "U": draw(HIDDEN, GATE), "w": draw(GATE, 1)[:, 0], "c": draw(HIDDEN, 1)[:, 0], "d": np.zeros(1, np.float32)}
    m, v, step = {}, {}, 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(x))
        for low in range(0, len(order), BAGS):
            own = order[low : low + BAGS]
            bags = np.concatenate([[0], np.cumsum([len(x[i]) for i in own])])
            f = _forward(p, np.concatenate([x[i] for i in own]), bags)
            step += 1
            for k, g in _gradients(p, f, bags, y[own]).items():
                g = g + 1e-4 * p[k]
                m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                v[k] = 0.999 * v.get(k, 0) + 0.001 * g * g
                p[k] = (p[k] - RATE * (1 - epoch / EPOCHS) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return {k: np.asarray(a, np.float32) for k, a in p.items()}


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> dict | None:
    """The parameters, from the labels (doc_id, quality) where learn holds; learn speaks of doc_id."""
    known = labels.where(learn & F.col("quality").isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    known = known.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.select(column(id_col).cast("bigint").alias("doc_id"), as_text(text_col).alias("text")).join(F.broadcast(known), "doc_id")  # at most SAMPLE rows are broadcast
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # repeated rows count once
    rows = written(rows, "quality-sample")
    # which documents fit into SAMPLE_PASSAGES is settled from their sizes, before any passage leaves the executors
    passages_of = F.greatest(F.lit(1), F.ceil(F.char_length(F.coalesce("text", F.lit(""))) / PASSAGE)).alias("n")
    taken, total = [], 0
    for r in sorted(rows.select("doc_id", passages_of).collect(), key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id)):  # SAMPLE rows of two numbers
        if total + r.n <= SAMPLE_PASSAGES:
            taken.append(r.doc_id)
            total += r.n
    own = {r.doc_id: (unpack(bytes(r.packed))[0].reshape(-1, FEATURES), r.quality) for r in rows.where(F.col("doc_id").isin(taken)).mapInArrow(tidy(_sample), "doc_id bigint, quality double, packed binary").toLocalIterator()}
    found = [own[i] for i in taken]
    return train([x for x, _ in found], np.array([min(max(q, 0.0), 1.0) for _, q in found])) if found else None


def _score(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.value
        for batch in batches:
            for rows, data, offsets in chunks(batch, limit=BYTES):
                x, bags = passages(data, offsets)
                score = _forward(p, x, bags)["y"].astype(np.float64) if p else np.full(len(bags) - 1, 0.5)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def score(docs: DataFrame, model: dict | None, held_out: Column, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted (1 from the threshold on) of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = spread(docs).select(column(id_col).cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), as_text(text_col).alias("text"))
    return rows.mapInArrow(tidy(_score(sent, threshold)), "doc_id bigint, held_out boolean, score double, predicted int")


def _keep(model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = model.value
        for batch in batches:
            if p is None:
                yield batch.select(["row"])
                continue
            for rows, data, offsets in chunks(batch, limit=BYTES):
                x, bags = passages(data, offsets)
                yield rows.select(["row"]).filter(pa.array(_forward(p, x, bags)["y"].astype(np.float64) >= threshold))

    return run


def accepted(docs: DataFrame, model: dict | None, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows that the model does not reject, with all their columns; all rows if there is no model."""
    docs = docs.withColumn(text_col, as_text(text_col))
    rows = docs.select(F.struct(*[column(n) for n in docs.columns]).alias("row"), as_text(text_col).alias("text"))
    kept = rows.mapInArrow(tidy(_keep(docs.sparkSession.sparkContext.broadcast(model), threshold)), rows.select("row").schema)
    return kept.select("row.*")
