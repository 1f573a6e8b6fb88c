"""Language identification by nearest centroid.

Texts become TF-IDF vectors of hashed character n-grams (1 to 3, lower case, everything but letters as one
space), normalised to length 1. Each language has several centroids (spherical k-means over its sample);
a text takes the language of the centroid with the highest cosine, and is marked rejected where that cosine
lies below the range which the centroid's own sample texts span.

The model is fitted on a bounded sample: about PER_LANGUAGE texts of each label, those of the least hashes of id and
text, repeated rows once. The LABELS most frequent labels are learned, so a column of free text as labels gives no model without
bounds; with fewer, every label is, however rare. Every text is scored, whole.

Rows: one for each input row, repeated rows included; other columns are left out. A null text, or one
without a letter, is `und` with score 0. A null id is never held out and never learned from. With nothing to
learn from every text is `und`.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.llm.common import as_text, chunks, column, pack, spread, tidy, unpack

#: Texts of each label in the sample that the model is fitted on.
PER_LANGUAGE = 400
#: Labels that are learned: those with most texts, of equal ones the first by name. A model holds 64 KB for each.
LABELS = 1024
DIMS, CENTROIDS, ROUNDS = 4096, 4, 12
#: Texts that are vectors at once.
ROWS = 1024


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """n-gram counts of each text, one row each."""
    n = len(offsets) - 1
    texts = [data[x:y].tobytes().decode().lower() for x, y in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]
    whole = "\x00".join(texts) + "\x00"
    points = np.frombuffer(whole.encode("ascii"), np.uint8).astype(np.uint32) if whole.isascii() else np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    own = np.repeat(np.arange(n), [len(t) + 1 for t in texts])
    letter = _letters()[points]
    points = np.where(letter, points, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space for a run of others
    points, own = points[keep], own[keep]
    out = np.zeros(n * DIMS, np.float32)
    gram = np.zeros(len(points), np.uint32)
    for k in range(3):
        if len(points) <= k:
            break
        gram = gram[: len(points) - k] * np.uint32(0x01000193) + points[k:] + np.uint32(k + 1)
        same = own[k:] == own[: len(points) - k]
        slot = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - DIMS.bit_length() + 1)
        out += np.bincount((own[: len(points) - k] * DIMS + slot)[same], minlength=n * DIMS).astype(np.float32)
    return out.reshape(n, DIMS)


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(found) * idf
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            yield from chunks(batch.slice(low, ROWS))


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in _blocks(batches):
        found = counts(data, offsets)
        packed = [pack(np.flatnonzero(x).astype(np.uint32), x[x > 0]) for x in found]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(packed, pa.binary())], ["lang", "packed"])


def _centroids(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart beginnings; each centroid with the least cosine of its texts."""
    picked = [x.mean(0)]
    for _ in range(min(CENTROIDS, len(x)) - 1):
        picked.append(x[np.argmin(np.max(x @ np.array(picked).T, 1))])
    c = np.array(picked)
    for _ in range(ROUNDS):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        near = np.argmax(x @ c.T, 1)
        c = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    close = x @ c.T
    near = np.argmax(close, 1)
    least = np.array([np.quantile(close[near == i, i], 0.01) if (near == i).any() else 1.0 for i in range(len(c))])
    return c, least


def fit(docs: DataFrame, learn: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model, from the rows where learn holds and the label is not null."""
    known = docs.where(learn & column(id_col).isNotNull() & column(lang_col).isNotNull() & as_text(text_col).rlike(r"\p{L}"))
    place = F.pmod(F.xxhash64(column(id_col).cast("string"), as_text(text_col)), F.lit(1 << 30))
    rows = known.select(column(lang_col).cast("string").alias("lang"), as_text(text_col).alias("text"), place.alias("place"))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LABELS)
    below = sizes.select("lang", (F.lit(PER_LANGUAGE * (1 << 30)) / F.col("count")).alias("below"))
    sample = rows.join(F.broadcast(below), "lang").where("place < below")  # at most LABELS rows are broadcast; texts stay where they are.groupBy("lang", "place").agg(F.min("text").alias("text")).select("lang", "text")
    by: dict[str, list[bytes]] = {}
    for r in sample.mapInArrow(tidy(_sample), "lang string, packed binary").toLocalIterator():
        by.setdefault(r.lang, []).append(bytes(r.packed))

    def dense(packed: list[bytes]) -> np.ndarray:
        out = np.zeros((len(packed), DIMS), np.float32)
        for i, p in enumerate(sorted(packed)):  # the order of arrival does not matter
            where, n = unpack(p)
            out[i, where] = n
        return out

    seen = sum((dense(p) > 0).sum(0) for p in by.values()) if by else np.zeros(DIMS)
    total = sum(map(len, by.values()))
    idf = (np.log((1 + total) / (1 + seen)) + 0.05).astype(np.float32)
    names, all_c, all_least = [], [], []
    for lang in sorted(by):
        c, least = _centroids(vectors(dense(by[lang]), idf))
        names += [lang] * len(c)
        all_c.append(c)
        all_least.append(least)
    return {"names": names, "idf": idf, "centroids": np.concatenate(all_c) if names else np.zeros((0, DIMS)), "least": np.concatenate(all_least) if names else np.zeros(0)}


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, c, idf, least = np.array([*model.value["names"], "und"], object), model.value["centroids"].astype(np.float32), model.value["idf"], model.value["least"]
        for rows, data, offsets in _blocks(batches):
            found = counts(data, offsets)
            some = found.any(1) & (len(c) > 0)
            best, score, far = np.full(len(found), len(names) - 1), np.zeros(len(found)), np.zeros(len(found), bool)
            if some.any():
                close = vectors(found[some], idf) @ c.T
                best[some] = np.argmax(close, 1)
                score[some] = np.clip(close.max(1), 0, 1)
                far[some] = score[some] < least[best[some]]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(names[best], pa.string()), pa.array(score), pa.array(far)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, model: dict, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score (the cosine) and rejected of every text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # CENTROIDS * DIMS numbers for each label
    rows = spread(docs).select(column(id_col).cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), as_text(text_col).alias("text"))
    return rows.mapInArrow(tidy(_predict(sent)), "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean")
