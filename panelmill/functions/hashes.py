"""Perceptual hashes of gray images, 64 bits each: by mean (a), by cosine transform (p), by differences (d), by Haar wavelets (w).

Images are rows of pixels (0 to 255) with a width and height, as a decoder of the caller gives them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

HASHES = "hashes struct<a:bigint,p:bigint,d:bigint,w:bigint>"


def shrunk(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """The means of height x width fields; pixels on a border count by their share."""

    def weights(n: int, m: int) -> np.ndarray:
        edges = np.linspace(0, n, m + 1)
        cell = np.arange(n)
        return np.clip(np.minimum(edges[1:, None], cell + 1) - np.maximum(edges[:-1, None], cell), 0, 1) * m / n

    return weights(image.shape[0], height) @ image @ weights(image.shape[1], width).T


def _bits(flags: np.ndarray) -> int:
    return int(np.packbits(flags.ravel()).view(">i8")[0])


def hashes(image: np.ndarray) -> dict[str, int]:
    image = image.astype(np.float64)
    small, wide, large = shrunk(image, 8, 8), shrunk(image, 8, 9), shrunk(image, 32, 32)
    k = np.arange(32)
    cosine = np.cos(np.pi * k[:, None] * (2 * k + 1) / 64)
    low = (cosine @ large @ cosine.T)[:8, :8]
    wave = large
    while len(wave) > 8:  # the means of a Haar transform, without the overall mean
        wave = (wave[::2, ::2] + wave[1::2, ::2] + wave[::2, 1::2] + wave[1::2, 1::2]) / 4
    over = lambda x, y: _bits(np.round(x - y, 6) > 0)
    return {"a": over(small, small.mean()), "p": over(low, np.median(low)), "d": over(wide[:, 1:], wide[:, :-1]), "w": over(wave, np.median(wave))}


def hashed_images(images: DataFrame, key: str) -> DataFrame:
    """key and hashes of images (key, pixels, width, height); null where the pixels do not fill the image."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for pixels, w, h in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p = np.array(pixels.as_py() or [], np.float64)
                out.append(hashes(p.reshape(h, w)) if w and h and len(p) == w * h else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.struct([(n, pa.int64()) for n in "apdw"]))], [key, "hashes"])

    kind = dict(images.dtypes)[key]
    return images.select(key, "pixels", "width", "height").mapInArrow(run, f"{key} {kind}, {HASHES}")
