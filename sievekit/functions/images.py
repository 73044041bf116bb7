"""Images: colour fractions and entropy over pixel tables, decoding-free perceptual hashes.

Pixel arrays come from Spark's image source (BGR bytes), so no imaging library is needed.
Transforms over one image are Arrow functions; per-pixel conditions over exploded pixels are
plain columns.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def color_fractions(df: DataFrame, by: str, h: Column, s: Column, v: Column) -> DataFrame:
    """(by, green_fraction, red_fraction, neutral_fraction) of pixels with 8-bit HSV."""
    colorful = (s >= 55) & (v >= 45)

    def share(test: Column) -> Column:
        return F.avg(test.cast("double"))

    return df.groupBy(by).agg(share(colorful & (h >= 35) & (h <= 115)).alias("green_fraction"), share(colorful & ((h <= 18) | (h >= 220))).alias("red_fraction"), share(s < 45).alias("neutral_fraction"))


def fitted(width: int, height: int, longest: int = 1280) -> tuple[int, int]:
    """Size after shrinking to ``longest``, rounded half to even, at least one pixel."""
    scale = min(1.0, longest / max(width, height, 1))
    return max(1, round(width * scale)), max(1, round(height * scale))


def enlarged(width: int, height: int, least: int) -> tuple[int, int]:
    """Size after enlarging the shorter side to ``least``, if it is below."""
    scale = max(1.0, least / max(min(width, height), 1))
    return max(1, round(width * scale)), max(1, round(height * scale))


def orientation(content: bytes) -> int:
    """The orientation (1 to 8) that a JPEG file's metadata names; 1 where there is none."""
    at = 2
    while content[:2] == b"\xff\xd8" and at + 4 <= len(content) and content[at] == 0xFF and content[at + 1] not in (0xDA, 0xD9):
        size = int.from_bytes(content[at + 2 : at + 4], "big")
        body = content[at + 4 : at + 2 + size]
        if content[at + 1] == 0xE1 and body[:6] == b"Exif\0\0" and body[6:8] in (b"II", b"MM"):
            tiff, order = body[6:], "little" if body[6:8] == b"II" else "big"
            start = int.from_bytes(tiff[4:8], order)
            for i in range(int.from_bytes(tiff[start : start + 2], order)):
                entry = tiff[start + 2 + 12 * i : start + 14 + 12 * i]
                if int.from_bytes(entry[:2], order) == 0x0112:
                    value = int.from_bytes(entry[8:10], order)
                    return value if 1 <= value <= 8 else 1
        at += 2 + max(size, 2)
    return 1


def turned(a: np.ndarray, orientation: int) -> np.ndarray:
    """The image as its orientation says it is to be seen."""
    if orientation >= 5:
        a = a.transpose(1, 0, 2)
    if orientation in (2, 3, 6, 7):
        a = a[:, ::-1]
    if orientation in (3, 4, 7, 8):
        a = a[::-1]
    return a


def prepared(a: np.ndarray, longest: int = 1280, least: int | None = None) -> np.ndarray:
    """Shrunk to ``longest`` and, if ``least`` is given, with its shorter side enlarged to it."""
    h, w = a.shape[:2]
    size = fitted(w, h, longest)
    if least is not None:
        size = enlarged(*size, least)
    return a if size == (w, h) else np.clip(np.rint(resized(a, *size)), 0, 255).astype(np.uint8)


def rgb(image) -> np.ndarray:
    """(height, width, 3) of an image row; gray is repeated, alpha goes."""
    a = np.frombuffer(image["data"], np.uint8).reshape(image["height"], image["width"], image["nChannels"])
    return np.repeat(a, 3, axis=2) if a.shape[2] == 1 else a[:, :, 2::-1]


def resized(a: np.ndarray, width: int, height: int) -> np.ndarray:
    """Area means when shrinking, nearest pixels when enlarging; rows, then columns."""

    def weights(old: int, new: int) -> np.ndarray:
        edges = np.linspace(0, old, new + 1)
        lo, hi = edges[:-1, None], np.maximum(edges[1:, None], edges[:-1, None] + 1e-9)
        cell = np.arange(old)[None, :]
        w = np.clip(np.minimum(hi, cell + 1) - np.maximum(lo, cell), 0, None)
        return w / w.sum(1, keepdims=True)

    return np.einsum("yh,hwc,xw->yxc", weights(a.shape[0], height), a.astype(np.float64), weights(a.shape[1], width), optimize=True)


def gray(a: np.ndarray) -> np.ndarray:
    return a @ np.array([0.299, 0.587, 0.114])


def entropy(a: np.ndarray) -> float:
    """Bits of the 256-bin gray histogram at 128 x 128."""
    counts = np.bincount(np.clip(np.rint(gray(resized(a, 128, 128))), 0, 255).astype(int).ravel(), minlength=256)
    p = counts[counts > 0] / counts.sum()
    return float(-(p * np.log2(p)).sum())


def _hex(bits: np.ndarray) -> str:
    return np.packbits(bits.ravel()).tobytes().hex()


def difference_hash(a: np.ndarray, size: int = 16) -> str:
    g = gray(resized(a, size + 1, size))
    return _hex(g[:, 1:] > g[:, :-1])


def frequency_hash(a: np.ndarray, size: int = 16) -> str:
    """Low frequencies of a 2-D cosine transform against their median."""
    n = 4 * size
    k = np.arange(n)
    basis = np.cos(math.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n))
    low = (basis @ gray(resized(a, n, n)) @ basis.T)[:size, :size]
    return _hex(low > np.median(low))


def wavelet_hash(a: np.ndarray, size: int = 16) -> str:
    """Haar averages against their median."""
    g = gray(resized(a, 4 * size, 4 * size)).reshape(size, 4, size, 4).mean((1, 3))
    return _hex(g > np.median(g))


MEASURES = T.StructType([T.StructField(n, T.IntegerType()) for n in ("width", "height")] + [T.StructField(n, T.DoubleType()) for n in ("entropy", "variance")] + [T.StructField(n, T.StringType()) for n in ("phash", "dhash", "whash", "mirror_phash")])


@F.pandas_udf(MEASURES)
def image_measures(images: pd.DataFrame) -> pd.DataFrame:
    """Size, entropy, largest channel variance at 64 x 64 and hashes of an image struct."""
    out = []
    for image in images.to_dict("records"):
        a = rgb(image)
        small = resized(a, 64, 64)
        out.append((image["width"], image["height"], entropy(a), float(small.reshape(-1, 3).var(0).max()), frequency_hash(a), difference_hash(a), wavelet_hash(a), frequency_hash(a[:, ::-1])))
    return pd.DataFrame(out, columns=MEASURES.names)
