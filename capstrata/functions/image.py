"""Pixels in and out of Spark's image rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

# Mean and deviation of the channels (red, green, blue).
MEAN = (0.485, 0.456, 0.406)
STD = (0.229, 0.224, 0.225)


def _cubic(size: int, out: int) -> np.ndarray:
    """Weights of a bicubic resize (a = -0.5), support widened by the scale when reducing."""
    scale = max(size / out, 1.0)
    centre = (np.arange(out) + 0.5) * size / out - 0.5
    x = np.abs((np.arange(size)[None, :] - centre[:, None]) / scale)
    w = np.where(x < 1, 1.5 * x**3 - 2.5 * x**2 + 1, np.where(x < 2, -0.5 * x**3 + 2.5 * x**2 - 4 * x + 2, 0.0))
    return w / w.sum(1, keepdims=True)


def _resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    out = np.einsum("ih,hwc,jw->ijc", _cubic(pixels.shape[0], height), pixels, _cubic(pixels.shape[1], width), optimize=True)
    return np.clip(np.rint(out), 0, 255)


def tensor(bgr: np.ndarray, size: int = 224, seed: int | None = None) -> np.ndarray:
    """Channels x size x size, normalised: short side resized and centre cropped; with a seed randomly cropped, flipped
    and jittered instead."""
    rgb = (np.repeat(bgr, 3, axis=2) if bgr.shape[2] == 1 else bgr[:, :, 2::-1]).astype(float)
    h, w = rgb.shape[:2]
    if seed is None:
        scale = size / min(h, w)
        rgb = _resize(rgb, max(size, int(h * scale)), max(size, int(w * scale)))
        top, left = round((rgb.shape[0] - size) / 2), round((rgb.shape[1] - size) / 2)
        rgb = rgb[top : top + size, left : left + size]
    else:
        rng = np.random.default_rng(seed)
        side = max(1, int(min(h, w) * np.sqrt(rng.uniform(0.7, 1.0))))
        top, left = rng.integers(0, h - side + 1), rng.integers(0, w - side + 1)
        rgb = _resize(rgb[top : top + side, left : left + side], size, size)
        if rng.random() < 0.5:
            rgb = rgb[:, ::-1]
        rgb = np.clip(rgb * rng.uniform(0.9, 1.1), 0, 255)
        mean = rgb.mean()
        rgb = np.clip((rgb - mean) * rng.uniform(0.9, 1.1) + mean, 0, 255)
    return ((rgb / 255 - np.array(MEAN)) / np.array(STD)).transpose(2, 0, 1).astype(np.float32)


def image_tensor(image: Column, size: int = 224, seed: Column | None = None) -> Column:
    """array<float> of 3 x size x size; zeros where the picture could not be decoded."""

    @F.pandas_udf(ArrayType(FloatType()))
    def run(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series, seeds: pd.Series) -> pd.Series:
        out = []
        for h, w, c, d, s in zip(height, width, channels, data, seeds):
            bad = h is None or h <= 0 or not d
            out.append(np.zeros(3 * size * size, np.float32) if bad else tensor(np.frombuffer(d, np.uint8).reshape(h, w, c), size, None if pd.isna(s) else int(s)).ravel())
        return pd.Series(out)

    return run(image["height"], image["width"], image["nChannels"], image["data"], F.lit(None).cast("bigint") if seed is None else seed)
