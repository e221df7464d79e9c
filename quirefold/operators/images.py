"""Kernels on page images (uint8 arrays, row by row), in numpy: binarisation, column valleys, rules, masks.

``map_images`` runs a kernel over a (doc_id, page_num, h, w, data) DataFrame, a page per row. Defined results: empty and
blank images have one column, no rule and no formula region.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def otsu(image: np.ndarray) -> int:
    """The gray level that separates dark from light with the greatest variance between."""
    n = np.bincount(image.ravel(), minlength=256).astype(float)
    below, sums = np.cumsum(n), np.cumsum(n * np.arange(256))
    above = below[-1] - below
    with np.errstate(divide="ignore", invalid="ignore"):
        between = below * above * (sums / below - (sums[-1] - sums) / above) ** 2
    return int(np.nanargmax(np.where(np.isfinite(between), between, -1)))


def _smooth(values: np.ndarray, size: int) -> np.ndarray:
    size = max(1, size)
    return np.convolve(values, np.ones(size) / size, "same")


def column_profile(image: np.ndarray) -> np.ndarray:
    """Share of dark pixels per x, against the darkest column, smoothed over 4 % of the width."""
    if not image.size or image.min() == image.max():
        return np.zeros(image.shape[1] if image.ndim == 2 else 0)
    dark = (image <= otsu(image)).sum(axis=0).astype(float)
    flat = _smooth(dark / max(dark.max(), 1e-9), int(image.shape[1] * 0.04))
    return flat / max(flat.max(), 1e-9)


def is_multi_column(image: np.ndarray) -> bool:
    """Whether the middle holds a valley below half of the sides."""
    flat = column_profile(image)
    w = len(flat)
    low, high = int(w * 0.35), int(w * 0.65)
    if high - low < 1:
        return False
    side = np.concatenate((flat[:low], flat[high:])).mean()
    return bool(side > 0.01 and flat[low:high].min() < 0.5 * side)


def split_column(image: np.ndarray) -> int | None:
    """The x at which a page splits into two columns, by the band from 18 to 92 % of its height; None for one column."""
    h, w = image.shape
    band = image[int(h * 0.18) : int(h * 0.92)]
    low, high = int(w * 0.35), int(w * 0.65)
    if not band.size or high - low < 1 or band.min() == band.max():
        return None
    dark = (band <= otsu(band)).sum(axis=0) / max(1, band.shape[0])
    side = np.concatenate((dark[:low], dark[high:])).mean()
    middle = _smooth(dark[low:high], int(w * 0.03))
    return None if side < 0.01 or middle.min() >= 0.35 * side else low + int(middle.argmin())


def horizontal_rules(image: np.ndarray, least_share: float = 0.02) -> int:
    """Dark runs at least ten times as long as high (three pixels at most) and ``least_share`` of the width long."""
    h, w = image.shape
    if not image.size or image.min() == image.max():
        return 0
    dark = image <= otsu(image)
    least = max(11, int(w * least_share) + 1)
    runs: list[tuple[int, int, int]] = []
    for y in range(h):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], dark[y].astype(np.int8), [0]))))
        runs += [(y, a, b) for a, b in zip(edge[::2], edge[1::2]) if b - a >= least]
    count, open_ = 0, []
    for y, a, b in runs + [(h + 1, 0, 0)]:
        for o in [o for o in open_ if o[1] < y - 1]:
            count += o[1] - o[0] + 1 <= 3 and (o[3] - o[2]) > 10 * (o[1] - o[0] + 1)
            open_.remove(o)
        same = next((o for o in open_ if o[1] == y - 1 and o[2] < b and a < o[3]), None)
        if same:
            same[1], same[2], same[3] = y, min(a, same[2]), max(b, same[3])
        elif b > a:
            open_.append([y, y, a, b])
    return int(count)


def formula_mask(image: np.ndarray) -> np.ndarray:
    """Pixels near long horizontal strokes (fraction bars, rules), padded by 4 % of the height and 10 pixels."""
    h, w = image.shape
    mask = np.zeros((h, w), bool)
    if not image.size or image.min() == image.max():
        return mask
    dark, least, pad = image <= otsu(image), max(20, int(w * 0.04)), max(30, int(h * 0.04))
    for y in range(h):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], dark[y].astype(np.int8), [0]))))
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a >= least:
                mask[max(0, y - pad) : y + pad + 1, max(0, a - 10) : b + 10] = True
    return mask


def mask_or(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logical_or(a, b)


def crop(image: np.ndarray, x0: float, y0: float, x1: float, y1: float, scale: float = 1.0) -> np.ndarray:
    h, w = image.shape
    a, b, c, e = (int(round(v * scale)) for v in (x0, y0, x1, y1))
    return image[max(0, b) : min(h, e), max(0, a) : min(w, c)]


def render(boxes: pd.DataFrame, width: int, height: int, scale: float) -> np.ndarray:
    """A white page with word boxes as dark bars."""
    image = np.full((int(height * scale), int(width * scale)), 255, np.uint8)
    for r in boxes.itertuples():
        image[int(r.top * scale) : max(int(r.bottom * scale), int(r.top * scale) + 1), int(r.x0 * scale) : int(r.x1 * scale)] = 20
    return image


def map_images(images: DataFrame, kernel: Callable[[np.ndarray], float | None], name: str) -> DataFrame:
    """(doc_id, page_num, name) of ``kernel`` over each image."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            values = [kernel(np.frombuffer(bytes(x), np.uint8).reshape(h, w)) for x, h, w in zip(b.data, b.h, b.w)]
            yield pd.DataFrame({"doc_id": b.doc_id, "page_num": b.page_num, name: pd.array([None if v is None else float(v) for v in values], "Float64")})

    return images.mapInPandas(run, f"doc_id long, page_num int, {name} double")
