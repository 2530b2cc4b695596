"""Row-wise raster augmentation in numpy, planned relationally: which transforms an image gets is a query.

Random numbers come from a generator seeded by record, transform and seed, so results do not depend on
partitioning. A raster is a row (id, h, w, data): values 0-255 in row order, one a pixel (grey) or three (RGB).
A transform is a function of a float array (h, w, channels), a generator and its parameters; values between
pixels are interpolated linearly, places beyond an edge are mirrored.

Defined results: null or empty data, and data that don't fit h and w, come back as they are with an error;
a transform that fails leaves the image as it was and is named in ``error``; a null plan changes nothing.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusforge.functions import text as T

# Weights of red, green and blue in the brightness of a pixel.
LUMA = np.array([0.299, 0.587, 0.114])


def grey(a: np.ndarray) -> np.ndarray:
    return a[..., 0] if a.shape[2] == 1 else a @ LUMA


def mirrored(i: np.ndarray, n: int) -> np.ndarray:
    """Places ``i`` reflected at both ends of 0..n-1, the end itself not repeated."""
    if n == 1:
        return np.zeros_like(i)
    i = np.abs(i) % (2 * n - 2)
    return np.where(i < n, i, 2 * n - 2 - i)


def at(a: np.ndarray, y: np.ndarray, x: np.ndarray, outside: float | None = None) -> np.ndarray:
    """Values of ``a`` at the places (y, x); beyond the edges ``outside``, or mirrored."""
    h, w = a.shape[:2]
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    out = 0.0
    for dy in (0, 1):
        for dx in (0, 1):
            share = np.abs(1 - dy - (y - y0)) * np.abs(1 - dx - (x - x0))
            v = a[mirrored(y0 + dy, h), mirrored(x0 + dx, w)]
            if outside is not None:
                v = np.where(((y0 + dy >= 0) & (y0 + dy < h) & (x0 + dx >= 0) & (x0 + dx < w))[..., None], v, outside)
            out = out + share[..., None] * v
    return out


def weighted(a: np.ndarray, kernel: np.ndarray) -> np.ndarray:
    """Each pixel as the sum of its neighbours by ``kernel``."""
    h, w = a.shape[:2]
    kh, kw = kernel.shape
    ys, xs = mirrored(np.arange(h + kh - 1) - kh // 2, h), mirrored(np.arange(w + kw - 1) - kw // 2, w)
    p = a[np.ix_(ys, xs)]
    return sum(kernel[i, j] * p[i : i + h, j : j + w] for i in range(kh) for j in range(kw) if kernel[i, j])


def gaussian(a: np.ndarray, sigma: float, size: int | None = None) -> np.ndarray:
    size = size or 2 * math.ceil(3 * sigma) + 1
    k = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma * sigma))
    return weighted(weighted(a, (k / k.sum())[:, None]), (k / k.sum())[None, :])


def resized(a: np.ndarray, h: int, w: int) -> np.ndarray:
    """``a`` in another size, pixel centres aligned, edges held."""
    y = np.clip((np.arange(h) + 0.5) * a.shape[0] / h - 0.5, 0, a.shape[0] - 1)
    x = np.clip((np.arange(w) + 0.5) * a.shape[1] / w - 0.5, 0, a.shape[1] - 1)
    return at(a, *np.meshgrid(y, x, indexing="ij"))


def gaussian_noise(a, rng, mean=0.0, std=25.0):
    return np.floor(np.clip(a + rng.normal(mean, std, a.shape), 0, 255))


def gaussian_blur(a, rng, radius_range=(1.0, 3.0)):
    return gaussian(a, rng.uniform(*radius_range))


# Quantisation tables of brightness and colour of the baseline JPEG standard, in row order.
_Q_LUMA = """16 11 10 16 24 40 51 61 12 12 14 19 26 58 60 55 14 13 16 24 40 57 69 56 14 17 22 29 51 87 80 62
18 22 37 56 68 109 103 77 24 35 55 64 81 104 113 92 49 64 78 87 103 121 120 101 72 92 95 98 112 100 103 99"""
_Q_COLOUR = """17 18 24 47 99 99 99 99 18 21 26 66 99 99 99 99 24 26 56 99 99 99 99 99 47 66 99 99 99 99 99 99
99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99 99"""
_DCT = np.array([[math.sqrt((1 if k == 0 else 2) / 8) * math.cos((2 * n + 1) * k * math.pi / 16) for n in range(8)] for k in range(8)])


def _quantised(plane: np.ndarray, table: str, quality: int) -> np.ndarray:
    """A plane after the cosine transform of its 8 x 8 blocks was rounded to the steps of ``table``: all that JPEG loses."""
    scale = 5000 / quality if quality < 50 else 200 - 2 * quality
    q = np.clip(np.floor((np.array(table.split(), float).reshape(8, 8) * scale + 50) / 100), 1, 255)
    h, w = plane.shape
    p = np.pad(plane, ((0, -h % 8), (0, -w % 8)), mode="edge") - 128
    b = p.reshape(p.shape[0] // 8, 8, p.shape[1] // 8, 8).transpose(0, 2, 1, 3)
    b = _DCT.T @ (np.round(_DCT @ b @ _DCT.T / q) * q) @ _DCT
    return b.transpose(0, 2, 1, 3).reshape(p.shape)[:h, :w] + 128


def jpeg_compression(a, rng, quality_range=(40, 85)):
    quality = int(rng.integers(quality_range[0], quality_range[1] + 1))
    if a.shape[2] == 1:
        return _quantised(a[..., 0], _Q_LUMA, quality)[..., None]
    y = grey(a)
    h, w = y.shape
    planes = [_quantised(y, _Q_LUMA, quality)]
    for c, f in ((2, 0.564), (0, 0.713)):  # blue and red against brightness, at half the size
        d = (a[..., c] - y) * f + 128
        half = np.pad(d, ((0, h % 2), (0, w % 2)), mode="edge").reshape((h + 1) // 2, 2, (w + 1) // 2, 2).mean(axis=(1, 3))
        planes.append(_quantised(half, _Q_COLOUR, quality).repeat(2, 0).repeat(2, 1)[:h, :w] - 128)
    y, cb, cr = planes
    return np.stack([y + 1.403 * cr, y - 0.344 * cb - 0.714 * cr, y + 1.773 * cb], axis=2)


def color_jitter(a, rng, brightness=0.3, contrast=0.3, saturation=0.2, hue=0.0):
    f = [rng.uniform(1 - s, 1 + s) for s in (brightness, contrast, saturation)]
    a = np.clip(a * f[0], 0, 255)
    mean = np.round(grey(a).mean())
    a = np.clip(mean + (a - mean) * f[1], 0, 255)
    if a.shape[2] == 1:
        return a
    y = grey(a)[..., None]
    a = np.clip(y + (a - y) * f[2], 0, 255)
    if hue > 0:  # a turn about the grey axis
        t = rng.uniform(-hue, hue) * 2 * np.pi
        k, c, s = 1 / 3, np.cos(t), np.sin(t) / math.sqrt(3)
        turn = np.array([[k + (1 - k) * c, k - k * c - s, k - k * c + s], [k - k * c + s, k + (1 - k) * c, k - k * c - s], [k - k * c - s, k - k * c + s, k + (1 - k) * c]])
        a = a @ turn.T
    return a


def curve(a, rng, period=180, amplitude=(1, 5)):
    """Columns moved up and down along a sine wave."""
    y, x = np.mgrid[: a.shape[0], : a.shape[1]].astype(float)
    return at(a, y + rng.uniform(*amplitude) * np.sin(2 * np.pi * x / period), x)


def dropout_horizontal(a, rng, num_line=3, thickness=3):
    """Dark bands of rows; an image not higher than a band stays."""
    h, w = a.shape[:2]
    if h <= thickness + 1:
        return a
    a = a.copy()
    for _ in range(num_line):
        row = int(rng.integers(1, h - thickness))
        a[row : row + thickness] = rng.integers(0, 21, (thickness, w, 1))
    return a


def dropout_vertical(a, rng, num_line=8, thickness=3):
    return dropout_horizontal(a.swapaxes(0, 1), rng, num_line, thickness).swapaxes(0, 1)


def dropout_rand(a, rng, dropout_p=(0.2, 0.4)):
    """Pixels darkened to a random fraction in each channel."""
    h, w, c = a.shape
    n = int(rng.integers(int(h * w * dropout_p[0]), int(h * w * dropout_p[1]) + 1))
    y, x = rng.integers(0, h, n), rng.integers(0, w, n)
    out = a.copy()
    out[y, x] = np.floor(a[y, x] * rng.random((n, c)))
    return out


def line_overlay(a, rng, thickness=(1, 3)):
    """One line along an edge or through the middle, across or down."""
    t = int(rng.integers(thickness[0], thickness[1] + 1))
    colour = rng.integers(0, 170, 3)[: a.shape[2]]
    across, place = bool(rng.integers(2)), int(rng.integers(3))
    out = a.copy()
    v = out if across else out.swapaxes(0, 1)
    n = v.shape[0]
    start = (t, n - t, n // 2)[place] - t // 2
    v[max(0, start) : max(0, min(n, start + t))] = colour
    return out


def image_padding(a, rng, w_ratio=(0.0, 0.05), h_ratio=(0.0, 0.3), center=False):
    """A white canvas somewhat larger, the image at a random place or in the middle of it."""
    h, w, c = a.shape
    new_w, new_h = int(w + w * rng.uniform(*w_ratio)), int(h + h * rng.uniform(*h_ratio))
    x, y = ((new_w - w) // 2, (new_h - h) // 2) if center else (int(rng.integers(0, new_w - w + 1)), int(rng.integers(0, new_h - h + 1)))
    out = np.full((new_h, new_w, c), 255.0)
    out[y : y + h, x : x + w] = a
    return out


def _grown(mask: np.ndarray, diagonal: bool = False) -> np.ndarray:
    """``mask`` and its neighbours, nothing wrapping over an edge."""
    p = np.pad(mask, 1)
    out = p[1:-1, 1:-1] | p[:-2, 1:-1] | p[2:, 1:-1] | p[1:-1, :-2] | p[1:-1, 2:]
    return out | p[:-2, :-2] | p[:-2, 2:] | p[2:, :-2] | p[2:, 2:] if diagonal else out


def text_border(a, rng, border_width=(1, 3)):
    """Dark text grown by a black border."""
    dark = ring = grey(a) < 128
    for _ in range(int(rng.integers(border_width[0], border_width[1] + 1))):
        ring = _grown(ring)
    return np.where((ring & ~dark)[..., None], 0.0, a)


def motion_blur(a, rng, blur_limit=3):
    """Mean along a line of random direction and odd length."""
    size = int(rng.choice(np.arange(3, max(3, 2 * blur_limit + 1) + 1, 2)))
    c, angle = size // 2, rng.uniform(0, np.pi)
    k = np.zeros((size, size))
    for t in np.linspace(-1, 1, 2 * size + 1):
        k[c + round(t * round(c * math.sin(angle))), c + round(t * round(c * math.cos(angle)))] = 1
    return weighted(a, k / k.sum())


def grid_distortion(a, rng, num_steps=4, distort_limit=0.15):
    """Each cell of a grid of random lines shows what lies some way off."""
    h, w = a.shape[:2]
    xs, ys = ([0, *(int(n * v) for v in np.sort(rng.random(num_steps - 1))), n] for n in (w, h))
    y, x = np.mgrid[:h, :w].astype(float)
    for i in range(num_steps):
        for j in range(num_steps):
            cell = slice(ys[i], ys[i + 1]), slice(xs[j], xs[j + 1])
            x[cell] += rng.uniform(-distort_limit, distort_limit) * w
            y[cell] += rng.uniform(-distort_limit, distort_limit) * h
    return at(a, np.clip(y, 0, h - 1), np.clip(x, 0, w - 1))


def optical_distortion(a, rng, distort_limit=0.03):
    """Barrel or pincushion distortion of two terms; what comes from outside is black."""
    h, w = a.shape[:2]
    k1, k2 = rng.uniform(-distort_limit, distort_limit), rng.uniform(-distort_limit / 2, distort_limit / 2)
    y, x = np.mgrid[:h, :w].astype(float)
    u, v = x / (w / 2) - 1, y / (h / 2) - 1
    r = u * u + v * v
    f = 1 + k1 * r + k2 * r * r
    return at(a, (v * f + 1) * h / 2, (u * f + 1) * w / 2, 0.0)


def iso_noise(a, rng, intensity=(0.05, 0.2)):
    return np.floor(np.clip(a * rng.normal(1.0, rng.uniform(*intensity), a.shape), 0, 255))


def random_boxes(h: int, w: int, region_ratio: float, num_regions: int, rng) -> list[tuple[int, int, int, int]]:
    """(x1, y1, x2, y2) of regions of that share of each side, anywhere; they may overlap."""
    bw, bh = max(1, int(w * region_ratio)), max(1, int(h * region_ratio))
    out = []
    for _ in range(num_regions):
        x, y = int(rng.integers(0, max(0, w - bw) + 1)), int(rng.integers(0, max(0, h - bh) + 1))
        out.append((x, y, x + bw, y + bh))
    return out


def otsu(g: np.ndarray) -> int:
    """Threshold that parts the grey values into two classes of the greatest variance between them."""
    n = np.bincount(np.clip(g, 0, 255).astype(int).ravel(), minlength=256).astype(float)
    below, mass = n.cumsum(), (n * np.arange(256)).cumsum()
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (mass[-1] * below / below[-1] - mass) ** 2 / (below * (below[-1] - below))
    return int(np.nan_to_num(between, posinf=0).argmax())


def regions_of(mask: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(area, x1, y1, x2, y2) of the connected regions of ``mask``, largest first."""
    h, w = mask.shape
    label = np.where(mask, np.arange(1, h * w + 1).reshape(h, w), 0)
    while True:
        p = np.pad(label, 1)
        new = np.where(mask, np.max([p[1 + y : h + 1 + y, 1 + x : w + 1 + x] for y in (-1, 0, 1) for x in (-1, 0, 1)], axis=0), 0)
        if (new == label).all():
            break
        label = new
    out = []
    for k, area in zip(*np.unique(label[mask], return_counts=True)):
        y, x = np.nonzero(label == k)
        out.append((int(area), int(x.min()), int(y.min()), int(x.max()) + 1, int(y.max()) + 1))
    return sorted(out, key=lambda r: (-r[0], r[1:]))


def contour_boxes(a: np.ndarray, region_ratio: float, num_regions: int, rng, least_area: float = 0.001) -> list[tuple[int, int, int, int]]:
    """Boxes of the largest dark regions with a margin; random ones where no region is large enough."""
    h, w = a.shape[:2]
    g = grey(a)
    dark = ~_grown(~_grown(g <= otsu(g), True), True)  # grown and shrunk again, so that broken strokes join
    found = [r for r in regions_of(dark) if r[0] >= max(1, int(h * w * least_area))]
    if not found:
        return random_boxes(h, w, region_ratio, num_regions, rng)
    mx, my = max(1, int(w * region_ratio * 0.5)), max(1, int(h * region_ratio * 0.5))
    return [(max(0, x1 - mx), max(0, y1 - my), min(w, x2 + mx), min(h, y2 + my)) for _, x1, y1, x2, y2 in found[:num_regions]]


def _some(b, other, share, rng):
    return np.where((rng.random(b.shape[:2]) < share)[..., None], other, b)


def _salt_pepper(b, rng, ratio):
    b = b.copy()
    n = math.ceil(ratio * b.shape[0] * b.shape[1] * 0.5)
    for value in (255, 0):
        b[rng.integers(0, b.shape[0], n), rng.integers(0, b.shape[1], n)] = value
    return b


def _kernel_blur(b, radius):
    size = 2 * max(1, radius) + 1
    return gaussian(b, 0.3 * ((size - 1) * 0.5 - 1) + 0.8, size)


def _mosaic(b, size):
    """Cells of one value: the region made smaller, then larger again without interpolation."""
    h, w = b.shape[:2]
    size = max(1, min(size, h, w))
    small = resized(b, h // size, w // size)
    return small[np.ix_(np.arange(h) * (h // size) // h, np.arange(w) * (w // size) // w)]


MASKS = {
    "random_block": lambda b, rng, ratio, **kw: rng.integers(0, 256, b.shape).astype(float),
    "random_pixel": lambda b, rng, ratio, **kw: _some(b, rng.integers(0, 256, b.shape), ratio, rng),
    "gaussian_noise": lambda b, rng, ratio, std=25.0, **kw: _some(b, np.clip(b + np.trunc(rng.normal(0, std, b.shape)), 0, 255), ratio, rng),
    "salt_pepper": lambda b, rng, ratio, **kw: _salt_pepper(b, rng, ratio),
    "blur": lambda b, rng, ratio, radius=None, **kw: _kernel_blur(b, radius if radius is not None else max(1, int(min(b.shape[:2]) * ratio))),
    "mosaic": lambda b, rng, ratio, size=None, **kw: _mosaic(b, size if size is not None else max(2, int(min(b.shape[:2]) * ratio))),
}


def masked(a: np.ndarray, rng, kind: str, mask_ratio=0.15, coords=None, coord_mode="random", region_ratio=None, num_regions=1, **kw) -> np.ndarray:
    """``a`` with regions changed by a mask; boxes are cut to the image, empty ones are left out."""
    if kind not in MASKS:
        raise ValueError(f"no mask {kind}")
    h, w = a.shape[:2]
    ratio = mask_ratio if region_ratio is None else region_ratio
    if coords is None:
        coords = contour_boxes(a, ratio, num_regions, rng) if coord_mode == "contour" else random_boxes(h, w, ratio, num_regions, rng)
    out = a.copy()
    for x1, y1, x2, y2 in coords:
        box = slice(max(0, int(y1)), min(h, int(y2))), slice(max(0, int(x1)), min(w, int(x2)))
        if box[0].stop > box[0].start and box[1].stop > box[1].start:
            out[box] = MASKS[kind](out[box], rng, mask_ratio, **kw)
    return out


def _mask(kind: str):
    return lambda a, rng, **kw: masked(a, rng, kind, **kw)


def random_scale(a, rng, lo=0.5, hi=1.0):
    s = rng.uniform(lo, hi)
    return resized(a, max(1, round(a.shape[0] * s)), max(1, round(a.shape[1] * s)))


def side_padding(a, rng, ratio=(0.0, 0.1)):
    """White space on one side."""
    side, n = int(rng.integers(4)), int(rng.uniform(*ratio) * max(a.shape[:2]))
    return np.pad(a, [(n * (side == 0), n * (side == 1)), (n * (side == 2), n * (side == 3)), (0, 0)], constant_values=255)


def rotation(a, rng, quarters=(0, 1, 2, 3)):
    return np.rot90(a, int(rng.choice(quarters)))


# Names of the transforms in a configuration.
TRANSFORMS = {
    **{f"mask_{k}": _mask(k) for k in MASKS},
    "curve": curve, "dropout_horizontal": dropout_horizontal, "dropout_vertical": dropout_vertical, "dropout_rand": dropout_rand,
    "image_padding": image_padding, "line_overlay": line_overlay, "text_border": text_border, "motion_blur": motion_blur,
    "grid_distortion": grid_distortion, "optical_distortion": optical_distortion, "iso_noise": iso_noise,
    "gaussian_noise": gaussian_noise, "gaussian_blur": gaussian_blur, "jpeg_compression": jpeg_compression, "color_jitter": color_jitter,
    "random_scale": random_scale, "padding": side_padding, "random_rotation": rotation, "rotation": rotation,
}


def transform(name: str):
    """The transform of a name, case ignored."""
    if name.lower() not in TRANSFORMS:
        raise ValueError(f"no transform {name}; there are {sorted(TRANSFORMS)}")
    return TRANSFORMS[name.lower()]


def apply_one(a: np.ndarray, name: str, key: object, seed: int = 42, **params) -> np.ndarray:
    """One transform on one raster (h, w) or (h, w, channels), rounded and clipped to 0-255; a ``p`` among the parameters is its gate."""
    rng = np.random.default_rng(zlib.crc32(f"{key}|{name}|{seed}".encode()))
    f, p = transform(name), params.pop("p", 1.0)
    if rng.random() >= p:
        return a
    out = f(np.atleast_3d(a).astype(float), rng, **params)
    out = np.clip(np.round(out), 0, 255).astype(np.uint8)
    return out[..., 0] if a.ndim == 2 else out


def apply_all(a: np.ndarray, names: list[str], key: object, p: float = 1.0, shuffle: bool = False, onerror: str = "raise", seed: int = 42, params: dict[str, dict] | None = None) -> np.ndarray:
    """All of ``names`` behind one gate, in order or shuffled; a failing one is raised, or left out with onerror="skip"."""
    if not names:
        raise ValueError("no transforms")
    if onerror not in ("raise", "skip"):
        raise ValueError(f"onerror is raise or skip, not {onerror}")
    rng = np.random.default_rng(zlib.crc32(f"{key}|gate|{seed}".encode()))
    if rng.random() >= p:
        return a
    for n in [names[i] for i in rng.permutation(len(names))] if shuffle else names:
        try:
            a = apply_one(a, n, key, seed, **(params or {}).get(n, {}))
        except Exception:
            if onerror == "raise":
                raise
    return a


def load_config(config) -> tuple[list[dict], dict | None]:
    """(entries, policy) of an augmentation configuration: a YAML or JSON file, a mapping, or the list of entries itself.

    An entry has a name and may have p (0.5), category ("default") and params; the policy is None where there is none.
    """
    if isinstance(config, (str, os.PathLike)):
        with open(config) as f:
            if str(config).endswith(".json"):
                config = json.load(f)
            else:
                import yaml

                config = yaml.safe_load(f)
    policy = None
    if isinstance(config, dict):
        policy, config = config.get("augmentation_policy") or None, config.get("augmentations", [])
    if not isinstance(config, list):
        raise TypeError(f"a configuration is a file, a mapping or a list of entries, not {type(config).__name__}")
    for e in config:
        transform(e["name"])
    return config, policy


def _unfit(data: bytes | None, h: int, w: int) -> str | None:
    n = len(data) if data is not None else 0
    return None if n and h > 0 and w > 0 and n in (h * w, 3 * h * w) else f"raster: {n} bytes for {h} x {w}"


def augmented(rasters: DataFrame, plan: DataFrame, seed: int = 42, entries: list[dict] | None = None) -> DataFrame:
    """``rasters(id, h, w, data)`` changed by ``plan(id, transforms ARRAY<STRING>)``, or by its ``picks``, numbers of ``entries``."""
    by_number = entries is not None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, h, w, data, todo in zip(b["id"], b["h"], b["w"], b["data"], b["todo"]):
                error = _unfit(data, h, w)
                if error:
                    out.append((i, h, w, data, error))
                    continue
                a = np.frombuffer(data, np.uint8).reshape((h, w) if len(data) == h * w else (h, w, 3))
                for n in todo if todo is not None else []:
                    name, params = (entries[n]["name"], entries[n].get("params") or {}) if by_number else (n, {})
                    try:
                        a = apply_one(a, name, f"{i}|{n}" if by_number else i, seed, **params)
                    except Exception as e:  # the image keeps what it was; the row tells which transform failed
                        error = f"{name}: {e}"
                out.append((i, a.shape[0], a.shape[1], np.ascontiguousarray(a).tobytes(), error))
            yield pd.DataFrame(out, columns=["id", "h", "w", "data", "error"])

    todo = plan.select("id", F.col("picks" if by_number else "transforms").alias("todo"))
    return rasters.join(todo, "id", "left").select("id", "h", "w", "data", "todo").mapInPandas(run, "id bigint, h int, w int, data binary, error string")


def _chance(seed: str, tag: str, *what: Column) -> Column:
    return T.unit_hash(F.concat_ws("|", F.lit(seed), F.lit(tag), F.col("id").cast("string"), *what))


def _entries(spark, entries: list[dict], weights: dict[str, float] | None) -> DataFrame:
    rows = [(i, e["name"], float(e.get("p", 0.5)), e.get("category", "default"), float(weights.get(e.get("category", "default"), 0.0)) if weights is not None else 1.0) for i, e in enumerate(entries)]
    return F.broadcast(spark.createDataFrame(rows, "k int, name string, p double, category string, weight double"))


def _planned(x: DataFrame, order: str) -> DataFrame:
    s = F.sort_array(F.collect_list(F.struct(order, "k", "name")))
    return x.groupBy("id").agg(F.transform(s, lambda r: r["k"]).alias("picks"), F.transform(s, lambda r: r["name"]).alias("transforms"))


def transform_plan(ids: DataFrame, entries: list[dict], policy: dict, seed: str = "42") -> DataFrame:
    """(id, picks, transforms): entries that pass their own gate p, then drawn without replacement, in random order.

    The policy's ``num_transforms`` is a number or a range of them; with strategy "weighted" an entry's chance is
    its category's weight shared evenly among the entries that passed, and entries without weight are never drawn;
    with "uniform" all are alike. All chances are hashes of id and entry.
    """
    weights = (policy.get("category_weights") or None) if policy.get("strategy", "uniform") == "weighted" else None
    lo, hi = policy["num_transforms"] if isinstance(policy.get("num_transforms"), (list, tuple)) else [int(policy.get("num_transforms", 0))] * 2
    x = ids.select("id").crossJoin(_entries(ids.sparkSession, entries, weights))  # a configuration list of at most some dozens
    entry = F.concat_ws("#", "name", F.col("k").cast("string"))
    x = x.where(_chance(seed, "gate", entry) < F.col("p"))
    share = F.col("weight") / F.count("*").over(Window.partitionBy("id", "category")) if weights else F.col("weight")
    x = x.withColumn("share", share).where("share > 0").withColumn("key", -F.log(F.greatest(_chance(seed, "draw", entry), F.lit(2.0**-53))) / F.col("share"))
    n = F.lit(int(lo)) + F.floor(_chance(seed, "n") * (int(hi) - int(lo) + 1))
    x = x.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("key", "k"))).where(F.col("r") <= n)
    return _planned(x.withColumn("order", _chance(seed, "order", entry)), "order")


def gated_plan(ids: DataFrame, entries: list[dict], seed: str = "42") -> DataFrame:
    """(id, picks, transforms) without a policy: every entry behind its own gate, in the order of the configuration."""
    x = ids.select("id").crossJoin(_entries(ids.sparkSession, entries, None))  # a configuration list of at most some dozens
    entry = F.concat_ws("#", "name", F.col("k").cast("string"))
    return _planned(x.where(_chance(seed, "gate", entry) < F.col("p")).withColumn("order", F.col("k")), "order")


def smart_size(h: int, w: int, least_pixels: int, most_pixels: int, factor: int = 28) -> tuple[int, int]:
    """Height and width in whole multiples of ``factor`` near the given ones, with a number of pixels in the range."""
    nh, nw = max(factor, round(h / factor) * factor), max(factor, round(w / factor) * factor)
    if nh * nw > most_pixels:
        s = math.sqrt(h * w / most_pixels)
        nh, nw = (max(factor, math.floor(n / s / factor) * factor) for n in (h, w))
    elif nh * nw < least_pixels:
        s = math.sqrt(least_pixels / (h * w))
        nh, nw = (math.ceil(n * s / factor) * factor for n in (h, w))
    return nh, nw


def preprocessed(rasters: DataFrame, config, least_pixels: int, most_pixels: int, factor: int = 28, seed: int = 42) -> DataFrame:
    """Rasters brought to a model's size, then augmented by the configuration's policy, or its gates where it has none.

    AUG_MODE in the environment switches augmentation off (eval, off, 0, false, no, inference).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, h, w, data in zip(b["id"], b["h"], b["w"], b["data"]):
                if not _unfit(data, h, w):
                    a = np.frombuffer(data, np.uint8).reshape(h, w, -1).astype(float)
                    h, w = smart_size(h, w, least_pixels, most_pixels, factor)
                    data = np.clip(np.round(resized(a, h, w)), 0, 255).astype(np.uint8).tobytes()
                out.append((i, h, w, data))
            yield pd.DataFrame(out, columns=["id", "h", "w", "data"])

    sized = rasters.select("id", "h", "w", "data").mapInPandas(run, "id bigint, h int, w int, data binary")
    off = os.environ.get("AUG_MODE", "train").lower() in ("eval", "off", "0", "false", "no", "inference")
    entries, policy = load_config(config) if config is not None else ([], None)
    if off or not entries:
        return sized.withColumn("error", F.lit(None).cast("string"))
    ids = rasters.select("id")
    plan = transform_plan(ids, entries, policy, str(seed)) if policy else gated_plan(ids, entries, str(seed))
    return augmented(sized, plan, seed, entries)
