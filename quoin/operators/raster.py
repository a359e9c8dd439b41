"""Pixels: numpy kernels, and the Arrow-batched operators that run them.

Images are height x width x channels of bytes in BGR order. Bilinear sampling is our own (floating
point); it follows the usual definition, not a particular library's fixed-point rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IMAGE = "height int, width int, channels int, data binary"


def to_array(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)


def window(image: np.ndarray, x: int, y: int, w: int, h: int, fill: int = 255) -> np.ndarray:
    """A patch of the image; white where it reaches beyond an edge. One band becomes three, other counts than 1, 3, 4 are white."""
    if image.ndim == 2:
        image = image[:, :, None]
    bands = image.shape[2]
    out = np.full((h, w, 3), fill, dtype=np.uint8)
    if bands not in (1, 3, 4):
        return out
    x1, y1, x2, y2 = max(x, 0), max(y, 0), min(x + w, image.shape[1]), min(y + h, image.shape[0])
    if x1 < x2 and y1 < y2:
        part = image[y1:y2, x1:x2, :3]
        out[y1 - y : y2 - y, x1 - x : x2 - x] = np.repeat(part, 3, axis=2) if bands == 1 else part
    return out


def assemble(parts: list[tuple[int, int, np.ndarray]], w: int, h: int) -> np.ndarray:
    """Parts (x, y, pixels) on white, later ones over earlier ones; what reaches beyond the patch is cut."""
    out = np.full((h, w, 3), 255, dtype=np.uint8)
    for x, y, p in parts:
        x1, y1, x2, y2 = max(x, 0), max(y, 0), min(x + p.shape[1], w), min(y + p.shape[0], h)
        if x1 < x2 and y1 < y2:
            out[y1:y2, x1:x2] = p[y1 - y : y2 - y, x1 - x : x2 - x]
    return out


def polygon_mask(ring: np.ndarray, w: int, h: int, outline: int = 0) -> np.ndarray:
    """Pixels whose centre lies in the ring, its corners cut to whole pixels, or within outline / 2 of its edges."""
    ring = np.trunc(np.asarray(ring, dtype=float))
    gx, gy = np.meshgrid(np.arange(w, dtype=float), np.arange(h, dtype=float))
    inside = np.zeros((h, w), dtype=bool)
    near = np.full((h, w), np.inf)
    for (ax, ay), (bx, by) in zip(ring, np.roll(ring, -1, axis=0)):
        if ay != by:
            inside ^= ((ay > gy) != (by > gy)) & (gx < (bx - ax) * (gy - ay) / (by - ay) + ax)
        length = (bx - ax) ** 2 + (by - ay) ** 2
        t = np.clip(((gx - ax) * (bx - ax) + (gy - ay) * (by - ay)) / length, 0, 1) if length else 0.0
        near = np.minimum(near, np.hypot(gx - ax - t * (bx - ax), gy - ay - t * (by - ay)))
    return inside | (near <= max(outline / 2, 0.5))


def compose(image: np.ndarray, mask: np.ndarray, background: int = 255) -> np.ndarray:
    """The image where the mask is set, the background elsewhere."""
    return np.where(mask[:, :, None], image, np.uint8(background))


def dilate(mask: np.ndarray, size: int = 5) -> np.ndarray:
    """A square maximum filter."""
    r = size // 2
    padded = np.pad(mask, r)
    return np.lib.stride_tricks.sliding_window_view(padded, (size, size)).max(axis=(2, 3))


def homography(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """The least-squares projective map of four or more points, scaled to a last entry of 1.

    Points are centred and scaled first, and the map is the right singular vector of the least value.
    """

    def scaled(p):
        m, s = p.mean(axis=0), max(p.std(), 1e-12)
        t = np.array([[1 / s, 0, -m[0] / s], [0, 1 / s, -m[1] / s], [0, 0, 1]])
        return (p - m) / s, t

    a, ta = scaled(np.asarray(src, float))
    b, tb = scaled(np.asarray(dst, float))
    rows = []
    for (x, y), (u, v) in zip(a, b):
        rows += [[-x, -y, -1, 0, 0, 0, u * x, u * y, u], [0, 0, 0, -x, -y, -1, v * x, v * y, v]]
    h = np.linalg.inv(tb) @ np.linalg.svd(np.array(rows))[2][-1].reshape(3, 3) @ ta
    return h / h[2, 2]


def affine(src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """G14 as a 3 x 3 matrix."""
    a = np.hstack([np.asarray(src, float), np.ones((3, 1))])
    return np.vstack([np.linalg.solve(a, np.asarray(dst, float)).T, [0, 0, 1]])


def warp(image: np.ndarray, m: np.ndarray, w: int, h: int, border: int | str = 255) -> np.ndarray:
    """The image under a 3 x 3 map, bilinear, by the inverse map of every target pixel.

    border is the value outside the source, or "replicate" for the nearest edge pixel.
    """
    gx, gy = np.meshgrid(np.arange(w, dtype=float), np.arange(h, dtype=float))
    inv = np.linalg.inv(m)
    z = inv[2, 0] * gx + inv[2, 1] * gy + inv[2, 2]
    z = np.where(np.abs(z) < 1e-12, np.nan, z)
    x, y = (inv[0, 0] * gx + inv[0, 1] * gy + inv[0, 2]) / z, (inv[1, 0] * gx + inv[1, 1] * gy + inv[1, 2]) / z
    x, y = np.nan_to_num(x, nan=-1e9), np.nan_to_num(y, nan=-1e9)
    high, wide = image.shape[:2]
    if border == "replicate":
        x, y = np.clip(x, 0, wide - 1), np.clip(y, 0, high - 1)
    x0, y0 = np.floor(x).astype(np.int64), np.floor(y).astype(np.int64)
    fx, fy = (x - x0)[:, :, None], (y - y0)[:, :, None]

    def at(i, j):
        ok = (i >= 0) & (i < wide) & (j >= 0) & (j < high)
        p = image[np.clip(j, 0, high - 1), np.clip(i, 0, wide - 1)].astype(float)
        return p if border == "replicate" else np.where(ok[:, :, None], p, float(border))

    top = at(x0, y0) * (1 - fx) + at(x0 + 1, y0) * fx
    low = at(x0, y0 + 1) * (1 - fx) + at(x0 + 1, y0 + 1) * fx
    return np.clip(np.rint(top * (1 - fy) + low * fy), 0, 255).astype(np.uint8)


def resize(image: np.ndarray, w: int, h: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""
    sy, sx = image.shape[0] / h, image.shape[1] / w
    m = np.array([[1 / sx, 0, 0.5 / sx - 0.5], [0, 1 / sy, 0.5 / sy - 0.5], [0, 0, 1]])
    return warp(image, m, w, h, "replicate")


def letterbox(image: np.ndarray, size: int = 256) -> np.ndarray:
    """The longer side scaled to size, black to the right and below."""
    h, w = image.shape[:2]
    w2, h2 = (int(np.rint(w * (size / h))), size) if h > w else (size, int(np.rint(h * (size / w))))
    out = np.zeros((size, size, image.shape[2]), dtype=np.uint8)
    out[:h2, :w2] = resize(image, w2, h2)
    return out


def unletterbox(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """The part that letterbox filled, scaled back to h x w."""
    size = image.shape[0]
    w2, h2 = (int(np.rint(w * (size / h))), size) if h > w else (size, int(np.rint(h * (size / w))))
    return resize(image[:h2, :w2], w, h)


def cut(image: np.ndarray, size: int = 256, overlap: float = 0.1) -> list[tuple[int, int, np.ndarray]]:
    """Tiles (x, y, pixels) of size, overlapping, the last padded black (Q13: as the formula says)."""
    space = size - round(overlap * size)
    n = lambda length: 1 + max(0, -(-(length - size) // space))
    high, wide = n(image.shape[0]), n(image.shape[1])
    padded = np.zeros((size + (high - 1) * space, size + (wide - 1) * space, image.shape[2]), dtype=np.uint8)
    padded[: image.shape[0], : image.shape[1]] = image
    return [(x * space, y * space, padded[y * space : y * space + size, x * space : x * space + size]) for y in range(high) for x in range(wide)]


def merge(parts: list[tuple[int, int, np.ndarray]], w: int, h: int) -> np.ndarray:
    """Overlapping tiles, each pixel the mean of those that cover it."""
    far_x, far_y = max(x + p.shape[1] for x, _, p in parts), max(y + p.shape[0] for _, y, p in parts)
    total, count = np.zeros((far_y, far_x, parts[0][2].shape[2])), np.zeros((far_y, far_x, 1))
    for x, y, p in parts:
        total[y : y + p.shape[0], x : x + p.shape[1]] += p
        count[y : y + p.shape[0], x : x + p.shape[1]] += 1
    return np.rint(total / np.maximum(count, 1))[:h, :w].astype(np.uint8)


def paste(atlas: np.ndarray, part: np.ndarray, x: int, y: int) -> np.ndarray:
    """Part over the atlas at column x and row y; a part of one pixel is left out."""
    out = atlas.copy()
    if part.shape[:2] != (1, 1):
        h, w = out[y : y + part.shape[0], x : x + part.shape[1]].shape[:2]
        out[y : y + h, x : x + w] = part[:h, :w]
    return out


def limit_height(atlas: np.ndarray, most: int = 4096) -> np.ndarray:
    """An atlas that is too high, scaled to the limit in both directions; texture coordinates stay."""
    h, w = atlas.shape[:2]
    return atlas if h <= most else resize(atlas, max(1, round(w * (most / h))), most)


def back_to_atlas(wall: np.ndarray, src: np.ndarray, dst: np.ndarray, w: int, h: int) -> tuple[int, int, np.ndarray]:
    """A frontal wall led back to its ring in an atlas of w x h: (x, y, crop), white outside the warped wall."""
    m = affine(dst, src) if len(src) == 3 else homography(dst, src)
    moved = warp(wall, m, w, h, "replicate")
    cover = warp(np.full(wall.shape, 255, np.uint8), m, w, h, 0)[:, :, 0] > 0
    x0, y0 = np.floor(src.min(axis=0)).astype(int)
    x1, y1 = np.ceil(src.max(axis=0)).astype(int)
    x0, y0 = max(x0, 0), max(y0, 0)
    return int(x0), int(y0), compose(moved, cover)[y0:y1, x0:x1]


def swap_channels(image: np.ndarray) -> np.ndarray:
    """R16."""
    return image[:, :, ::-1]


def normalise(image: np.ndarray, mean: float = 0.5, std: float = 0.5) -> np.ndarray:
    """Bytes to channels-first floats around 0."""
    return ((image.astype(np.float32) / 255 - mean) / std).transpose(2, 0, 1)


def denormalise(x: np.ndarray) -> np.ndarray:
    """(x + 1) / 2 * 255, cut to bytes."""
    return ((x.transpose(1, 2, 0) + 1) / 2 * 255).clip(0, 255).astype(np.uint8)


def grey_mean(image: np.ndarray) -> np.ndarray:
    """The mean of the channels, in all of them."""
    m = image.mean(axis=2, keepdims=True)
    return np.repeat(m, image.shape[2], axis=2).astype(np.uint8)


def multiple_of(image: np.ndarray, base: int = 4) -> np.ndarray:
    """Scaled so that both sides are the nearest multiples of base."""
    h, w = (int(max(1, np.rint(n / base)) * base) for n in image.shape[:2])
    return image if (h, w) == image.shape[:2] else resize(image, w, h)


def scale_width(image: np.ndarray, width: int) -> np.ndarray:
    """R17, Q24."""
    return image if image.shape[1] == width else resize(image, width, max(1, int(width * image.shape[0] / image.shape[1])))


def crop(image: np.ndarray, x: int, y: int, size: int) -> np.ndarray:
    return image[y : y + size, x : x + size]


def random_crop(image: np.ndarray, size: int, seed: int) -> np.ndarray:
    """The same crop for the same seed."""
    r = np.random.default_rng(seed)
    return crop(image, int(r.integers(0, max(1, image.shape[1] - size + 1))), int(r.integers(0, max(1, image.shape[0] - size + 1))), size)


def flip(image: np.ndarray, really: bool = True) -> np.ndarray:
    return image[:, ::-1] if really else image


def summary(x: np.ndarray) -> dict[str, float]:
    """A16."""
    return {"mean": float(x.mean()), "min": float(x.min()), "max": float(x.max()), "median": float(np.median(x)), "std": float(x.std())}


def blank(h: int = 1, w: int = 1) -> np.ndarray:
    """a white image; of one pixel it stands for a face without a normal."""
    return np.full((h, w, 3), 255, dtype=np.uint8)


def cut_out(image: np.ndarray, ring: np.ndarray, x: int, y: int, w: int, h: int, margin: int = 0) -> np.ndarray:
    """The patch of an image around a ring of image positions, white outside the ring and its margin."""
    return compose(window(image, x, y, w, h), polygon_mask(np.asarray(ring, float) - [x, y], w, h, 2 * margin))


def atlas(parts: list[tuple[int, int, np.ndarray]], w: int, h: int, most: int = 4096) -> np.ndarray:
    """Parts on a white canvas, scaled down if it is too high."""
    out = blank(h, w)
    for x, y, p in parts:
        out = paste(out, p, x, y)
    return limit_height(out, most)


def copy_box(atlas_: np.ndarray, source: np.ndarray, x: int, y: int, w: int, h: int) -> np.ndarray:
    """The atlas with a box of the source in its place."""
    out = atlas_.copy()
    out[y : y + h, x : x + w] = source[y : y + h, x : x + w]
    return out


def pixels(images: DataFrame, key: str) -> DataFrame:
    """(key, y, x, c, v): every byte of the images (key, height, width, channels, data)."""
    return images.select(key, "width", "channels", F.posexplode(F.transform(F.sequence(F.lit(1), F.octet_length("data")), lambda i: F.conv(F.hex(F.substr("data", i, F.lit(1))), 16, 10).cast("int"))).alias("i", "v")).select(
        key, F.floor(F.col("i") / (F.col("width") * F.col("channels"))).cast("int").alias("y"), (F.floor(F.col("i") / F.col("channels")) % F.col("width")).cast("int").alias("x"), (F.col("i") % F.col("channels")).alias("c"), "v")


def map_images(images: DataFrame, f: Callable[..., np.ndarray], key: str = "key string", rows: bool = False) -> DataFrame:
    """f on every image (key, height, width, channels, data), an Arrow batch at a time; with `rows`, f is given the key, too."""
    name = key.split()[0]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            given = ((to_array(r.height, r.width, r.channels, r.data), getattr(r, name)) for r in pdf.itertuples())
            made = [np.ascontiguousarray(f(image, k) if rows else f(image)) for image, k in given]
            yield pd.DataFrame({name: pdf[name], "height": [m.shape[0] for m in made], "width": [m.shape[1] for m in made], "channels": [m.shape[2] for m in made], "data": [m.tobytes() for m in made]})

    return images.select(name, "height", "width", "channels", "data").mapInPandas(work, f"{key}, {IMAGE}")
